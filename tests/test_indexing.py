import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidewheel.operators import indexing, skew


@pytest.fixture(scope="module")
def skewed(spark):
    """One user with a third of the rows, the others with few."""
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 997))
    return spark.range(30_000).select(user.alias("user_id"), F.col("id").alias("item"))


def test_index_is_a_bijection_onto_a_range(spark, skewed):
    mapping = indexing.fit_dense_index(skewed, "user_id")
    ids = sorted(r["idx"] for r in mapping.collect())
    assert ids == list(range(998))
    assert mapping.filter("user_id = 'hot'").first()["idx"] == 0
    assert dict(mapping.dtypes)["idx"] == "int"


def test_index_numbers_like_a_string_indexer(skewed):
    mapping = {r["user_id"]: r["idx"] for r in indexing.fit_dense_index(skewed, "user_id").collect()}
    labels = StringIndexer(inputCol="user_id", outputCol="n").fit(skewed).labels
    assert mapping == {label: n for n, label in enumerate(labels)}


def test_applying_keeps_known_rows_and_skips_unseen_ones(skewed):
    mapping = indexing.fit_dense_index(skewed.filter("user_id <> 'u5'"), "user_id")
    indexed = indexing.apply_dense_index(skewed, mapping, "user_id", "user_idx")
    assert indexed.columns == ["user_id", "item", "user_idx"]
    assert indexed.count() == skewed.filter("user_id <> 'u5'").count()
    assert indexed.filter("user_id = 'hot'").select("user_idx").distinct().count() == 1


def test_null_ids_get_no_index(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "k string")
    rows = indexing.fit_dense_index(df, "k").orderBy("idx").collect()
    assert [(r["k"], r["idx"], r["n"]) for r in rows] == [("b", 0, 2), ("a", 1, 1)]


def test_empty_index(spark):
    assert indexing.fit_dense_index(spark.createDataFrame([], "k string"), "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    names = skewed.select("user_id").distinct().filter("user_id <> 'u7'").withColumn("x", F.length("user_id"))
    salted = skew.salted_join(skewed, names, "user_id", skew.heavy_keys(skewed, "user_id"), how)
    plain = skewed.join(names, "user_id", how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salted_join_keeps_repeated_rows_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    rows = skew.salted_join(left, right, "k", F.when(F.col("k") == 1, 8), "left").collect()
    assert sorted((r["v"], r["w"] or "") for r in rows) == [
        ("a", "x"), ("a", "x"), ("a", "y"), ("a", "y"), ("b", ""), ("c", "")
    ]


def test_right_joins_cannot_be_salted(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        skew.salted_join(df, df, "id", F.lit(1), "right")


def test_only_heavy_keys_are_cut(skewed):
    # A third of the rows over 8 tasks.
    assert [tuple(r) for r in skew.heavy_keys(skewed, "user_id").collect()] == [("hot", 3)]


def test_equal_rows_of_a_user_are_spread(spark):
    users = spark.range(10_000).selectExpr("IF(id % 5 > 0, 1000L, id) AS user_id")
    factors = spark.createDataFrame([(1000, [0.5])], "id long, features array<float>")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        known = indexing.known_users(users, factors)
        sizes = [r["count"] for r in known.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8_001 and len(sizes) > 4
        assert indexing.unknown_users(users, factors).count() == 1_999
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_heavy_key_is_spread_over_tasks(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        names = skewed.select("user_id").distinct()
        joined = skew.salted_join(skewed, names, "user_id", skew.heavy_keys(skewed, "user_id"))
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        # A third of the rows in one task without salts; an even share is one in 64.
        assert len(sizes) > 50
        assert max(r["count"] for r in sizes) < 30_000 / 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ratings_of_a_heavy_user_are_spread(spark):
    user = F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id") % 997 + 1).cast("int")
    ratings = spark.range(30_000).select(user.alias("user_idx"), F.col("id").alias("item_idx"))
    segments = spark.range(1001).selectExpr("CAST(id AS int) AS user_idx", "CAST(id % 5 AS int) AS segment")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = indexing.ratings_with_segment(ratings, segments)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 30_000
        assert max(sizes) < 30_000 / 10
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_positions_follow_the_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("key")).repartition(9)
    placed = skew.with_position(df, [F.col("key").desc()])
    assert placed.filter(F.col("position") != 4999 - F.col("key")).count() == 0
    assert placed.count() == 5000


def test_titles_fall_back_to_the_item_id(spark):
    items = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("c", 2), ("d", 3)], "item_id string, item_idx int")
    metadata = spark.createDataFrame(
        [("a", "first", 1), ("a", "second", 2), ("b", None, 1), ("b", "late", 2), ("c", "", 1), ("x", "other", 1)],
        "parent_asin string, title string, record_order int",
    )
    titles = indexing.item_titles(items, metadata, "record_order").collect()
    assert {r["item_idx"]: r["title"] for r in titles} == {0: "first", 1: "b", 2: "c", 3: "d"}
    assert len(titles) == 4
    unordered = indexing.item_titles(items, metadata).collect()
    assert {r["item_idx"]: r["title"] for r in unordered} == {0: "first", 1: "late", 2: "c", 3: "d"}


def test_display_titles(spark):
    titles = spark.createDataFrame([(0, "x" * 40), (1, "y" * 41), (2, "é" * 41)], "item_idx int, title string")
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,)], "item_id int")
    shown = {r["item_id"]: r["title"] for r in indexing.with_titles(rows, titles).collect()}
    assert shown == {0: "x" * 40, 1: "y" * 40 + "...", 2: "é" * 40 + "...", 3: "Item #3"}


def test_known_and_unknown_users_split_the_table(spark):
    users = spark.createDataFrame([(1,), (1,), (2,), (None,)], "user_id long")
    factors = spark.createDataFrame([(1, [0.5]), (9, [0.5])], "id int, features array<float>")
    assert [r[0] for r in indexing.known_users(users, factors).collect()] == [1, 1]
    assert sorted((r[0] is None, r[0]) for r in indexing.unknown_users(users, factors).collect()) == [(False, 2), (True, None)]


def test_unlabelled_segment_is_null(spark):
    df = spark.createDataFrame([(0,), (7,)], "segment int")
    assert [r["segment_label"] for r in indexing.segment_label(df).orderBy("segment").collect()] == ["Enthusiast", None]
