import random

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import cleaning

RAW = "user_id string, parent_asin string, rating double, timestamp long"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def kept(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_with_a_null_key_column_are_dropped(spark):
    rows = [("u", "i", 3.0, 1), (None, "i", 3.0, 1), ("u", None, 3.0, 1), ("u", "i", None, 1), ("u", "i", 3.0, None)]
    assert kept(cleaning.clean_ratings(raw(spark, rows))) == [("u", "i", 3.0, 1)]


def test_rating_bounds_are_inclusive(spark):
    rows = [("u", str(n), r, 1) for n, r in enumerate([0.9, 1.0, 5.0, 5.1, float("nan")])]
    assert [r[2] for r in kept(cleaning.clean_ratings(raw(spark, rows)))] == [1.0, 5.0]


def test_newest_row_of_a_pair_wins_and_the_higher_rating_among_equals(spark):
    rows = [("u", "i", 5.0, 1), ("u", "i", 2.0, 7), ("u", "i", 3.0, 7), ("u", "j", 1.0, 0)]
    assert kept(cleaning.clean_ratings(raw(spark, rows))) == [("u", "i", 3.0, 7), ("u", "j", 1.0, 0)]


def test_other_columns_stay_with_the_newest_row(spark):
    df = spark.createDataFrame([("u", "i", 1.0, 1, "old"), ("u", "i", 1.0, 2, "new")],
                               "user_id string, item_id string, rating double, timestamp long, note string")
    assert cleaning.latest_per_pair(df).first()["note"] == "new"


def test_cleaning_twice_changes_nothing(spark):
    rows = [("u%d" % (n % 7), "i%d" % (n % 5), float(n % 7), n) for n in range(200)]
    once = cleaning.clean_ratings(raw(spark, rows))
    again = cleaning.clean_ratings(once.withColumnRenamed("item_id", "parent_asin"))
    assert kept(once) == kept(again)


def test_report_adds_up(spark):
    rows = [("u", "i", 3.0, 1), ("u", "i", 4.0, 2), ("u", "i", None, 1), ("u", "j", 9.0, 1)]
    report = cleaning.cleaning_report(raw(spark, rows)).first().asDict()
    assert report == {"rows_in": 4, "dropped_null": 1, "dropped_range": 1, "dropped_duplicate": 1, "rows_out": 1}


def test_empty_input(spark):
    empty = raw(spark, [])
    assert cleaning.clean_ratings(empty).count() == 0
    assert cleaning.cleaning_report(empty).first()["rows_in"] == 0


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.range(20_000).selectExpr("id % 200 AS user_id", "id AS item_id")


def test_sample_is_near_its_fraction_and_independent_of_layout(pairs):
    sample = kept(cleaning.bernoulli_sample(pairs, 0.1))
    assert 1700 < len(sample) < 2300
    assert sample == kept(cleaning.bernoulli_sample(pairs.repartition(13, "item_id"), 0.1))
    assert sample != kept(cleaning.bernoulli_sample(pairs, 0.1, seed=7))


def test_split_keeps_every_row_once(pairs):
    train, test = cleaning.train_test_split(pairs)
    assert train.count() + test.count() == pairs.count()
    assert train.join(test, ["user_id", "item_id"]).count() == 0
    assert 0.78 < train.count() / pairs.count() < 0.82


def test_a_sample_splits_like_the_whole(pairs):
    sample = cleaning.bernoulli_sample(pairs, 0.3)
    train, _ = cleaning.train_test_split(sample)
    assert 0.76 < train.count() / sample.count() < 0.84


def test_latest_rating_is_found_without_sorting(spark):
    rng = random.Random(1)
    ratings = [None, float("nan"), -3.5, 0.0, 1.0, 1.0000001, 4.3, 4.2999, 5.0, 1e5]
    rows = [(f"u{rng.randrange(9)}", "i", rng.choice(ratings), rng.choice([None, -5, 0, 1, 2**62])) for _ in range(400)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating float, timestamp long").repartition(4)
    got = cleaning.latest_per_pair(df)
    struct = df.groupBy("user_id", "item_id").agg(F.max(F.struct("timestamp", "rating")).alias("newest"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, struct.select("user_id", "item_id", "newest.rating", "newest.timestamp").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("HashAggregate") >= 2
