"""Groupings, versions, outer joins, paths and sketches against plain Python, with hot rows."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import indexing, lattice, paths, sketches, skew, versions

ROWS = "a string, b long, c long, n long"


def made(spark, seed, size, hot=0.8):
    rng = random.Random(seed)
    rows = [("hot", 1, None, 2) if rng.random() < hot else (rng.choice(["x", "y", None]), rng.randrange(4), rng.choice([None, 0, 1]), rng.randrange(9)) for _ in range(size)]
    return rows, spark.createDataFrame(rows, ROWS).repartition(4)


def brute_sets(rows, sets):
    out = []
    for s in sets:
        groups = {}
        for row in rows:
            groups.setdefault(tuple(row["abc".index(d)] if d in s else None for d in "abc"), []).append(row[3])
        if not s and not rows:
            groups[None, None, None] = []
        number = sum(4 >> k for k, d in enumerate("abc") if d not in s)
        out += [(*key, number, len(v), sum(v) if v else None, min(v, default=None), max(v, default=None)) for key, v in groups.items()]
    return sorted(out, key=repr)


def measures():
    return {"rows": ("count", F.lit(1)), "total": ("sum", F.col("n")), "least": ("min", F.col("n")), "most": ("max", F.col("n"))}


CUBE = [s for size in range(4) for s in combinations("abc", size)]


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_cube_rollup_and_sets(spark):
    rows, df = made(spark, 1, 600)
    assert collected(lattice.cube(df, ["a", "b", "c"], measures())) == brute_sets(rows, CUBE)
    assert collected(lattice.rollup(df, ["a", "b", "c"], measures())) == brute_sets(rows, ["abc", "ab", "a", ""])
    some = [("c",), ("a",), ("c", "a"), ("a",)]
    assert collected(lattice.grouping_sets(df, ["a", "b", "c"], some, measures())) == brute_sets(rows, ["ac", "a", "c"])
    with pytest.raises(ValueError):
        lattice.grouping_sets(df, ["a"], [("b",)], measures())


def test_cube_of_nothing(spark):
    _, df = made(spark, 1, 0)
    assert collected(lattice.cube(df, ["a", "b", "c"], measures())) == [(None, None, None, 7, 0, None, None, None)]


def test_cube_reads_the_rows_once(spark):
    _, df = made(spark, 2, 50)
    plan = lattice.cube(df, ["a", "b", "c"], measures())._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "LogicalRDD" not in plan


def multiset(rows):
    return sorted(map(repr, rows))


def test_versions_with_repeats_and_nulls(spark):
    old, left = made(spark, 3, 500)
    new, right = made(spark, 4, 400)
    a, b = Counter(old), Counter(new)
    assert multiset(map(tuple, versions.multiset_difference(left, right).collect())) == multiset((a - b).elements())
    assert multiset(map(tuple, versions.multiset_intersection(left, right).collect())) == multiset((a & b).elements())

    def change(row):
        if not a[row] or not b[row]:
            return "added" if b[row] else "removed"
        return "more" if b[row] > a[row] else "fewer" if b[row] < a[row] else "same"

    want = [(*row, a[row], b[row], change(row)) for row in a | b]
    assert collected(versions.change_feed(left, right)) == sorted(want, key=repr)
    assert versions.multiset_difference(left, left).count() == 0


def test_copies_of_one_row_are_made_by_many_tasks(spark):
    counted = spark.createDataFrame([("x", 40_000), ("y", 1)], "a string, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = skew.repeated(counted, "n").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in tasks) == 40_001 and len(tasks) >= 6 and max(r["count"] for r in tasks) < 20_000


@pytest.mark.parametrize("how", ["full", "right"])
def test_outer_join_with_hot_keys_on_both_sides(spark, how):
    rng = random.Random(5)
    left = [(rng.choice([1] * 20 + [2, 3, 4, None]), n) for n in range(300)]
    right = [(rng.choice([1, 2] + [5] * 20 + [6, None]), -n) for n in range(200)]
    dfs = [spark.createDataFrame(rows, f"k long, {name} long").repartition(3) for rows, name in ((left, "v"), (right, "w"))]
    heavy = [skew.heavy_keys(df, "k") for df in dfs]
    assert [{r["k"] for r in table.collect()} for table in heavy] == [{1}, {5}]
    got = collected(skew.salted_outer_join(*dfs, "k", *heavy, how).select("k", "v", "w"))
    want = [(k, v, w) for k, v in left for j, w in right if k is not None and k == j]
    lefts, rights = {k for k, _ in left}, {k for k, _ in right}
    want += [(k, None, w) for k, w in right if k is None or k not in lefts]
    want += [(k, v, None) for k, v in left if k is None or k not in rights] if how == "full" else []
    assert got == sorted(want, key=repr)
    with pytest.raises(ValueError):
        skew.salted_outer_join(*dfs, "k", *heavy, "left")


def test_numbers_stay_between_runs(spark):
    old = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "name string, idx int")
    counts = spark.createDataFrame([("b", 7), ("z", 3), ("d", 9), ("e", 9), (None, 4)], "name string, n long")
    got = collected(indexing.reconciled_index(old, counts, "name"))
    assert got == [("a", 0, 0, "gone"), ("b", 7, 1, "kept"), ("c", 0, 2, "gone"), ("d", 9, 3, "new"), ("e", 9, 4, "new"), ("z", 3, 5, "new")]
    first = collected(indexing.reconciled_index(old.limit(0), counts, "name"))
    assert [(r[0], r[2]) for r in first] == [("b", 2), ("d", 0), ("e", 1), ("z", 3)]


def test_steps_of_any_item_type(spark):
    rows = [(1, "b", 5), (1, "a", 5), (1, "c", 9), (2, "a", 1), (None, "a", 2), (3, None, 1), (3, "q", 2), (3, "r", None)]
    got = paths.item_steps(spark.createDataFrame(rows, "u long, thing string, t int"), "u", "thing", "t")
    assert got.columns == ["u", "from_item", "to_item", "left_at", "reached_at"]
    assert collected(got) == [(1, "a", "b", 5, 5), (1, "b", "c", 5, 9), (3, None, "q", 1, 2)]


def test_steps_of_a_user_with_most_events(spark):
    events = spark.range(30_000).selectExpr("IF(id % 3 = 0, 1, id) AS user_id", "id % 7 AS item_id", "timestamp_seconds(id) AS event_time")
    counts = paths.path_counts(paths.item_steps(events))
    assert counts.agg(F.sum("n_steps")).first()[0] == 10_000


def test_sketches_stay_within_their_error(spark):
    events = spark.range(200_000).selectExpr(
        "id * 7919 % 60000 AS user_id",
        "id % 100 AS item_id",
        "timestamp_seconds(id) AS event_time",
        "timestamp_millis(id * 1000 + id * 31 % 50000) AS kafka_ts",
    )
    days = sketches.window_sketches(events, "1 hour")
    got = sketches.estimates(sketches.merged_sketches(days, [])).first()
    assert got["n_events"] == 200_000
    assert got["n_users"] == pytest.approx(60_000, rel=0.03)
    assert got["n_items"] == 100
    for mark, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        assert got[mark] == pytest.approx(50 * share, abs=50 * 0.003)


def test_sketches_of_spans_with_gaps(spark):
    hours = [0, 1, 2, 9]
    events = spark.createDataFrame([(h,) for h in hours], "h long").selectExpr("h AS user_id", "1L AS item_id", "timestamp_seconds(h * 3600) AS event_time", "timestamp_seconds(h * 3600 + 1) AS kafka_ts")
    spans = sketches.trailing_sketches(sketches.window_sketches(events, "1 hour"), 2)
    got = sketches.estimates(spans).select(F.hour("span_end"), "n_events", "n_users", "p50").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1.0, 1.0), (2, 2, 2.0, 1.0), (3, 2, 2.0, 1.0), (10, 1, 1.0, 1.0)]
