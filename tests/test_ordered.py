"""As-of joins and running sums against plain Python, with one key that has most of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import intervals, ordered

ROWS = "user long, at long, value long, n long"


def made(spark, seed, size, hot=0.8, last=4000, nulls=True):
    rng = random.Random(seed)
    rows = []
    for k in range(size):
        user = 7 if rng.random() < hot else rng.randrange(40)
        if nulls and k % 50 == 0:
            user = None
        rows.append((user, None if nulls and k % 70 == 0 else rng.randrange(last), k, rng.randrange(5)))
    return rows, spark.createDataFrame(rows, ROWS).repartition(4)


def brute_asof(lefts, rights, strict, tolerance):
    out = []
    for user, at, value, n in lefts:
        best = None
        for r_user, r_at, r_value, _ in rights:
            if None in (user, at, r_user, r_at) or r_user != user or r_at > at or (strict and r_at == at):
                continue
            best = max(best or (r_at, r_value), (r_at, r_value))
        if best and tolerance is not None and best[0] < at - tolerance:
            best = None
        out.append((user, at, value, n, best[1] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 0, 30])
def test_asof_join(spark, strict, tolerance):
    lefts, left = made(spark, 1, 900)
    rights, right = made(spark, 2, 300)
    joined = ordered.asof_join(
        left, right, ["user"], "at", "at", {"found": F.col("value")}, ["value"], strict, None if tolerance is None else F.lit(tolerance)
    )
    assert joined.columns == ["user", "at", "value", "n", "found"]
    assert sorted(map(tuple, joined.collect()), key=repr) == brute_asof(lefts, rights, strict, tolerance)


def test_asof_join_carries_over_ranges_without_right_rows(spark):
    left = spark.createDataFrame([(1, t, t, 0) for t in range(1, 3000)] + [(2, 5, 0, 0)], ROWS)
    right = spark.createDataFrame([(1, 0, 77, 0)], ROWS)
    found = ordered.asof_join(left, right, ["user"], "at", "at", {"found": F.col("value")}).groupBy("user", "found").count()
    assert sorted(map(tuple, found.collect())) == [(1, 77, 2999), (2, None, 1)]


def test_asof_join_with_nothing(spark):
    some, none = spark.createDataFrame([(1, 1, 1, 1)], ROWS), spark.createDataFrame([], ROWS)
    assert [r["found"] for r in ordered.asof_join(some, none, ["user"], "at", "at", {"found": F.col("value")}).collect()] == [None]
    assert ordered.asof_join(none, some, ["user"], "at", "at", {"found": F.col("value")}).collect() == []


def test_a_hot_key_is_spread(spark):
    _, left = made(spark, 3, 4000, hot=0.95, last=1_000_000, nulls=False)
    ranged = ordered._in_ranges(left, [F.struct("user"), F.col("at")])
    tasks = ranged.filter("user = 7").groupBy("_range").count().collect()
    # Small ranges may be merged at run time, but not into one; without merging there are eight.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = ranged.filter("user = 7").groupBy("_range").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) >= 6
    assert max(r["count"] for r in tasks) < 4000 / 4


@pytest.mark.parametrize("on", [["user"], []])
def test_running_totals(spark, on):
    rows, df = made(spark, 4, 900)
    got = ordered.running_totals(df, on, ["at", "value"], {"total": F.col("n"), "rows": F.lit(1).cast("long")})

    def key(row):
        return (row[1] is not None, row[1] or 0, row[2])

    want = []
    for row in rows:
        before = [r for r in rows if (not on or r[0] == row[0]) and key(r) <= key(row)]
        want.append((*row, sum(r[3] for r in before), len(before)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("span", [1, 25, 100_000])
def test_trailing_totals(spark, span):
    rows, df = made(spark, 5, 700, last=300)
    got = ordered.trailing_totals(df, ["user"], "at", F.lit(span), {"total": F.col("n")})
    want = set()
    for user, at, _, _ in rows:
        if at is not None and user is not None:
            want.add((user, at, sum(r[3] for r in rows if r[0] == user and r[1] is not None and at - span < r[1] <= at)))
    assert {tuple(r) for r in got.filter("user IS NOT NULL").collect()} == want


def brute_intervals(spans, points):
    return sorted(
        (k, s, e, v)
        for k, s, e in spans
        for p, t, v in points
        if k is not None and k == p and None not in (s, e, t) and s <= t < e
    )


def test_interval_join(spark):
    rng = random.Random(6)
    spans = [(rng.choice([1, 1, 1, 2, 3, None]), s, s + rng.choice([0, -5, 1, 2, 3, 64, 1000, 10_000_000])) for s in rng.choices(range(2000), k=120)]
    spans += [(1, None, 5), (1, 5, None)]
    points = [(rng.choice([1, 1, 1, 1, 2, 4, None]), rng.choice([None, *range(2000)]), k) for k in range(1500)]
    left = spark.createDataFrame(spans, "k long, s long, e long")
    right = spark.createDataFrame(points, "k long, t long, v long")
    micros = {name: F.timestamp_micros(name) for name in ("s", "e")}
    joined = intervals.interval_join(left.withColumns(micros), right.withColumn("t", F.timestamp_micros("t")), ["k"], "s", "e", "t", {"v": F.col("v")})
    got = joined.select("k", F.unix_micros("s"), F.unix_micros("e"), "v")
    assert sorted(map(tuple, got.collect())) == brute_intervals(spans, points)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_cuts_a_hot_cell(spark):
    left = spark.createDataFrame([(1, 0, 64), (2, 0, 64)], "k long, s long, e long")
    right = spark.createDataFrame([(1, n % 60, n) for n in range(5000)] + [(2, 1, 1)], "k long, t long, v long")
    left = left.withColumns({name: F.timestamp_micros(name) for name in ("s", "e")})
    joined = intervals.interval_join(left, right.withColumn("t", F.timestamp_micros("t")), ["k"], "s", "e", "t", {"v": F.col("v")})
    assert joined.count() == 5001
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_interval_join_with_nothing(spark):
    left = spark.createDataFrame([], "k long, s timestamp, e timestamp")
    right = spark.createDataFrame([], "k long, t timestamp")
    assert intervals.interval_join(left, right, ["k"], "s", "e", "t", {"t": F.col("t")}).collect() == []
