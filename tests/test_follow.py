"""Alerts with what follows, and fading activity: streams against batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import follow, windows
from tidewheel.streaming import decay

START = dt.datetime(2024, 1, 1)
ALERTS = "user_id long, window_start timestamp, window_end timestamp"
EVENTS = "user_id long, item_id long, rating double, event_time timestamp"


def at(second):
    return None if second is None else START + dt.timedelta(seconds=second)


def alerts(spark, rows):
    return spark.createDataFrame([(u, at(s - 30), at(s)) for u, s in rows], ALERTS)


def events(spark, rows):
    return spark.createDataFrame([(u, n, 3.0, at(s)) for n, (u, s) in enumerate(rows)], EVENTS)


def brute(marks, seen, within):
    out = []
    for user, second in marks:
        after = [(n, at(s)) for n, (u, s) in enumerate(seen) if u == user and s is not None and second <= s < second + within]
        out += [(user, at(second - 30), at(second), n, 3.0, t) for n, t in after or [(None, None)]] if user is not None else []
    return sorted(((*row[:4], row[4] if row[3] is not None else None, row[5]) for row in out), key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def rows(seed, n_alerts, n_events, last=3000):
    rng = random.Random(seed)
    users = [1] * 8 + [2, 3, None]
    marks = sorted({(rng.choice(users), rng.randrange(0, last, 10)) for _ in range(n_alerts)}, key=lambda r: r[1])
    seen = sorted(((rng.choice(users), rng.randrange(last)) for _ in range(n_events)), key=lambda r: r[1])
    return marks, seen


def test_batch(spark):
    marks, seen = rows(1, 60, 500)
    got = follow.followed_by(alerts(spark, marks), events(spark, [*seen, (1, None)]), "40 seconds")
    assert collected(got) == brute(marks, seen, 40)
    assert got.columns == follow.OUT
    assert follow.followed_by(alerts(spark, []), events(spark, seen)).collect() == []


def run(spark, stream, folder):
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return query, collected(spark.read.schema(stream.schema).parquet(f"{folder}/out"))


def source(spark, folder, schema, parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_two_streams_equal_the_batch_and_state_shrinks(spark, tmp_path):
    marks, seen = rows(2, 50, 400)
    numbered = events(spark, seen).collect()
    parts = [numbered[n : n + 100] for n in range(0, 400, 100)]
    # The last rows only move the watermarks on; one alert and one event remain open.
    ends = ([(9, 50_000)], [(9, at(60_000))])
    left = source(spark, tmp_path / "alerts", ALERTS, [alerts(spark, marks[n : n + 13]) for n in range(0, len(marks), 13)] + [alerts(spark, ends[0])])
    right = source(spark, tmp_path / "events", EVENTS, [spark.createDataFrame(p, EVENTS) for p in parts] + [spark.createDataFrame([(9, 0, 1.0, at(60_000))], EVENTS)])
    joined = follow.followed_by(
        windows.with_event_watermark(left, "20 seconds", "window_end"), windows.with_event_watermark(right, "20 seconds"), "40 seconds"
    )
    query, got = run(spark, joined, tmp_path)
    want = brute(marks, seen, 40)
    assert [row for row in got if row[0] != 9] == want
    assert len(got) == len(set(got)) or len(want) != len(set(want))
    held = [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress if p.stateOperators]
    assert max(held) > 20 and held[-1] <= 3


def fading(spark, seen, half, idle):
    by_user = {}
    for user, second in seen:
        if user is not None and second is not None:
            by_user.setdefault(user, []).append(second)
    out = []
    for user, seconds in by_user.items():
        phase = []
        for second in [*sorted(seconds), float("inf")]:
            if phase and second - phase[-1] > idle:
                out.append((user, at(phase[0]), at(phase[-1]), len(phase), round(sum(2 ** ((s - phase[-1]) / half) for s in phase), 6)))
                phase = []
            phase.append(second)
    return sorted(out, key=repr)


def rounded(df):
    return collected(df.withColumn("activity", F.round("activity", 6)))


def test_fading_activity_of_a_batch(spark):
    _, seen = rows(3, 1, 400)
    seen += [(5, 0), (5, 30), (5, 60), (5, 91), (6, None)]
    got = decay.decayed_activity(events(spark, seen), "10 seconds", "30 seconds")
    assert rounded(got) == fading(spark, seen, 10, 30)
    assert decay.decayed_activity(events(spark, []), "10 seconds", "30 seconds").collect() == []


@pytest.fixture
def state_store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    decay.use_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_fading_activity_of_a_stream_and_after_restarts(spark, tmp_path, state_store):
    rng = random.Random(4)
    _, seen = rows(4, 1, 300)
    seen += [(5, 3010), (5, 3040), (5, 3071)]
    # Within batches of some 100 seconds rows come in any order.
    parts = [seen[n : n + 60] for n in range(0, len(seen), 60)]
    for part in parts:
        rng.shuffle(part)
    parts.append([(9, 100_000)])
    want = fading(spark, seen, 10, 30)
    folder = tmp_path / "events"
    for part in parts:
        # A new query for each file: all that is known of the users comes out of the checkpoint.
        stream = source(spark, folder, EVENTS, [events(spark, part)])
        faded = decay.decayed_activity(windows.with_event_watermark(stream, "700 seconds"), "10 seconds", "30 seconds")
        _, got = run(spark, faded, tmp_path)
    assert sorted(((*row[:4], round(row[4], 6)) for row in got), key=repr) == want
