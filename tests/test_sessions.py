import datetime as dt
import random


from tidewheel.operators import sessions, windows

START = dt.datetime(2024, 1, 1)
EVENTS = "user_id long, item_id long, rating double, event_time timestamp"
GAP = "10 seconds"


def frame(spark, rows):
    made = [(u, 1, r, None if s is None else START + dt.timedelta(seconds=s)) for u, s, r in rows]
    return spark.createDataFrame(made, EVENTS)


def brute(rows, gap=10):
    by_user = {}
    for user, second, rating in rows:
        if second is not None:
            by_user.setdefault(user, []).append((second, rating))
    visits = []
    for user, seen in by_user.items():
        run = []
        for second, rating in sorted(seen):
            if run and second - run[-1][0] > gap:
                visits.append((user, run))
                run = []
            run.append((second, rating))
        visits.append((user, run))
    moment = lambda s: START + dt.timedelta(seconds=s)
    return sorted(
        ((u, moment(run[0][0]), moment(run[-1][0] + gap), len(run), sum(r for _, r in run) / len(run)) for u, run in visits), key=repr
    )


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(seed, size):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 1, 1, 2, 3, -1, None]), rng.randrange(3000), float(rng.randrange(1, 6))) for _ in range(size)]


def test_batch_visits(spark):
    rows = made(1, 800) + [(5, 0, 1.0), (5, 10, 2.0), (5, 20, 3.0), (5, 31, 1.0), (6, None, 2.0)]
    assert collected(sessions.user_sessions(frame(spark, rows), GAP)) == brute(rows)


def test_times_before_1970_and_nothing(spark):
    early = spark.createDataFrame([(1, 1, 2.0, dt.datetime(1969, 12, 31, 23, 59, s)) for s in (50, 55, 59)], EVENTS)
    assert [r["n_events"] for r in sessions.user_sessions(early, GAP).collect()] == [3]
    assert sessions.user_sessions(frame(spark, []), GAP).collect() == []


def test_a_hot_user_is_summed_up_before_the_shuffle(spark):
    rows = [(1, n % 40, 1.0) for n in range(4000)]
    visits = sessions.user_sessions(frame(spark, rows), GAP)
    assert collected(visits) == brute(rows)
    plan = sessions.user_sessions(frame(spark, rows), GAP)._jdf.queryExecution().executedPlan().toString()
    # Plans are read from below: cells are summed up in part before anything is shuffled.
    assert plan.rindex("partial_count") > plan.rindex("Exchange")


def run_stream(spark, tmp_path, batches, delay="5 seconds"):
    folder = str(tmp_path / "in")
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)
    visits = sessions.user_sessions(windows.with_event_watermark(stream, delay), GAP)
    query = visits.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check"))
    query.trigger(availableNow=True).start().awaitTermination()
    return collected(spark.read.parquet(str(tmp_path / "out")))


def test_stream_equals_batch(spark, tmp_path):
    rows = sorted(made(2, 300), key=lambda r: r[1]) + [(5, 3010, 1.0), (5, 3020, 2.0), (5, 3031, 3.0)]
    batches = [rows[n : n + 60] for n in range(0, len(rows), 60)] + [[(9, 9000, 1.0)]]
    assert run_stream(spark, tmp_path, batches) == brute(rows)


def test_late_rows_merge_open_visits_or_are_dropped(spark, tmp_path):
    # 108 comes late but within the bound and joins two visits of user 1; 3 is beyond it.
    batches = [[(1, 100, 1.0), (1, 116, 1.0)], [(1, 108, 4.0), (2, 117, 1.0)], [(1, 200, 2.0)], [(1, 3, 5.0)], [(9, 900, 1.0)]]
    assert run_stream(spark, tmp_path, batches, "60 seconds") == brute([r for batch in batches[:3] for r in batch])
