import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewheel import functions as fn
from tidewheel.operators import events, ranking, summary, windows
from tidewheel.sources import messages

NOON = dt.datetime(2024, 1, 1, 12, 0, 0)


def validated(spark, texts):
    envelope = spark.createDataFrame([(t, NOON) for t in texts], "value string, timestamp timestamp")
    return events.validate_events(events.parse_events(envelope))


def message(**change):
    import json

    return json.dumps({"user_id": 7, "item_id": 3, "rating": 4.5, "timestamp": "2024-01-01T12:00:00", **change})


@pytest.mark.parametrize(
    "text, reason",
    [
        (message(), None),
        (message(rating="3.5"), None),
        (message(user_id="7"), None),
        (message(rating=1), None),
        (message(rating=5.0), None),
        (message(extra=1), None),
        ("{bad", "unparseable_json"),
        ("[1]", "unparseable_json"),
        ("", "unparseable_json"),
        (None, "unparseable_json"),
        ("{}", "missing_field"),
        (message(item_id=None), "missing_field"),
        (message(timestamp=None), "missing_field"),
        (message(user_id="CORRUPTED"), "bad_id"),
        (message(rating="N/A"), "bad_rating"),
        (message(rating=0.9), "rating_out_of_range"),
        (message(rating=5.1), "rating_out_of_range"),
        (message(rating="NaN"), "rating_out_of_range"),
        (message(timestamp="bad-ts"), "bad_timestamp"),
    ],
)
def test_first_broken_rule(spark, text, reason):
    rows = validated(spark, [text]).collect()
    assert [r["reject_reason"] for r in rows] == [reason]


def test_good_and_bad_messages_are_all_kept(spark):
    texts = [message(), "{bad", None, message(rating=9), message(user_id=-1)]
    clean, dead = events.split_dead_letters(validated(spark, texts))
    assert clean.count() == 2 and dead.count() == 3
    first = clean.orderBy("user_id").collect()[1]
    assert (first["user_id"], first["item_id"], first["rating"], first["event_time"]) == (7, 3, 4.5, NOON)


def test_messages_are_parsed_once(spark):
    clean = events.clean_events(validated(spark, [message()]))
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_event_classes(spark):
    texts = [message(), message(user_id=-1), message(user_id=-1, rating=0.5), "{bad"]
    mix = {r["event_class"]: r["n"] for r in summary.event_mix(validated(spark, texts)).collect()}
    assert mix == {"normal": 1, "cold_start": 2, "malformed": 1}


def test_topic_partitions(spark):
    df = spark.createDataFrame([("4",), ("5",), ("-1",), ("CORRUPTED",), (None,)], "user_id string")
    parts = [r[0] for r in df.select(messages.event_partition(F.col("user_id"))).collect()]
    assert parts == [0, 1, 0, 0, 0]


def test_records_keep_null_fields(spark):
    df = spark.createDataFrame([(1, None, 2.0, "t")], "user_id long, item_id long, rating double, timestamp string")
    record = messages.to_kafka_records(df, 4).first()
    assert record["value"] == '{"user_id":1,"item_id":null,"rating":2.0,"timestamp":"t"}'
    assert record["partition"] == 1


EVENTS = "user_id long, item_id long, rating double, event_time timestamp, kafka_ts timestamp"


def at(seconds):
    return NOON + dt.timedelta(seconds=seconds)


def stream(spark, rows):
    return spark.createDataFrame([(u, i, r, at(s), at(s + d)) for u, i, r, s, d in rows], EVENTS)


def test_alert_thresholds_are_strict(spark):
    metrics = spark.createDataFrame(
        [(1, 4.5, 9), (2, 4.6, 3), (3, 4.6, 4)], "item_id long, avg_rating double, interaction_count long"
    )
    assert [r["item_id"] for r in windows.trending_alerts(metrics).collect()] == [3]
    activity = spark.createDataFrame([(1, 10), (2, 11), (-1, 50)], "user_id long, interaction_count long")
    assert {r["user_id"] for r in windows.spike_alerts(activity).collect()} == {2, -1}
    assert {r["user_id"] for r in windows.spike_alerts(activity, include_cold=False).collect()} == {2}


def test_alert_feed_fills_the_unused_id(spark):
    df = stream(spark, [(u, 5, 4.8, 0, 0) for u in range(4)] + [(9, n, 1.0, 0, 0) for n in range(11)])
    feed = windows.alert_feed(
        windows.trending_alerts(summary.item_metrics(df.filter("rating > 4"))),
        windows.spike_alerts(summary.user_activity(df)),
        F.lit(NOON),
    )
    assert sorted(tuple(r) for r in feed.collect()) == [
        ("ACTIVITY_SPIKE", 9, -1, "Sudden activity spike from User #9", NOON),
        ("TRENDING", -1, 5, "Trending Item #5 (Score: 0.64)", NOON),
    ]


def test_an_event_falls_into_three_sliding_windows(spark):
    metrics = windows.windowed_item_metrics(stream(spark, [(1, 2, 3.0, 5, 0), (2, 2, 5.0, 9, 0)])).collect()
    assert sorted(r["window_start"] for r in metrics) == [at(-20), at(-10), at(0)]
    assert all((r["avg_rating"], r["interaction_count"], r["engagement_score"]) == (4.0, 2, 0.2667) for r in metrics)


def test_score_is_per_second_of_the_window(spark):
    one = stream(spark, [(1, 2, 3.0, 5, 0)])
    scores = {r["engagement_score"] for r in windows.windowed_item_metrics(one, "60 seconds", "60 seconds").collect()}
    assert scores == {0.05}


def test_snapshot_bounds_are_inclusive(spark):
    df = stream(spark, [(n, 1, 3.0, s, 0) for n, s in enumerate([0, -15, -15.5, -30, -31])])
    assert windows.trailing_snapshot(df).count() == 2
    assert windows.trailing_snapshot(df, "1 minute", "30 seconds").count() == 4
    assert windows.trailing_snapshot(df.limit(0)).count() == 0


def test_throughput_fills_silent_buckets(spark):
    rows = [(1, 1, 3.0, s, 0) for s in [0] * 6 + [60] * 3 + [240] * 9]
    got = windows.throughput(stream(spark, rows)).orderBy("bucket_start").collect()
    assert [(r["n_events"], r["percent_change"]) for r in got] == [
        (6, None), (3, -50.0), (0, -100.0), (0, None), (9, None)
    ]
    assert [r["bucket_start"] for r in got] == [at(60 * n) for n in range(5)]
    assert got[0]["events_per_second"] == pytest.approx(0.1)
    assert windows.throughput(stream(spark, [])).count() == 0


def test_throughput_survives_times_that_are_far_off(spark):
    near = [int(NOON.replace(tzinfo=dt.timezone.utc).timestamp()) + s for s in (0, 60, 180)]
    # 0001-01-01 and 9999-12-31.
    far = [-62135596800, 253402214400]
    df = spark.createDataFrame([(s,) for s in near + far], "s long").select(F.timestamp_seconds("s").alias("event_time"))
    got = windows.throughput(df).select(F.unix_seconds("bucket_start"), "n_events", "percent_change").collect()
    assert sorted(map(tuple, got)) == [
        (far[0], 1, None), (near[0], 1, None), (near[1], 1, 0.0), (near[1] + 60, 0, -100.0), (near[2], 1, None), (far[1], 1, None)
    ]


@pytest.mark.parametrize("gap, listed", [(1, 0), (2, 1), (8, 7), (9, 8), (10, 0), (25, 0)])
def test_throughput_lists_silences_up_to_a_length(spark, gap, listed):
    for first in range(0, 12):
        df = stream(spark, [(1, 1, 3.0, 60 * first, 0), (1, 1, 3.0, 60 * (first + gap), 0)])
        got = windows.throughput(df, silence=8).orderBy("bucket_start").collect()
        assert [r["n_events"] for r in got] == [1, *[0] * listed, 1]
        assert [r["percent_change"] for r in got][1:2] == ([-100.0] if listed else [0.0] if gap == 1 else [None])


def test_latency_marks_are_found_without_one_task_for_all(spark):
    delays = spark.range(3000).select(F.timestamp_micros(F.lit(0)).alias("event_time"), F.timestamp_micros(F.col("id") * 977_000).alias("kafka_ts"))
    got = windows.ingest_latency(delays)
    assert tuple(got.first())[:4] == pytest.approx((3000, 1499 * 0.977, 2849 * 0.977, 2969 * 0.977))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(ms" not in plan


def test_latency_share_is_below_the_target(spark):
    got = windows.ingest_latency(stream(spark, [(1, 1, 3.0, 0, d) for d in (1, 2, 3, 5)])).first()
    assert (got["n_events"], got["p50"], got["p99"], got["share_under_target"]) == (4, 2.0, 5.0, 0.75)
    many = windows.ingest_latency(stream(spark, [(1, 1, 3.0, 0, d / 100) for d in range(1, 1001)])).first()
    assert (many["p50"], many["p95"], many["p99"]) == (5.0, 9.5, 9.9)
    none = windows.ingest_latency(stream(spark, [])).first()
    assert none["n_events"] == 0 and none["p50"] is None


def test_timeline_of_the_busiest_users(spark):
    df = stream(spark, [(1, 1, 3.0, s, 0) for s in (0, 1, 12)] + [(2, 1, 3.0, 0, 0), (3, 1, 3.0, 0, 0)])
    rows = windows.user_activity_timeline(df, "10 seconds", 2).collect()
    assert sorted((r["user_id"], r["bucket_start"], r["n_events"]) for r in rows) == [
        (1, at(0), 2), (1, at(10), 1), (2, at(0), 1)
    ]


def test_most_active_user(spark):
    df = stream(spark, [(5, 1, 3.0, 0, 0), (2, 1, 3.0, 0, 0), (5, 1, 3.0, 0, 0), (2, 1, 3.0, 0, 0), (9, 1, 3.0, 0, 0)])
    assert tuple(summary.most_active_user(df).first()) == (2, 2)
    assert tuple(summary.most_active_user(df.limit(0)).first()) == (-1, 0)


def test_kpis_of_nothing(spark):
    assert tuple(summary.stream_kpis(stream(spark, [])).first()) == (0, 0.0, 0)


def test_latest_alerts_are_the_newest(spark):
    alerts = spark.range(80).selectExpr(
        "'A' AS alert_type", "id AS user_id", "-1L AS item_id", "'m' AS message",
        "timestamp_seconds(id) AS timestamp"
    )
    assert sorted(r["user_id"] for r in ranking.latest_alerts(alerts).collect()) == list(range(30, 80))


def test_equal_engagement_is_ordered_by_item(spark):
    metrics = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 5.0)], "item_id long, engagement_score double")
    assert [r["item_id"] for r in ranking.top_engagement(metrics, 2).collect()] == [2, 1]


def test_equal_averages_are_ordered_by_count_then_item(spark):
    stats = spark.createDataFrame(
        [(0, 4, 5.0, 10), (0, 3, 5.0, 10), (0, 9, 5.0, 11), (1, 1, 2.0, 10)],
        "segment int, item_idx int, avg_rating double, n_ratings long",
    )
    got = ranking.segment_top_n(stats, 2).orderBy("segment", "rank").collect()
    assert [(r["segment"], r["item_idx"], r["rank"]) for r in got] == [(0, 9, 1), (0, 3, 2), (1, 1, 1)]


def test_scalars(spark):
    row = spark.range(1).select(
        fn.engagement_score(F.lit(3), F.lit(4.0)),
        fn.display_affinity(F.lit(-4.0)),
        fn.display_affinity(F.lit(25.0)),
        fn.dot_product(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))),
        fn.trending_message(F.lit(4), F.lit(0.125)),
        fn.parse_event_time(F.lit("2024-01-01T12:00:00")),
    ).first()
    assert tuple(row) == (0.4, 0.4, 1.0, 11.0, "Trending Item #4 (Score: 0.13)", NOON)
