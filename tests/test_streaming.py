import datetime as dt
import json
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import events, summary, windows
from tidewheel.plans.views import Views
from tidewheel.sources import messages
from tidewheel.streaming import progress, sinks

START = dt.datetime(2024, 1, 1)
WINDOW, SLIDE, DELAY = "24 hours", "8 hours", "15 seconds"


def write_batches(spark, folder, batches):
    for rows in batches:
        df = spark.createDataFrame(rows, "value string, timestamp timestamp")
        df.coalesce(1).write.mode("append").parquet(str(folder))


def message(seconds, user=1, item=2, rating=4.0):
    when = START + dt.timedelta(seconds=seconds)
    body = {"user_id": user, "item_id": item, "rating": rating, "timestamp": when.isoformat()}
    return json.dumps(body), when + dt.timedelta(seconds=1)


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """The event table as messages in four files, in order of event time."""
    folder = tmp_path_factory.mktemp("topic")
    rows = sorted((tuple(r) for r in Views(spark, "/root/testdata/sf0.001").messages().collect()), key=lambda r: r[1])
    size = len(rows) // 4 + 1
    write_batches(spark, folder, [rows[n : n + size] for n in range(0, len(rows), size)])
    return folder


def validated_stream(spark, folder):
    return events.validate_events(events.parse_events(messages.file_event_source(spark, str(folder), 1)))


def clean_stream(spark, folder):
    return events.clean_events(validated_stream(spark, folder))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_closed_windows_equal_the_batch_windows(spark, topic, tmp_path):
    stream = windows.with_event_watermark(clean_stream(spark, topic), DELAY)
    metrics = windows.windowed_item_metrics(stream, WINDOW, SLIDE)
    query = sinks.metrics_csv_sink(metrics, str(tmp_path / "out"), str(tmp_path / "check"), None)
    query.awaitTermination()
    got = spark.read.schema(metrics.schema).csv(str(tmp_path / "out"))

    batch = Views(spark, "/root/testdata/sf0.001").events()
    bound = batch.agg(F.max("event_time")).scalar() - F.expr(f"INTERVAL {DELAY}")
    expected = windows.windowed_item_metrics(batch, WINDOW, SLIDE).filter(F.col("window_end") <= bound)
    assert rows(got) == rows(expected)
    assert got.count() > 1000


def test_alert_stream_equals_the_batch_alerts(spark, topic, tmp_path):
    stream = windows.with_event_watermark(clean_stream(spark, topic), DELAY)
    activity = windows.windowed_user_activity(stream, "9 days", "3 days")
    query = sinks.alerts_csv_sink(
        windows.spike_alerts(activity), str(tmp_path / "out"), str(tmp_path / "check"), None
    )
    query.awaitTermination()
    got = spark.read.schema(activity.schema).csv(str(tmp_path / "out"))
    batch = Views(spark, "/root/testdata/sf0.001").events()
    bound = batch.agg(F.max("event_time")).scalar() - F.expr(f"INTERVAL {DELAY}")
    expected = windows.spike_alerts(windows.windowed_user_activity(batch, "9 days", "3 days"))
    assert rows(got) == rows(expected.filter(F.col("window_end") <= bound))
    assert got.count() > 0


def test_dead_letters_on_a_stream_and_after_a_restart(spark, tmp_path):
    folder = tmp_path / "topic"
    paths = [str(tmp_path / name) for name in ("clean", "dead", "check")]

    def run():
        sinks.dead_letter_sink(validated_stream(spark, folder), *paths, interval=None).awaitTermination()
        return spark.read.parquet(paths[0]).count(), spark.read.parquet(paths[1]).count()

    write_batches(spark, folder, [[message(0), ("{bad", START)], [message(5, rating=9.0), message(6)]])
    assert run() == (2, 2)
    assert run() == (2, 2)
    write_batches(spark, folder, [[message(9), message(10)]])
    assert run() == (4, 2)
    reasons = {r["reject_reason"] for r in spark.read.parquet(paths[1]).collect()}
    assert reasons == {"unparseable_json", "rating_out_of_range"}


def lose(folder):
    """Takes a batch away as if its writer had died before the end."""
    shutil.rmtree(folder)


def followed(spark, clean, check, out):
    query = sinks.stored_events(spark, clean).writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(sinks.EVENTS_SNAPSHOT).parquet(out).count()


@pytest.mark.parametrize("lost", [("dead",), ("clean",), ("clean", "dead"), ()])
def test_a_batch_lost_between_its_writes_is_seen_once(spark, tmp_path, lost):
    topic = tmp_path / "topic"
    places = {name: str(tmp_path / name) for name in ("clean", "dead", "check")}
    write_batches(spark, topic, [[message(0), message(1), ("{bad", START)], [message(5, rating=9.0), message(6)]])

    def run():
        sinks.dead_letter_sink(validated_stream(spark, topic), *places.values(), interval=None).awaitTermination()
        return spark.read.parquet(places["clean"]).count(), spark.read.parquet(places["dead"]).count()

    def follow():
        return followed(spark, places["clean"], str(tmp_path / "follow"), str(tmp_path / "followed"))

    assert run() == (3, 2)
    seen = follow() if "clean" not in lost else 0
    for name in lost:
        lose(f"{places[name]}/batch_id=1")
    for mark in (tmp_path / "check" / "commits").glob("*1*"):
        mark.unlink()
    assert run() == (3, 2)
    assert follow() == 3
    assert seen in (0, 3)


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    clean = str(tmp_path / "clean")
    rows = spark.createDataFrame([(1, 1, 3.0, START, START)], sinks.EVENTS_SNAPSHOT)
    rows.write.parquet(f"{clean}/_unfinished/batch_id=0")
    assert followed(spark, clean, str(tmp_path / "c1"), str(tmp_path / "o1")) == 0
    assert sinks._stored(rows, clean, 0).count() == 1
    # A second call leaves the files as they are.
    sinks._stored(rows.union(rows), clean, 0)
    assert followed(spark, clean, str(tmp_path / "c1"), str(tmp_path / "o1")) == 1


def test_late_rows_are_kept(spark, tmp_path):
    clean, places = str(tmp_path / "clean"), [str(tmp_path / "late"), str(tmp_path / "check")]
    batches = [[100, 90], [200, 84, 85], [185, 184, 300], [10, 286, 284]]

    def event(second):
        return (1, second, 3.0, START + dt.timedelta(seconds=second), START)

    def run():
        sinks.late_rows_sink(sinks.stored_events(spark, clean), *places, interval=None, lateness="15 seconds").awaitTermination()
        late = spark.read.schema(f"{sinks.EVENTS_SNAPSHOT}, watermark TIMESTAMP").parquet(places[0])
        return sorted((r["item_id"], (r["watermark"] - START).seconds) for r in late.collect())

    want = [[], [(84, 85)], [(84, 85), (184, 185)], [(10, 285), (84, 85), (184, 185), (284, 285)]]
    for number, seconds in enumerate(batches):
        sinks._stored(spark.createDataFrame([event(s) for s in seconds], sinks.EVENTS_SNAPSHOT), clean, number)
        assert run() == want[number]
    # The last batch again, as after a lost driver.
    for mark in (tmp_path / "check" / "commits").glob("*3*"):
        mark.unlink()
    lose(f"{places[0]}/batch_id=3")
    assert run() == want[-1]


def test_batches_are_put_together(spark, tmp_path):
    path = str(tmp_path / "table")

    def batch(number):
        rows = [(number, k, 3.0, START + dt.timedelta(days=k), START) for k in range(5)]
        sinks._stored(spark.createDataFrame(rows, sinks.EVENTS_SNAPSHOT).repartition(3), path, number)

    def read():
        return rows(sinks.read_batches(spark, path, sinks.EVENTS_SNAPSHOT))

    def files():
        return len(list((tmp_path / "table").rglob("*.parquet")))

    def compact(keep):
        return sinks.compact_batches(spark, path, sinks.EVENTS_SNAPSHOT, keep, "event_time")

    assert read() == [] and compact(2) == 0
    for number in range(8):
        batch(number)
    whole, before = read(), files()
    old_reader = sinks.read_batches(spark, path, sinks.EVENTS_SNAPSHOT)
    assert compact(2) == 6
    assert read() == whole and rows(old_reader) == whole
    assert compact(2) == 0 and read() == whole
    assert files() < before / 2
    batch(8)
    batch(9)
    assert len(read()) == 50
    assert compact(0) == 4 and len(read()) == 50
    # A writer that comes back with a batch that has been merged changes nothing.
    compact(0)
    batch(3)
    assert len(read()) == 50


def test_late_rows_are_counted_per_window(spark, tmp_path):
    folder = tmp_path / "topic"
    # A batch drops what is older than the watermark of the batch before, 1:25 for the third.
    write_batches(spark, folder, [[message(100)], [message(200)], [message(10, item=9), message(300)]])
    stream = windows.with_event_watermark(clean_stream(spark, folder))
    table = tmp_path / "late"
    listener = progress.LateRows(spark, str(table))
    spark.streams.addListener(listener)
    query = (
        windows.windowed_item_metrics(stream)
        .writeStream.outputMode("append")
        .format("memory")
        .queryName("late_rows")
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    deadline = time.monotonic() + 60
    while not (table.exists() and progress.late_data_report(spark, str(table)).count() >= 4):
        assert time.monotonic() < deadline
        time.sleep(0.5)
    spark.streams.removeListener(listener)
    report = progress.late_data_report(spark, str(table))
    assert report.agg(F.sum("rows_dropped_late")).first()[0] == 3
    assert report.filter("rows_in > 0").select("batch_id").distinct().count() == 3
    assert spark.table("late_rows").filter("item_id = 9").count() == 0


def test_snapshot_holds_the_trailing_window_across_batches(spark, tmp_path):
    folder = tmp_path / "topic"
    batches = [
        [message(0, item=1)] + [message(1, user=u, item=5, rating=4.8) for u in range(4)],
        [message(10, user=7, item=n) for n in range(11)],
        [message(16, item=3), message(2, user=3, item=5, rating=4.9)],
    ]
    write_batches(spark, folder, batches)
    paths = [str(tmp_path / name) for name in ("events", "metrics", "alerts")]

    def run():
        clean = clean_stream(spark, folder)
        sinks.snapshot_sink(clean, *paths, str(tmp_path / "check"), interval=None, keep=2).awaitTermination()

    run()
    live = sinks.read_snapshot(spark, paths[0], sinks.EVENTS_SNAPSHOT)
    envelope = spark.createDataFrame([m for b in batches for m in b], "value string, timestamp timestamp")
    everything = events.clean_events(events.validate_events(events.parse_events(envelope)))
    expected = windows.trailing_snapshot(everything)
    assert rows(live) == rows(expected)
    metrics = sinks.read_snapshot(spark, paths[1], sinks.METRICS_SNAPSHOT)
    assert rows(metrics) == rows(summary.item_metrics(expected))
    alerts = sinks.read_alerts(spark, paths[2])
    kinds = sorted((r["alert_type"], max(r["user_id"], r["item_id"])) for r in alerts.collect())
    # Item 5 trends in all three batches, user 7 spikes in the last two.
    assert kinds == [("ACTIVITY_SPIKE", 7)] * 2 + [("TRENDING", 5)] * 3
    assert len(list((tmp_path / "events").glob("batch_id=*"))) == 2
    run()
    assert rows(sinks.read_snapshot(spark, paths[0], sinks.EVENTS_SNAPSHOT)) == rows(expected)


def test_all_spikes_are_stored(spark, tmp_path):
    folder = tmp_path / "topic"
    write_batches(spark, folder, [[message(1, user=u, item=n) for u in range(60) for n in range(11)]])
    paths = [str(tmp_path / name) for name in ("events", "metrics", "alerts")]
    sinks.snapshot_sink(clean_stream(spark, folder), *paths, str(tmp_path / "check"), interval=None).awaitTermination()
    spikes = sinks.read_alerts(spark, paths[2]).filter("alert_type = 'ACTIVITY_SPIKE'")
    assert sorted(r["user_id"] for r in spikes.collect()) == list(range(60))
    assert sinks.read_alerts(spark, str(tmp_path / "none")).count() == 0


def test_no_snapshot_yet_is_an_empty_table(spark, tmp_path):
    assert sinks.read_snapshot(spark, str(tmp_path / "none"), sinks.ALERTS_SNAPSHOT).count() == 0


def test_text_files_as_messages(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text(message(0)[0] + "\n{bad\n")
    source = messages.file_event_source(spark, str(tmp_path / "topic"), fmt="text")
    query = (
        events.validate_events(events.parse_events(source))
        .writeStream.format("memory").queryName("from_text")
        .option("checkpointLocation", str(tmp_path / "check"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("from_text")
    assert sorted(str(r["reject_reason"]) for r in got.collect()) == ["None", "unparseable_json"]
    assert got.filter("kafka_ts IS NULL").count() == 0


def test_zone_less_times_get_a_watermark(spark, tmp_path):
    spark.range(3).selectExpr("timestamp_ntz '2024-01-01 00:00:00' AS event_time").write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema("event_time timestamp_ntz").parquet(str(tmp_path / "t"))
    assert dict(windows.with_event_watermark(stream).dtypes)["event_time"] == "timestamp"


def test_metrics_by_name(spark):
    sinks.register_window_metrics(spark.range(3))
    assert spark.sql("SELECT count(*) AS n FROM window_metrics").first()["n"] == 3
