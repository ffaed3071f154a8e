"""Where streams end: files, snapshot tables, dead letters and a named view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewheel.operators.events import clean_events, dead_letters
from tidewheel.operators.summary import item_metrics, user_activity
from tidewheel.operators.windows import (
    LATENESS,
    WINDOW,
    alert_feed,
    spike_alerts,
    trailing_snapshot,
    trending_alerts,
)

# Time between two writes, and the name of the view.
INTERVAL = "10 seconds"
VIEW = "window_metrics"


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every ``interval``, or once over all that is there when it is None."""
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def _csv_sink(stream: DataFrame, path: str, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = (
        stream.writeStream.outputMode("append")
        .format("csv")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def metrics_csv_sink(
    metrics: DataFrame, path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Window metrics as CSV, each window once it is closed."""
    return _csv_sink(metrics, path, checkpoint, interval)


def alerts_csv_sink(
    alerts: DataFrame, path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    return _csv_sink(alerts, path, checkpoint, interval)


def windows_sink(
    metrics: DataFrame,
    metrics_path: str,
    alerts_path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    alerts: Callable[[DataFrame], DataFrame] = trending_alerts,
) -> StreamingQuery:
    """Closed windows and the ones among them that raise ``alerts``, as two tables from one query.

    Two queries would read the source and keep the window state twice. Each batch has a
    folder of its own, as in ``dead_letter_sink``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        closed = _stored(batch, metrics_path, batch_id)
        _stored(alerts(closed), alerts_path, batch_id)

    writer = (
        metrics.writeStream.outputMode("append").foreachBatch(store).option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def register_window_metrics(df: DataFrame, name: str = VIEW) -> None:
    """Makes a metrics table available to SQL under a name."""
    df.createOrReplaceTempView(name)


def dead_letter_sink(
    validated: DataFrame, clean_path: str, dead_path: str, checkpoint: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Good and bad messages into two tables.

    Each batch has a folder of its own in both tables, which appears when it is complete and is
    then left as it is. So a batch that is run again after a failure, also one between the two
    writes, leaves every message stored once, and streams over a table see no file twice. Both
    tables read with ``spark.read.parquet`` and show the batch as a column.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # Read twice from the source otherwise.
        batch = batch.persist()
        try:
            _stored(clean_events(batch), clean_path, batch_id)
            _stored(dead_letters(batch), dead_path, batch_id)
        finally:
            batch.unpersist()

    writer = validated.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def late_rows_sink(
    clean: DataFrame, path: str, checkpoint: str, interval: str | None = INTERVAL, lateness: str = LATENESS
) -> StreamingQuery:
    """The rows that come after the watermark has passed their time, which windows leave out.

    The watermark of a batch is the newest time of all batches before it, less ``lateness``, as it is for
    windows over the same stream. Each batch stores its late rows with that ``watermark``, and its own
    newest time beside them, so a batch that is run again finds the same rows late. The first batch
    has no watermark and no late rows.
    """
    marks = f"{path}/_marks"

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # One row per batch; each has the newest time so far.
        before = read_snapshot(spark, marks, MARKS, batch_id).agg(F.max("newest").alias("newest"))
        newest = batch.agg(F.max("event_time").alias("newest")).unionByName(before)
        _stored(newest.agg(F.max("newest").cast("timestamp").alias("newest")), marks, batch_id)
        mark = before.select(F.col("newest") - F.expr(f"INTERVAL {lateness}")).scalar()
        late = batch.withColumn("watermark", mark).filter(F.col("event_time") < F.col("watermark"))
        _stored(late, path, batch_id)

    writer = clean.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def stored_events(spark: SparkSession, clean_path: str) -> DataFrame:
    """The table of good messages as a stream."""
    place = spark._jvm.org.apache.hadoop.fs.Path(clean_path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    stream = spark.readStream.schema(f"{EVENTS_SNAPSHOT}, batch_id BIGINT").parquet(clean_path)
    return stream.drop("batch_id")


def _stored(df: DataFrame, path: str, batch_id: int, **options: str) -> DataFrame:
    """The table's folder for the batch, written unless it is there.

    The files are written aside, where readers do not look, and the folder is then moved as a
    whole: a batch is seen complete or not at all.
    """
    spark = df.sparkSession
    folder, aside = f"{path}/batch_id={batch_id}", f"{path}/_unfinished/batch_id={batch_id}"
    if batch_id not in _folders(spark, path):
        df.write.mode("overwrite").options(**options).parquet(aside)
        source, target = (spark._jvm.org.apache.hadoop.fs.Path(place) for place in (aside, folder))
        files = source.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(target.getParent())
        # What stands there without a mark was left by another writer.
        files.delete(target, True)
        if not files.rename(source, target):
            raise OSError(f"cannot move {aside} to {folder}")
    return spark.read.schema(df.schema).parquet(folder)


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Complete snapshots under ``path`` by batch number."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    found = {}
    for status in files.listStatus(root):
        folder = status.getPath()
        number = folder.getName().removeprefix("batch_id=")
        if number.isdigit() and files.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
            found[int(number)] = folder.toString()
    return found


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType | str, before: int | None = None
) -> DataFrame:
    """The newest complete snapshot, or the newest one of a batch ``before`` the given one."""
    folders = {n: f for n, f in _folders(spark, path).items() if before is None or n < before}
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folders[max(folders)])


def _merged(spark: SparkSession, path: str) -> dict[int, str]:
    """What ``compact_batches`` has made, by the last batch in it."""
    return _folders(spark, f"{path}/_merged")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table of batches: the newest merged part, and all complete batches after it."""
    merged = _merged(spark, path)
    upto = max(merged, default=-1)
    folders = [folder for number, folder in sorted(_folders(spark, path).items()) if number > upto]
    folders += [merged[upto]] if merged else []
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def compact_batches(
    spark: SparkSession, path: str, schema: T.StructType | str, keep: int = 10, by: str | None = None, file_rows: int = 1_000_000
) -> int:
    """Puts the folders of all but the newest ``keep`` batches together; returns how many were merged.

    The merged part appears as a whole, and ``read_batches`` then reads it in place of the folders in it.
    With ``by``, a time, rows are dealt and sorted by its day, so that readers of a span skip the other
    files; a file has at most ``file_rows`` rows. Folders that an earlier call has merged are deleted
    now, not those of this call, so a reader that began before it still finds all its files. A call
    that is lost half way leaves the table as it was. The stream that writes the table may run on, but
    streams that follow it must be done with the batches that are merged twice.
    """
    merged, folders = _merged(spark, path), _folders(spark, path)
    upto = max(merged, default=-1)
    _remove(spark, [folder for number, folder in folders.items() if number <= upto])
    _remove(spark, [folder for number, folder in merged.items() if number < upto])
    ready = sorted(number for number in folders if number > upto)[: -keep or None]
    if not ready:
        return 0
    parts = [folders[number] for number in ready] + ([merged[upto]] if merged else [])
    rows = spark.read.schema(schema).parquet(*parts)
    if by is not None:
        day = F.to_date(by)
        rows = rows.repartitionByRange(day, F.col(by)).sortWithinPartitions(day, F.col(by))
    _stored(rows, f"{path}/_merged", ready[-1], maxRecordsPerFile=str(file_rows))
    return len(ready)


def _remove(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts of all batches that are complete; ``latest_alerts`` picks the newest."""
    return read_batches(spark, path, ALERTS_SNAPSHOT)


def _forget(spark: SparkSession, path: str, older_than: int) -> None:
    _remove(spark, [folder for number, folder in _folders(spark, path).items() if number < older_than])


MARKS = "newest TIMESTAMP"
EVENTS_SNAPSHOT = "user_id BIGINT, item_id BIGINT, rating DOUBLE, event_time TIMESTAMP, kafka_ts TIMESTAMP"
METRICS_SNAPSHOT = "item_id BIGINT, avg_rating DOUBLE, interaction_count BIGINT, engagement_score DOUBLE"
ALERTS_SNAPSHOT = "alert_type STRING, user_id BIGINT, item_id BIGINT, message STRING, timestamp TIMESTAMP"


def snapshot_sink(
    clean: DataFrame,
    events_path: str,
    metrics_path: str,
    alerts_path: str,
    checkpoint: str,
    interval: str | None = INTERVAL,
    lateness: str = LATENESS,
    window: str = WINDOW,
    keep: int = 5,
) -> StreamingQuery:
    """Latest events and item metrics, made anew by every batch, and the alerts of every batch.

    A batch joins its events to the snapshot of the batch before and keeps what lies within
    the trailing window, so only that window is stored between batches. Each batch writes
    folders of its own; the last ``keep`` of events and metrics stay for readers, and a repeated
    batch starts from the same predecessor. Alerts stay, all of them; ``read_alerts`` reads them.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def store(df: DataFrame, path: str, schema: str) -> DataFrame:
            _stored(df, path, batch_id)
            return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")

        before = read_snapshot(spark, events_path, EVENTS_SNAPSHOT, batch_id)
        # The newest time and the rows are two passes over the batch.
        joined = before.unionByName(batch).persist()
        try:
            events = store(trailing_snapshot(joined, lateness, window), events_path, EVENTS_SNAPSHOT)
        finally:
            joined.unpersist()
        metrics = store(item_metrics(events), metrics_path, METRICS_SNAPSHOT)
        newest = events.agg(F.max("event_time")).scalar()
        fresh = alert_feed(trending_alerts(metrics), spike_alerts(user_activity(events)), newest)
        store(fresh, alerts_path, ALERTS_SNAPSHOT)
        for path in (events_path, metrics_path):
            _forget(spark, path, batch_id - keep + 1)

    writer = clean.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()
