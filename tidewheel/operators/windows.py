"""Event-time windows, alerts and live panels; for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions import engagement_score, spike_message, trending_message
from tidewheel.operators.ordered import running_totals
from tidewheel.operators.summary import COLD_USER
from tidewheel.session import written

# Window, slide, lateness, and the thresholds of the alerts (all strict).
WINDOW = "30 seconds"
SLIDE = "10 seconds"
LATENESS = "15 seconds"
TRENDING_AVG = 4.5
TRENDING_COUNT = 3
SPIKE_COUNT = 10
LATENCY_TARGET = 5.0

# Buckets without events that are listed in a row.
SILENCE = 10_000


def with_event_watermark(df: DataFrame, delay: str = LATENESS, column: str = "event_time") -> DataFrame:
    """Bounds lateness; zone-less times become timestamps, as watermarks need."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def windowed_item_metrics(clean: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Mean, count and score per item and window; the score is per second of the window."""
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    score = engagement_score(F.col("interaction_count"), F.col("avg_rating"), seconds)
    return (
        clean.groupBy(F.window("event_time", window, slide), "item_id")
        .agg(F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("interaction_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "item_id",
            "avg_rating",
            "interaction_count",
            score.alias("engagement_score"),
        )
    )


def windowed_user_activity(clean: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    return (
        clean.groupBy(F.window("event_time", window, slide), "user_id")
        .agg(F.count(F.lit(1)).alias("interaction_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "user_id",
            "interaction_count",
        )
    )


def trending_alerts(
    metrics: DataFrame, min_avg: float = TRENDING_AVG, min_count: int = TRENDING_COUNT
) -> DataFrame:
    return metrics.filter((F.col("avg_rating") > min_avg) & (F.col("interaction_count") > min_count))


def spike_alerts(
    activity: DataFrame, min_count: int = SPIKE_COUNT, include_cold: bool = True
) -> DataFrame:
    """Users above the count; all cold users share one id, which can be left out."""
    spikes = activity.filter(F.col("interaction_count") > min_count)
    return spikes if include_cold else spikes.filter(F.col("user_id") != COLD_USER)


def alert_feed(trending: DataFrame, spikes: DataFrame, at: Column | str = "window_end") -> DataFrame:
    """Both kinds of alert in one shape; ``at`` is the time an alert carries."""
    when = F.col(at) if isinstance(at, str) else at
    nobody = F.lit(COLD_USER).cast("bigint")
    items = trending.select(
        F.lit("TRENDING").alias("alert_type"),
        nobody.alias("user_id"),
        F.col("item_id").cast("bigint").alias("item_id"),
        trending_message(F.col("item_id"), F.col("engagement_score")).alias("message"),
        when.alias("timestamp"),
    )
    users = spikes.select(
        F.lit("ACTIVITY_SPIKE").alias("alert_type"),
        F.col("user_id").cast("bigint").alias("user_id"),
        nobody.alias("item_id"),
        spike_message(F.col("user_id")).alias("message"),
        when.alias("timestamp"),
    )
    return items.unionByName(users)


def trailing_snapshot(events: DataFrame, lateness: str = LATENESS, window: str = WINDOW) -> DataFrame:
    """Events no further behind the newest one than both bounds, which are inclusive."""
    newest = events.agg(F.max("event_time")).scalar()
    on_time = F.col("event_time") >= newest - F.expr(f"INTERVAL {lateness}")
    in_window = F.col("event_time") >= newest - F.expr(f"INTERVAL {window}")
    return events.filter(on_time & in_window)


def user_activity_timeline(events: DataFrame, step: str, top: int) -> DataFrame:
    """Events per time step for the ``top`` busiest users."""
    busiest = (
        events.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.col("_n").desc(), F.col("user_id"))
        .limit(top)
        .select("user_id")
    )
    # ``top`` rows, so the broadcast cannot grow with the data.
    return (
        events.join(F.broadcast(busiest), "user_id", "left_semi")
        .groupBy("user_id", F.window("event_time", step))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select("user_id", F.col("window.start").alias("bucket_start"), "n_events")
    )


def throughput(events: DataFrame, bucket: str = "60 seconds", silence: int = SILENCE) -> DataFrame:
    """Events per second in each bucket, and the change on the one before.

    Buckets without events count 0 and are listed, unless more than ``silence`` of them follow each
    other: then none of them is, so that one event with a far-off time neither fills the table nor
    a task. There is no change for the first bucket, after a 0, nor after such a silence.
    """
    counts = events.groupBy(F.window("event_time", bucket)).agg(F.count(F.lit(1)).alias("n"))
    start, end = F.unix_micros("window.start"), F.unix_micros("window.end")
    cell = F.floor(start / ((end - start) * F.lit(silence + 1)))
    # One row per bucket, read three times; a cell has at most ``silence`` + 1 of them.
    counts = written(counts.select(cell.alias("cell"), start.alias("at"), (end - start).alias("step"), "n"), "buckets")
    ends = counts.groupBy("cell").agg(F.min("at").alias("first"), F.max(F.struct("at", "n")).alias("last"))
    inside = Window.partitionBy("cell").orderBy("at")
    placed = counts.withColumns({"next": F.lead("at").over(inside), "past": F.lag(F.struct("at", "n")).over(inside)})
    # A bucket beyond the neighbouring cell is too far away.
    after = ends.select((F.col("cell") - 1).alias("cell"), F.col("first").alias("next_cell"))
    before = ends.select((F.col("cell") + 1).alias("cell"), F.col("last").alias("past_cell"))
    placed = placed.join(after, "cell", "left").join(before, "cell", "left")
    step, n = F.col("step"), F.col("n")
    upcoming, past = F.coalesce("next", "next_cell"), F.coalesce("past", "past_cell")
    silent = ((upcoming - F.col("at")) / step).cast("bigint") - 1
    change = F.when(past["at"] == F.col("at") - step, (n - past["n"]) * 100.0 / past["n"])
    own = F.struct(F.col("at").alias("at"), n.alias("n"), change.alias("change"))
    listed = F.when(silent.between(1, silence), F.sequence(F.lit(1).cast("bigint"), silent)).otherwise(F.array().cast("array<bigint>"))
    zeros = F.transform(
        listed,
        lambda k: F.struct(
            (F.col("at") + k * step).alias("at"), F.lit(0).cast("bigint").alias("n"), F.when(k == 1, F.lit(-100.0)).alias("change")
        ),
    )
    every = placed.select("step", F.inline(F.concat(F.array(own), zeros)))
    return every.select(
        F.timestamp_micros("at").alias("bucket_start"),
        n.alias("n_events"),
        (n / (step / 1e6)).alias("events_per_second"),
        F.col("change").alias("percent_change"),
    )


def ingest_latency(events: DataFrame, target: float = LATENCY_TARGET) -> DataFrame:
    """Percentiles of arrival after event time in seconds, and the share under the target.

    Delays count in whole milliseconds. Tasks count how often each occurs; the marks are the
    exact ones of that histogram, whose running sums are made in ranges of delays.
    """
    delay = F.floor((F.unix_micros(F.col("kafka_ts")) - F.unix_micros(F.col("event_time"))) / 1000)
    counts = events.select(delay.cast("long").alias("ms")).groupBy("ms").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.filter("ms IS NOT NULL"), "delays")
    running = running_totals(counts, [], ["ms"], {"upto": F.col("n")})
    total = counts.agg(F.sum("n")).scalar()

    def mark(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(total * F.lit(share)), F.col("ms"))) / 1000.0

    under = F.sum(F.when(F.col("ms") < target * 1000, F.col("n")).otherwise(0)) / F.sum("n")
    return running.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"),
        mark(0.5).alias("p50"),
        mark(0.95).alias("p95"),
        mark(0.99).alias("p99"),
        under.alias("share_under_target"),
    )
