"""Visits: events of a user with no long gap between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a visit ends this long after its last event.
GAP = "30 minutes"


def user_sessions(events: DataFrame, gap: str = GAP) -> DataFrame:
    """Visits of each user: start, end, events and mean rating. The end is ``gap`` after the last event.

    An event that comes exactly ``gap`` after the one before still belongs to the visit. A stream needs
    a watermark and gives each visit once it is closed; its state holds open visits, which merge when
    an event falls between two. On a batch, events are first summed up in cells as wide as the gap,
    within which no gap can be, so that tasks send on one row per user and cell; visits are then
    runs of cells, and a user with most of the events has no more rows than the time has cells.
    Events without a user are one user's; events without a time are left out.
    """
    if events.isStreaming:
        visits = events.groupBy(F.session_window("event_time", gap), "user_id")
        return visits.agg(F.count(F.lit(1)).alias("n_events"), F.avg("rating").alias("avg_rating")).select(
            "user_id",
            F.col("session_window.start").alias("session_start"),
            F.col("session_window.end").alias("session_end"),
            "n_events",
            "avg_rating",
        )
    width = _micros(gap)
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    cells = (
        events.filter("event_time IS NOT NULL")
        .groupBy("user_id", F.floor(at / width).alias("cell"))
        .agg(
            F.min(at).alias("first"),
            F.max(at).alias("last"),
            F.count(F.lit(1)).alias("n"),
            F.count("rating").alias("n_rated"),
            F.sum("rating").alias("rated"),
        )
    )
    order = Window.partitionBy("user_id").orderBy("cell")
    apart = F.col("first") - F.lag("last").over(order) > width
    begins = cells.withColumn("begins", F.coalesce(apart, F.lit(True)).cast("int"))
    numbered = begins.withColumn("visit", F.sum("begins").over(order))
    visits = numbered.groupBy("user_id", "visit").agg(
        F.timestamp_micros(F.min("first")).alias("session_start"),
        F.timestamp_micros(F.max("last") + width).alias("session_end"),
        F.sum("n").alias("n_events"),
        (F.sum("rated") / F.nullif(F.sum("n_rated"), F.lit(0))).alias("avg_rating"),
    )
    return visits.drop("visit")


def _micros(span: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {span}"))
