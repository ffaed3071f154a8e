"""Alerts with the activity that follows them, in batches and between two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.intervals import interval_join

# Fixed value: how long after an alert activity counts.
WITHIN = "1 hour"

OUT = ["user_id", "window_start", "window_end", "item_id", "rating", "event_time"]


def followed_by(alerts: DataFrame, events: DataFrame, within: str = WITHIN) -> DataFrame:
    """Each alert with the user's events from the end of its window on, for ``within``.

    An alert that nothing follows has one row without event. ``alerts`` has user_id, window_start and
    window_end and one row for each of these. Alerts without a user are left out.

    Two streams need a watermark each, on window_end and on event_time: an event is kept until no
    alert can come that it follows, an alert until no event can come that follows it, and only then
    is it known that none has. A batch is joined by cells of time, so that a user with many alerts
    and many events is not joined row by row.
    """
    marks = alerts.filter("user_id IS NOT NULL").select("user_id", "window_start", "window_end")
    until = F.col("window_end") + F.expr(f"INTERVAL {within}")
    if alerts.isStreaming:
        other = events.select(F.col("user_id").alias("_user"), "item_id", "rating", "event_time")
        near = (F.col("user_id") == F.col("_user")) & (F.col("event_time") >= F.col("window_end")) & (F.col("event_time") < until)
        return marks.join(other, near, "left").select(*OUT)
    take = {name: F.col(name) for name in ("item_id", "rating", "event_time")}
    spans = marks.withColumn("_until", until)
    found = interval_join(spans, events, ["user_id"], "window_end", "_until", "event_time", take).drop("_until")
    keys = ["user_id", "window_start", "window_end"]
    alone = marks.join(found.select(*keys).distinct(), keys, "left_anti")
    return found.unionByName(alone, allowMissingColumns=True).select(*OUT)
