"""From event messages to window metrics, alerts, snapshots and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewheel.operators.events import parse_events, validate_events
from tidewheel.operators.windows import (
    LATENESS,
    SLIDE,
    WINDOW,
    spike_alerts,
    windowed_item_metrics,
    windowed_user_activity,
    with_event_watermark,
)
from tidewheel.session import use_utc
from tidewheel.streaming import sinks


def start(
    envelope: DataFrame,
    folder: str,
    checkpoints: str,
    interval: str | None = sinks.INTERVAL,
    window: str = WINDOW,
    slide: str = SLIDE,
    lateness: str = LATENESS,
) -> dict[str, StreamingQuery]:
    """Starts the queries over a stream of ``(value, timestamp)``; returns them by name.

    ``messages`` parses the topic, once, into good and bad messages. The others follow the table
    of good ones: ``windows`` stores closed item windows and the trending ones among them,
    ``activity`` closed user windows and the spikes among them, ``late`` the rows that came too late for
    windows, ``snapshot`` the latest events and item metrics and all alerts on them. All tables but the
    snapshots are batches, read by ``read_batches`` and put together by ``compact_batches``. Without an ``interval`` everything that is there is worked off.
    """
    spark = envelope.sparkSession
    use_utc(spark)

    def at(name: str) -> str:
        return f"{folder.rstrip('/')}/{name}"

    def check(name: str) -> str:
        return f"{checkpoints.rstrip('/')}/{name}"

    validated = validate_events(parse_events(envelope))
    parsed = sinks.dead_letter_sink(validated, at("clean_events"), at("dead_letters"), check("messages"), interval)
    if interval is None:
        parsed.awaitTermination()
    clean = sinks.stored_events(spark, at("clean_events"))
    timed = with_event_watermark(clean, lateness)
    return {
        "messages": parsed,
        "windows": sinks.windows_sink(
            windowed_item_metrics(timed, window, slide),
            at("window_metrics"),
            at("trending"),
            check("windows"),
            interval,
        ),
        "activity": sinks.windows_sink(
            windowed_user_activity(timed, window, slide),
            at("user_windows"),
            at("spikes"),
            check("activity"),
            interval,
            spike_alerts,
        ),
        "late": sinks.late_rows_sink(clean, at("late_rows"), check("late"), interval, lateness),
        "snapshot": sinks.snapshot_sink(
            clean,
            at("live_events"),
            at("live_metrics"),
            at("live_alerts"),
            check("snapshot"),
            interval,
            lateness,
            window,
        ),
    }
