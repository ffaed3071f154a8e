"""Activity of a user that fades with time, kept as state of its own."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Activity halves in this time, and is over this long after the last event.
HALF_LIFE = "10 minutes"
IDLE = "30 minutes"

OUT = "user_id bigint, first_event timestamp, last_event timestamp, n_events bigint, activity double"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def decayed_activity(events: DataFrame, half_life: str = HALF_LIFE, idle: str = IDLE) -> DataFrame:
    """The activity at the last event of each phase of a user, a phase being over when ``idle`` has passed.

    An event adds 1, and what is there halves in every ``half_life``. The sum is that of all events of
    the phase at its last one, so late events within the watermark and the cut into micro-batches do not
    change it. Times without a user are left out, as are events without a time.

    A batch sums events up in cells as wide as ``idle``, as a visit does, and then brings cells to the
    time of the phase's end. A stream keeps the open phases of each user as a map by their first event,
    with a timer for each end; an event may lengthen a phase or make two of them one. The state
    store must be the RocksDB one, see ``use_state_store``.
    """
    known = events.filter("user_id IS NOT NULL AND event_time IS NOT NULL")
    return _streamed(known, half_life, idle) if events.isStreaming else _batch(known, half_life, idle)


def use_state_store(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _micros(span: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {span}"))


def _batch(events: DataFrame, half_life: str, idle: str) -> DataFrame:
    wide, half = _micros(idle), _micros(half_life)
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    start = F.floor(at / wide) * wide

    def faded(micros: Column) -> Column:
        return F.pow(F.lit(2.0), -micros / half)

    # Seen from the start of a cell, so that partial sums need not know its last event.
    cells = events.groupBy("user_id", start.alias("start")).agg(
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.sum(faded(start - at)).alias("ahead"),
    )
    cells = cells.withColumn("activity", F.col("ahead") * faded(F.col("last") - F.col("start")))
    order = Window.partitionBy("user_id").orderBy("start")
    begins = F.coalesce(F.col("first") - F.lag("last").over(order) > wide, F.lit(True)).cast("int")
    phases = cells.withColumn("begins", begins).withColumn("phase", F.sum("begins").over(order))
    whole = phases.withColumn("end", F.max("last").over(Window.partitionBy("user_id", "phase")))
    return whole.groupBy("user_id", "phase").agg(
        F.timestamp_micros(F.min("first")).alias("first_event"),
        F.timestamp_micros(F.max("last")).alias("last_event"),
        F.sum("n").alias("n_events"),
        F.sum(F.col("activity") * faded(F.col("end") - F.col("last"))).alias("activity"),
    ).drop("phase")


class Phases(StatefulProcessor):
    """Open phases of a user in microseconds: first event to last event, number of events and activity."""

    def __init__(self, half: int, idle: int):
        self.half, self.idle = half, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("phases", "first bigint", "last bigint, n bigint, activity double")

    def _added(self, a: tuple, b: tuple) -> tuple:
        """Two phases as one: each activity fades up to the later end."""
        (first, last, n, activity), (first_b, last_b, n_b, activity_b) = a, b
        end = max(last, last_b)
        total = activity * 2.0 ** ((last - end) / self.half) + activity_b * 2.0 ** ((last_b - end) / self.half)
        return min(first, first_b), end, n + n_b, total

    def _touch(self, a: tuple, b: tuple) -> bool:
        return a[0] - b[1] <= self.idle and b[0] - a[1] <= self.idle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = [(first[0], *phase) for first, phase in self.open.iterator()]
        phases = list(known)
        for batch in rows:
            # What a batch adds is first made into phases of its own; only these meet the open ones.
            fresh: list[tuple] = []
            for at in sorted(batch["at"].tolist()):
                event = (at, at, 1, 1.0)
                if fresh and self._touch(fresh[-1], event):
                    fresh[-1] = self._added(fresh[-1], event)
                else:
                    fresh.append(event)
            for phase in fresh:
                met = [other for other in phases if self._touch(other, phase)]
                phases = [other for other in phases if not self._touch(other, phase)]
                for other in met:
                    phase = self._added(phase, other)
                phases.append(phase)
        left = set(phases)
        for phase in set(known) - left:
            self.open.removeKey((phase[0],))
            self.handle.deleteTimer(self._due(phase))
        for phase in phases:
            self.open.updateValue((phase[0],), phase[1:])
            self.handle.registerTimer(self._due(phase))
        return iter([])

    def _due(self, phase: tuple) -> int:
        """Milliseconds when no event can lengthen the phase any more."""
        return math.ceil((phase[1] + self.idle + 1) / 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        over = [(first[0], *phase) for first, phase in self.open.iterator()]
        over = sorted(phase for phase in over if self._due(phase) <= now)
        for phase in over:
            self.open.removeKey((phase[0],))
        if over:
            first, last, n, activity = (list(column) for column in zip(*over, strict=True))
            yield pd.DataFrame({"user_id": [key[0]] * len(over), "first": first, "last": last, "n": n, "activity": activity})

    def close(self) -> None:
        pass


def _streamed(events: DataFrame, half_life: str, idle: str) -> DataFrame:
    spark = events.sparkSession
    spans = spark.range(1).select(_micros(half_life), _micros(idle)).first()
    at = events.select("user_id", "event_time", F.unix_micros("event_time").alias("at"))
    phases = at.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=Phases(*spans),
        outputStructType="user_id bigint, first bigint, last bigint, n bigint, activity double",
        outputMode="Append",
        timeMode="EventTime",
    )
    return phases.select(
        "user_id",
        F.timestamp_micros("first").alias("first_event"),
        F.timestamp_micros("last").alias("last_event"),
        F.col("n").alias("n_events"),
        "activity",
    )
