"""Work along an order within keys, also where one key has most of the rows.

Rows are dealt by ranges of key and order, so a key with many rows covers many ranges. Each range is
worked off on its own, and what a range hands on to the next ones, a single row, is added in a
second step. Nothing is iterated row by row and no two rows of a key are paired.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.session import written


def _in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with the number of the range of the global order that a row is in, as ``_range``."""
    return df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())


def _so_far(order: Sequence[str]) -> Window:
    here = Window.partitionBy("_range", "_key").orderBy(*order)
    return here.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    take: Mapping[str, Column],
    ties: Sequence[str] = (),
    strict: bool = False,
    tolerance: Column | None = None,
) -> DataFrame:
    """Adds to each left row what its key's latest right row had, at the row's time or before.

    ``take`` names the new columns and says how right rows give them. Of right rows with one time the
    one with the largest ``ties`` counts. A ``strict`` join takes rows before the time only. Right
    rows older than ``tolerance`` do not count; nothing older is looked for then. Left rows without
    partner, or without key or time, have nulls. Both sides are dealt by ranges of key and time; a
    range begins with the last right row of the ranges before, if that is of its first key.
    """
    kept, key = left.columns, F.struct(*on)

    def complete(time: str) -> Column:
        found = F.col(time).isNotNull()
        for name in on:
            found = found & F.col(name).isNotNull()
        return found

    given = F.struct(F.col(right_time).alias("_since"), *[column.alias(name) for name, column in take.items()])
    rights = right.filter(complete(right_time)).select(
        key.alias("_key"),
        F.col(right_time).alias("_at"),
        F.lit(1 if strict else 0).alias("_side"),
        F.struct(F.lit(0).alias("_"), *ties).alias("_tie"),
        F.lit(0).cast("bigint").alias("_spread"),
        given.alias("_given"),
    )
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in rights.schema if f.name in ("_tie", "_given")}
    # Left rows of one moment are told apart, so that a range may end between them.
    lefts = left.filter(complete(left_time)).select(
        key.alias("_key"),
        F.col(left_time).alias("_at"),
        F.lit(0 if strict else 1).alias("_side"),
        nothing["_tie"].alias("_tie"),
        F.xxhash64(*kept).alias("_spread"),
        nothing["_given"].alias("_given"),
        F.struct(*kept).alias("_row"),
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)
    order = ["_at", "_side", "_tie", "_spread"]
    latest = F.last("_given", ignorenulls=True).over(_so_far(order))
    ranged = _in_ranges(both, [F.col(name) for name in ["_key", *order]])
    table = written(ranged.withColumn("_given", latest), "asof")
    ends = table.groupBy("_range").agg(F.max_by(F.struct("_key", "_given"), F.struct("_key", *order)).alias("end"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = F.last(F.when(F.col("end._given").isNotNull(), F.col("end")), ignorenulls=True).over(before)
    # One row per range: at most spark.sql.shuffle.partitions of them.
    carried = F.broadcast(ends.select("_range", handed.alias("_carried")))
    found = F.coalesce("_given", F.when(F.col("_carried._key") == F.col("_key"), F.col("_carried._given")))
    rows = table.filter(F.col("_row").isNotNull()).join(carried, "_range").withColumn("_found", found)
    if tolerance is not None:
        rows = rows.withColumn("_found", F.when(F.col("_found._since") >= F.col("_at") - tolerance, F.col("_found")))
    joined = rows.select("_row.*", *[F.col(f"_found.{name}").alias(name) for name in take])
    alone = left.filter(~complete(left_time))
    return joined.unionByName(alone, allowMissingColumns=True)


def running_totals(df: DataFrame, on: Sequence[str], order: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Adds for each row the sums over its key's rows so far, in the given order.

    The order must tell all rows of a key apart, or equal rows share their sums in any order. Sums of
    ranges are made first; then the sums of the ranges before are added to the first key of each.
    Without keys, ``on`` is empty and all rows are one key. A null key is a key. Null values add nothing.
    """
    key = F.struct(*on) if on else F.struct(F.lit(0).alias("_"))
    ranged = _in_ranges(df.withColumn("_key", key), [F.col(name) for name in ["_key", *order]])
    sums = {name: F.coalesce(F.sum(value).over(_so_far(order)), F.lit(0)) for name, value in totals.items()}
    table = written(ranged.withColumns(sums), "running")
    last = F.max_by(F.struct("_key", *totals), F.struct("_key", *order))
    ends = table.groupBy("_range").agg(last.alias("end"))
    # One row per range, and of it one row for each range that ends with the key.
    of_key = Window.partitionBy("end._key").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ends.select("_range", F.struct(F.col("end._key").alias("_key"), *[F.sum(f"end.{name}").over(of_key).alias(name) for name in totals]).alias("end"))
    carried = summed.select("_range", F.lag("end").over(Window.orderBy("_range")).alias("_carried"))
    rows = table.join(F.broadcast(carried), "_range")
    same = F.col("_carried._key").eqNullSafe(F.col("_key"))
    full = {name: F.col(name) + F.coalesce(F.when(same, F.col(f"_carried.{name}")), F.lit(0)) for name in totals}
    return rows.withColumns(full).select(*df.columns, *totals)


def totals_by_time(df: DataFrame, on: Sequence[str], time: str, totals: Mapping[str, Column]) -> DataFrame:
    """For each key and time that occur, the sums over all rows of the key up to then, the time included.

    Rows without a time are left out. Rows of one time are summed up before anything is shuffled.
    """
    return running_totals(_at_times(df, on, time, totals), on, [time], {name: F.col(f"_{name}") for name in totals}).select(*on, time, *totals)


def trailing_totals(df: DataFrame, on: Sequence[str], time: str, span: Column, totals: Mapping[str, Column]) -> DataFrame:
    """For each key and time that occur, the sums over the key's rows of the last ``span``.

    A row exactly ``span`` old no longer counts. The difference of two running sums, the second found
    by an as-of join, so the work does not depend on how many rows a span holds; sum exact types
    rather than floating ones.
    """
    upto = written(totals_by_time(df, on, time, totals), "totals")
    older = {f"_old_{name}": F.col(name) for name in totals}
    edges = upto.withColumn("_edge", F.col(time) - span)
    found = asof_join(edges, upto, on, "_edge", time, older)
    left = {name: F.col(name) - F.coalesce(f"_old_{name}", F.lit(0)) for name in totals}
    return found.withColumns(left).select(*on, time, *totals)


def _at_times(df: DataFrame, on: Sequence[str], time: str, totals: Mapping[str, Column]) -> DataFrame:
    timed = df.filter(F.col(time).isNotNull())
    return timed.groupBy(*on, time).agg(*[F.sum(value).alias(f"_{name}") for name, value in totals.items()])
