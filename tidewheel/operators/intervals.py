"""Points in time joined to the intervals that hold them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.skew import heavy_keys, salted_join
from tidewheel.session import written


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    on: Sequence[str],
    start: str,
    end: str,
    time: str,
    take: Mapping[str, Column],
) -> DataFrame:
    """Each interval with every point of its key from ``start`` on and before ``end``.

    ``take`` names the columns that a point adds. Time is cut into cells whose width is a power of
    two microseconds; an interval takes the width next above its length and so lies in two cells at
    most, whatever the lengths of the others, and a point has a cell for each width that occurs,
    of which there are some dozens at most. Cells are joined as equal keys, those with many points in
    parts, and the times are then compared exactly. Rows without key or time, and intervals that
    end where they start or before, match nothing.
    """

    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    kept = intervals.columns
    length = micros(end) - micros(start)
    wide = intervals.filter(length > 0).select(
        F.struct(*kept).alias("_row"),
        F.struct(*on).alias("_key"),
        micros(start).alias("_start"),
        micros(end).alias("_end"),
        F.ceil(F.log2(length)).cast("int").alias("_level"),
    )
    for name in on:
        wide = wide.filter(F.col(f"_key.{name}").isNotNull())
    wide = written(wide, "intervals")
    cells = F.sequence(F.expr("shiftright(_start, _level)"), F.expr("shiftright(_end - 1, _level)"))
    reached = wide.withColumn("_cell", F.explode(cells))
    reached = reached.select(F.struct("_key", "_level", "_cell").alias("_cell"), "_row", "_start", "_end")
    # At most one for each bit of a time.
    levels = F.coalesce(wide.agg(F.sort_array(F.collect_set("_level"))).scalar(), F.array().cast("array<int>"))
    given = F.struct(*[column.alias(name) for name, column in take.items()])
    dots = points.select(F.struct(*on).alias("_key"), micros(time).alias("_at"), given.alias("_given"))
    for name in on:
        dots = dots.filter(F.col(f"_key.{name}").isNotNull())
    dots = dots.filter("_at IS NOT NULL").withColumn("_level", F.explode(levels))
    cell = F.struct("_key", "_level", F.expr("shiftright(_at, _level)").alias("_cell"))
    dots = written(dots.select(cell.alias("_cell"), "_at", "_given"), "points")
    met = salted_join(dots, reached, "_cell", heavy_keys(dots, "_cell"))
    return met.filter("_at >= _start AND _at < _end").select("_row.*", "_given.*")
