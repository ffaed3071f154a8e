"""Joins whose keys may be very uneven, and exact positions in a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.session import written

# Equal rows that are written out in one go.
RUN = 1_000


def fan_out(spark: SparkSession) -> int:
    """Tasks a shuffle is planned for, and so the parts a key with all rows should be cut into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more rows than an even share of a task, and the parts to cut them into.

    At most as many rows as there are tasks, stored, so that both sides of a join see the same.
    Rows are counted by key with partial sums; give ``df`` as a stored table, as it is read twice.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return heavy_by_count(counts, key, "_n", df.count())


def heavy_by_count(counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """The same from a table of counts."""
    parts = F.ceil(F.col(n) * fan_out(counts.sparkSession) / F.lit(max(total, 1))).cast("int")
    cut = counts.filter(F.col(key).isNotNull()).select(key, parts.alias("parts"))
    return written(cut.filter("parts > 1"), "heavy")


def salts_for_all(df: DataFrame) -> Column:
    """Every key cut into as many parts as there are tasks; for a handful of keys."""
    return F.lit(fan_out(df.sparkSession))


def salted_join(left: DataFrame, right: DataFrame, on: str, parts: DataFrame | Column, how: str = "inner") -> DataFrame:
    """Equi-join that cuts the left rows of a key into parts.

    ``parts`` is a table of heavy keys as ``heavy_keys`` makes it, or one expression for every key.
    Left rows take a part by their content, so a recomputed task gives the same one; rows that
    agree in all columns stay together, so combine those first where there are many. Right rows
    of a key are repeated once per part. Keys with one part join as usual; rows without a key
    never match and are spread over all tasks. Right and full outer joins are ``salted_outer_join``,
    as repeated right rows would show here.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")

    def told(df: DataFrame) -> DataFrame:
        if isinstance(parts, Column):
            return df.withColumn("_parts", F.greatest(parts, F.lit(1)))
        # As many rows as there are tasks at most.
        known = F.broadcast(parts.select(on, F.col("parts").alias("_parts")))
        return df.join(known, on, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    spread = F.when(F.col(on).isNull(), F.lit(fan_out(left.sparkSession))).otherwise(F.col("_parts"))
    salted = told(left).withColumn("_salt", F.pmod(F.xxhash64(*left.columns), spread).cast("int"))
    repeated = told(right.filter(F.col(on).isNotNull()))
    repeated = repeated.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return salted.drop("_parts").join(repeated.drop("_parts"), [on, "_salt"], how).drop("_salt")


def salted_outer_join(
    left: DataFrame, right: DataFrame, on: str, left_parts: DataFrame | Column, right_parts: DataFrame | Column, how: str = "full"
) -> DataFrame:
    """Right or full outer equi-join of two sides that may both have heavy keys.

    Left rows are joined as in ``salted_join``. A right row that is repeated for the parts of its key
    cannot tell whether another copy has found a partner, so the right rows without partner
    come from a second join, in which the right side is the one that is cut, with the distinct left
    keys. Rows without a key match nothing and are kept once on their side.
    """
    if how not in ("right", "full"):
        raise ValueError(f"not an outer join of the right side: {how}")
    matched = salted_join(left, right, on, left_parts, "inner" if how == "right" else "left")
    keys = left.filter(F.col(on).isNotNull()).select(on).distinct()
    alone = salted_join(right, keys, on, right_parts, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def repeated(counted: DataFrame, n: str) -> DataFrame:
    """Each row as often as its column ``n`` says, without that column.

    A count is cut into runs that are dealt out before they become rows, so that many copies of one
    row are made by many tasks.
    """
    names = [name for name in counted.columns if name != n]
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / RUN).cast("long"))
    dealt = counted.withColumn("_run", F.explode(runs))
    length = F.least(F.lit(RUN).cast("long"), F.col(n) - F.col("_run") * RUN).cast("int")
    dealt = dealt.withColumn("_length", length).repartition(*names, "_run")
    return dealt.select(*names, F.explode(F.sequence(F.lit(1), F.col("_length")))).drop("col")


def with_position(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """0-based position of each row in a global order, without sorting in one task.

    The rows are sorted by range, numbered inside each range, and written out, and beside them
    the number of rows before each range, which is added when the result is read. The only
    unpartitioned window runs over one row per range.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    # The id holds the range in its upper bits and the place in the range in the lower 33.
    table = written(ranged, "position").select(
        *df.columns,
        F.shiftright("_slot", 33).alias("_range"),
        F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        table.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    # One row per range: at most spark.sql.shuffle.partitions of them.
    return table.join(F.broadcast(written(starts, "starts")), "_range").select(
        *df.columns, (F.col("_start") + F.col("_place")).alias(out)
    )
