"""Two versions of a table compared row by row, repeated rows included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.skew import repeated


def change_feed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each different row with its copies in both versions, and what became of it.

    Added are ``n_old``, ``n_new`` and ``change``: added, removed, more, fewer or same. Rows are equal if
    all columns are, nulls included. Both versions are counted in one pass with partial counts, so a
    row of which there are many copies is one row per task in the shuffle, and there is no join.
    """
    names = old.columns
    sides = old.select(*names, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        new.select(*names, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    counts = sides.groupBy(*names).agg(F.sum("_old").alias("n_old"), F.sum("_new").alias("n_new"))
    before, after = F.col("n_old"), F.col("n_new")
    change = (
        F.when(before == 0, "added").when(after == 0, "removed").when(after > before, "more").when(after < before, "fewer")
    )
    return counts.withColumn("change", change.otherwise("same"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of ``left``, each as often as it has more copies there than in ``right``."""
    counts = change_feed(left, right).filter("n_old > n_new")
    return repeated(counts.withColumn("_n", F.col("n_old") - F.col("n_new")).select(*left.columns, "_n"), "_n")


def multiset_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of both, each as often as the side with fewer copies has it."""
    counts = change_feed(left, right).filter("n_old > 0 AND n_new > 0")
    return repeated(counts.withColumn("_n", F.least("n_old", "n_new")).select(*left.columns, "_n"), "_n")
