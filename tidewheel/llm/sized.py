"""Small sides of joins, by a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a few numbers that an executor can hold without notice.
FEW = 1_000_000


def broadcast_if_few(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; beyond, Spark shuffles the join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
