"""Ways of users from item to item, as a table function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, udtf


NAME = "item_steps"


@udtf
class ItemSteps:
    """One row per step: what the table is dealt by, then item and time before and after.

    The columns out follow from the table in: its first column deals it, the second is the item, the
    third orders it, and the item may be of any type. Only the last row is kept.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        fields = table.dataType.fields
        if len(fields) != 3:
            raise ValueError("a key, an item and a time are needed")
        key, item, time = fields
        out = T.StructType(
            [
                T.StructField(key.name, key.dataType),
                T.StructField("from_item", item.dataType),
                T.StructField("to_item", item.dataType),
                T.StructField("left_at", time.dataType),
                T.StructField("reached_at", time.dataType),
            ]
        )
        return AnalyzeResult(
            schema=out,
            partitionBy=[PartitioningColumn(key.name)],
            orderBy=[OrderingColumn(time.name), OrderingColumn(item.name)],
        )

    def __init__(self):
        self.last = None

    def eval(self, row: T.Row):
        key, item, time = row
        if self.last is not None:
            before, left_at = self.last
            yield key, before, item, left_at, time
        self.last = item, time


def item_steps(events: DataFrame, key: str = "user_id", item: str = "item_id", time: str = "event_time") -> DataFrame:
    """Each step of a user from an item to the next one: from_item, to_item, left_at, reached_at.

    Events of one time are taken in the order of items. The function sees one user at a time and keeps one
    row, so memory does not depend on how many events a user has. Rows without user or time are left out.
    """
    spark: SparkSession = events.sparkSession
    spark.udtf.register(NAME, ItemSteps)
    rows = events.select(key, item, time).filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    return spark.sql(f"SELECT * FROM {NAME}(TABLE({{rows}}))", rows=rows)


def path_counts(steps: DataFrame) -> DataFrame:
    """How often users went from one item to another, and how long that took at the least."""
    seconds = F.unix_micros("reached_at") - F.unix_micros("left_at")
    return steps.groupBy("from_item", "to_item").agg(
        F.count(F.lit(1)).alias("n_steps"), (F.min(seconds) / 1e6).alias("least_seconds")
    )
