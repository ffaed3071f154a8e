"""What running queries report about late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

LATE_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("operator", T.StringType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_dropped_late", T.LongType()),
    ]
)


class LateRows(StreamingQueryListener):
    """Appends to a table what each stateful step of each batch dropped as late.

    Spark keeps the progress of recent batches only; this keeps that of all. Add it with
    ``spark.streams.addListener`` before the queries start.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [
            (
                str(progress.id),
                str(progress.runId),
                progress.batchId,
                state.operatorName,
                progress.eventTime.get("watermark"),
                progress.numInputRows,
                state.numRowsDroppedByWatermark,
            )
            for state in progress.stateOperators
        ]
        if rows:
            # A few rows of text and numbers per batch.
            table = self.spark.createDataFrame(rows, LATE_SCHEMA).coalesce(1)
            table.write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        pass


def late_data_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows each stateful step dropped as late, for every batch that ``LateRows`` has seen.

    A row that falls into several sliding windows counts once for each of them. A batch that a
    restart reports again counts once.
    """
    return spark.read.schema(LATE_SCHEMA).parquet(path).dropDuplicates(["query_id", "batch_id", "operator"])
