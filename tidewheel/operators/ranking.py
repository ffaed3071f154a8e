"""Best-of lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def segment_top_n(stats: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` items with the best mean rating in each segment, more ratings first among equals.

    Few segments hold all rows, but each task passes on only its own best ``n`` of each
    (Spark limits the groups before the shuffle because of the rank filter).
    """
    best = Window.partitionBy("segment").orderBy(
        F.col("avg_rating").desc(), F.col("n_ratings").desc(), F.col("item_idx")
    )
    return stats.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def top_engagement(metrics: DataFrame, n: int) -> DataFrame:
    return metrics.orderBy(F.col("engagement_score").desc(), F.col("item_id")).limit(n)


def latest_alerts(alerts: DataFrame, n: int = 50) -> DataFrame:
    return alerts.orderBy(
        F.col("timestamp").desc(), F.col("alert_type"), F.col("user_id"), F.col("item_id"), F.col("message")
    ).limit(n)
