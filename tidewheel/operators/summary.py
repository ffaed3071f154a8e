"""Aggregates over ratings, segments and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import engagement_score
from tidewheel.functions.scalars import SCORE_SECONDS
from tidewheel.operators.indexing import ratings_with_segment

# The id that stands for all users without a history, and the ratings an
# item needs in a segment to be ranked there.
COLD_USER = -1
MIN_RATINGS = 10


def dataset_summary(ratings: DataFrame) -> DataFrame:
    counts = ratings.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
    )
    cells = F.nullif(F.col("users").cast("double") * F.col("items"), F.lit(0.0))
    return counts.withColumn("sparsity", 1 - F.col("records") / cells)


def _with_percent(counts: DataFrame) -> DataFrame:
    """Adds each row's part of all rows; the total reads the counts' own shuffle again."""
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def rating_distribution(ratings: DataFrame) -> DataFrame:
    counts = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    return _with_percent(counts).orderBy("rating")


def segment_distribution(segments: DataFrame) -> DataFrame:
    counts = segments.groupBy("segment", "segment_label").agg(F.count(F.lit(1)).alias("n"))
    return _with_percent(counts).orderBy("segment", "segment_label")


def segment_item_stats(ratings: DataFrame, segments: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """Mean rating and count of each item in each segment, where there are enough."""
    return (
        ratings_with_segment(ratings, segments)
        .groupBy("segment", "item_idx")
        .agg(F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("n_ratings"))
        .filter(F.col("n_ratings") >= min_ratings)
    )


def segment_profile(ratings: DataFrame, segments: DataFrame) -> DataFrame:
    """What sets the segments apart: rating level, activity, breadth and recency."""
    stats = (
        ratings_with_segment(ratings, segments)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("n_ratings"),
            F.avg("rating").alias("avg_rating"),
            F.count_distinct("user_idx").alias("n_users"),
            F.count_distinct("item_idx").alias("n_items"),
            F.max("timestamp").alias("latest"),
        )
    )
    return stats.withColumn("ratings_per_user", F.col("n_ratings") / F.col("n_users"))


def item_metrics(events: DataFrame, seconds: float = SCORE_SECONDS) -> DataFrame:
    """Per item over a bounded set of events."""
    return (
        events.groupBy("item_id")
        .agg(F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("interaction_count"))
        .withColumn(
            "engagement_score",
            engagement_score(F.col("interaction_count"), F.col("avg_rating"), seconds),
        )
    )


def user_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("interaction_count"), F.avg("rating").alias("avg_rating")
    )


def stream_kpis(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("avg_rating"),
        F.count_distinct("user_id").alias("unique_users"),
    )


def rating_histogram(events: DataFrame) -> DataFrame:
    return events.groupBy("rating").agg(F.count(F.lit(1)).alias("n")).orderBy("rating")


def most_active_user(events: DataFrame) -> DataFrame:
    """The user with most events, the lowest id among equals, the cold id if there are none."""
    counts = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.max_by("user_id", F.struct(F.col("n"), -F.col("user_id")))
    return counts.agg(
        F.coalesce(first, F.lit(COLD_USER)).alias("user_id"),
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
    )


def event_mix(validated: DataFrame) -> DataFrame:
    """How many messages are normal, come from cold users, or are malformed.

    Takes the output of ``validate_events``; a well-formed message with a rating outside the
    scale is counted by its user.
    """
    malformed = F.col("reject_reason").isNotNull() & (F.col("reject_reason") != "rating_out_of_range")
    kind = (
        F.when(malformed, "malformed").when(F.col("user_id") == COLD_USER, "cold_start").otherwise("normal")
    )
    counts = validated.groupBy(kind.alias("event_class")).agg(F.count(F.lit(1)).alias("n"))
    return _with_percent(counts)
