"""Choosing a list for each user of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.scoring import top_k_by_factors
from tidewheel.operators.skew import salted_join, salts_for_all
from tidewheel.operators.summary import COLD_USER
from tidewheel.session import written

# Fixed value: the segment whose list everybody else gets.
DEFAULT_SEGMENT = 0

OUT = ["user_id", "path", "rank", "item_id", "score"]


def global_trending_top_k(window_metrics: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best items of the newest window in the table."""
    newest = window_metrics.agg(F.max("window_end")).scalar()
    return (
        window_metrics.filter(F.col("window_end") == newest)
        .groupBy("item_id")
        .agg(F.max("engagement_score").alias("engagement_score"))
        .orderBy(F.col("engagement_score").desc(), F.col("item_id"))
        .limit(k)
        .select(F.col("item_id").cast("bigint").alias("item_id"), F.col("engagement_score").alias("score"))
    )


def _as_list(rows: DataFrame) -> DataFrame:
    """At most k ranked rows as one sorted array in one row."""
    return rows.agg(F.sort_array(F.collect_list(F.struct("rank", "item_id", "score"))).alias("list"))


def _trending_list(window_metrics: DataFrame, k: int) -> DataFrame:
    """The trending rows as one array in one row, numbered by falling score."""
    falling = F.struct((-F.col("score")).alias("order"), "item_id", "score")
    rows = global_trending_top_k(window_metrics, k).agg(F.array_sort(F.collect_list(falling)).alias("best"))

    def numbered(entry: Column, place: Column) -> Column:
        return F.struct(
            (place + 1).alias("rank"), entry["item_id"].alias("item_id"), entry["score"].alias("score")
        )

    return rows.select(F.transform("best", numbered).alias("list"))


def segment_lists(segment_top: DataFrame, k: int = 5) -> DataFrame:
    """One row per segment with its list of at most ``k`` items."""
    rows = _segment_rows(segment_top, k)
    return rows.groupBy("segment").agg(
        F.sort_array(F.collect_list(F.struct("rank", "item_id", "score"))).alias("list")
    )


def _segment_rows(segment_top: DataFrame, k: int) -> DataFrame:
    return segment_top.filter(F.col("rank") <= k).select(
        "segment",
        F.col("rank").cast("int").alias("rank"),
        F.col("item_idx").cast("bigint").alias("item_id"),
        F.col("avg_rating").cast("double").alias("score"),
    )


def segment_fallback(users: DataFrame, segments: DataFrame, segment_top: DataFrame, k: int = 5) -> DataFrame:
    """The list of their segment for users that have one."""
    numbered = users.select("user_id").distinct().join(
        _one_segment_per_user(segments).select("user_id", "segment"), "user_id"
    )
    # Few segments, each with many users: all of them are spread.
    lists = salted_join(numbered, segment_lists(segment_top, k), "segment", salts_for_all(numbered))
    path = F.concat(F.lit("segment_fallback_"), F.col("segment").cast("string"))
    return lists.select("user_id", path.alias("path"), F.explode("list").alias("e")).select(
        "user_id", "path", "e.*"
    )


def default_fallback(
    users: DataFrame, segment_top: DataFrame, segment: int = DEFAULT_SEGMENT, k: int = 5
) -> DataFrame:
    """One segment's list for every user."""
    rows = _segment_rows(segment_top, k).filter(F.col("segment") == segment)
    everyone = users.select("user_id").distinct()
    return everyone.select(
        "user_id", F.lit("default_fallback").alias("path"), F.explode(_as_list(rows).scalar()).alias("e")
    ).select("user_id", "path", "e.*")


def _one_segment_per_user(segments: DataFrame) -> DataFrame:
    first = F.min(F.struct("segment", "segment_label")).alias("_s")
    return (
        segments.groupBy(F.col("user_idx").cast("bigint").alias("user_id"))
        .agg(first)
        .select("user_id", "_s.segment", "_s.segment_label")
    )


def _tag(
    users: DataFrame, user_factors: DataFrame, segments: DataFrame, has_trending: Column
) -> DataFrame:
    """Each user once, with the way it is served."""
    known = user_factors.select(F.col("id").cast("bigint").alias("user_id"), F.lit(True).alias("_in_model"))
    has_model = user_factors.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    tagged = (
        users.select(F.col("user_id").cast("bigint").alias("user_id"))
        .distinct()
        .join(known.dropDuplicates(["user_id"]), "user_id", "left")
        .join(_one_segment_per_user(segments), "user_id", "left")
    )
    cold = (F.col("user_id") == COLD_USER) | ~has_model
    label = F.coalesce("segment_label", F.lit("Unknown"))
    path = (
        F.when(cold & has_trending, "cold_start_global")
        .when(cold, "default_fallback")
        .when(F.col("_in_model"), F.concat(F.lit("als_segment_"), label))
        .when(
            F.col("segment").isNotNull(),
            F.concat(F.lit("segment_fallback_"), F.col("segment").cast("string")),
        )
        .otherwise("default_fallback")
    )
    return tagged.select("user_id", "segment", path.alias("path"))


def recommend(
    users: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    segments: DataFrame,
    segment_top: DataFrame,
    window_metrics: DataFrame,
    k: int = 5,
) -> DataFrame:
    """``(user_id, path, rank, item_id, score)`` for every user of the table.

    Cold users, and all users while there are no factors, get the trending list, or the
    default list if nothing trends. Users with factors get their best items by inner
    product, others the list of their segment, and the rest the default list. Any table may
    be empty. A user whose list is empty keeps one row without an item.
    """
    trending = _trending_list(window_metrics, k).scalar()
    default_rows = _segment_rows(segment_top, k).filter(F.col("segment") == DEFAULT_SEGMENT)
    default = _as_list(default_rows).scalar()
    # Read by both branches below, so the joins of the tags run once.
    tagged = written(_tag(users, user_factors, segments, F.size(trending) > 0), "tagged")
    by_factors = F.col("path").startswith("als_segment_")

    of_segment = F.when(F.col("path").startswith("segment_fallback_"), F.col("segment"))
    listed = tagged.filter(~by_factors).select("user_id", "path", of_segment.alias("segment"))
    chosen = (
        F.when(F.col("path") == "cold_start_global", trending)
        .when(F.col("path") == "default_fallback", default)
        .otherwise(F.col("list"))
    )
    from_lists = (
        salted_join(listed, segment_lists(segment_top, k), "segment", salts_for_all(listed), "left")
        .select("user_id", "path", F.explode_outer(chosen).alias("e"))
        .select("user_id", "path", "e.*")
    )

    vectors = user_factors.select(F.col("id").cast("bigint").alias("id"), "features").dropDuplicates(["id"])
    asking = tagged.filter(by_factors).select(F.col("user_id").alias("id"), "path")
    from_factors = top_k_by_factors(
        asking.join(vectors, "id"), item_factors, k, carry=["path"], n_users=asking.count()
    )
    return from_factors.select(*OUT).unionByName(from_lists.select(*OUT))


def nest_recommendations(recommendations: DataFrame) -> DataFrame:
    """One row per user with its list in order."""
    entry = F.when(F.col("rank").isNotNull(), F.struct("rank", "item_id", "score"))
    return recommendations.groupBy("user_id", "path").agg(
        F.sort_array(F.collect_list(entry)).alias("recommendations")
    )
