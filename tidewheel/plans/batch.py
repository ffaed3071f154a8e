"""From review files to stored tables, and from those to recommendations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewheel.operators import cleaning, indexing, models, ranking, recommend, summary
from tidewheel.session import scratch, use_utc, written
from tidewheel.sources import files
from tidewheel.streaming.sinks import register_window_metrics


@dataclass(frozen=True)
class Store:
    """Where the tables of one run lie."""

    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table and returns the stored one."""
        files.write_parquet(df, self.path(name))
        return files.read_parquet(df.sparkSession, self.path(name), df.schema)

    def load(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        """A stored table, empty if there is none yet."""
        return files.read_optional(spark, self.path(name), schema)


def prepare(
    spark: SparkSession, store: Store, reviews: str, metadata: str | None = None
) -> DataFrame:
    """Stores cleaned ratings with dense ids, both id tables, and the titles; returns the ratings."""
    use_utc(spark)
    cleaned = store.save(cleaning.clean_ratings(files.read_reviews(spark, reviews)), "cleaned")
    with scratch(spark):
        users = store.save(indexing.fit_dense_index(cleaned, "user_id"), "user_index")
        items = store.save(indexing.fit_dense_index(cleaned, "item_id"), "item_index")
        with_users = indexing.apply_dense_index(cleaned, users, "user_id", "user_idx")
        ratings = store.save(indexing.apply_dense_index(with_users, items, "item_id", "item_idx"), "ratings")
    if metadata is not None:
        named = indexing.item_titles(
            items.withColumnRenamed("idx", "item_idx"), files.read_item_metadata(spark, metadata), "record_order"
        )
        store.save(named, "item_titles")
    return ratings


def train(
    spark: SparkSession,
    store: Store,
    params: models.AlsParams = models.AlsParams(),
    **tuning,
) -> DataFrame:
    """Stores the factors of users and items; returns the one-row summary."""
    ratings = files.read_parquet(spark, store.path("ratings"), files.RATINGS_SCHEMA)
    training, test = cleaning.train_test_split(ratings)
    with scratch(spark):
        best = models.tune_als_if_needed(training, written(test, "test"), params=params, **tuning)
    models.export_factors(best.model, store.folder)
    return models.training_summary(best.model, best.rmse)


def segment(
    spark: SparkSession, store: Store, k: int = models.SEGMENTS, min_ratings: int = summary.MIN_RATINGS, n: int = 5
) -> DataFrame:
    """Stores the segments of users and the best items of each segment; returns the latter.

    Users with factors are clustered, all others that rated anything get a segment by vote.
    """
    factors = files.read_parquet(spark, store.path("user_factors"), files.FACTOR_SCHEMA)
    ratings = files.read_parquet(spark, store.path("ratings"), files.RATINGS_SCHEMA)
    with scratch(spark):
        assigned = written(models.assign_segments(models.fit_segments(factors, k), factors), "assigned")
        # Users that the model does not know get the segment whose users rated the same items most.
        voted = models.segment_by_history(ratings, assigned).drop("votes")
        voted = indexing.segment_label(voted).select(*assigned.columns)
        segments = store.save(assigned.unionByName(voted), "user_segments")
        stats = summary.segment_item_stats(ratings, segments, min_ratings)
        return store.save(ranking.segment_top_n(stats, n), "segment_top")


def serve(
    spark: SparkSession, store: Store, users: DataFrame, window_metrics: DataFrame | None = None, k: int = 5
) -> DataFrame:
    """Recommendations for a table of users from whatever is stored.

    The window metrics are also a view for SQL, named ``window_metrics``.
    """
    if window_metrics is None:
        window_metrics = spark.createDataFrame([], files.WINDOW_METRICS_SCHEMA)
    register_window_metrics(window_metrics)
    return recommend.recommend(
        users,
        store.load(spark, "user_factors", files.FACTOR_SCHEMA),
        store.load(spark, "item_factors", files.FACTOR_SCHEMA),
        store.load(spark, "user_segments", files.SEGMENT_SCHEMA),
        store.load(spark, "segment_top", files.SEGMENT_TOP_SCHEMA),
        window_metrics,
        k,
    )
