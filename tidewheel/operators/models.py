"""Factor training, model choice and user segments, on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dot_product, features_to_vector, label_column
from tidewheel.functions.scalars import SEGMENT_LABELS
from tidewheel.operators.indexing import ratings_with_segment
from tidewheel.operators.skew import heavy_keys, salted_join
from tidewheel.session import checkpoint_root

# Iterations up to which the factor model keeps its lineage: each adds two shuffles to it.
LINEAGE = 20

# Seed, number of segments, error above which models are tuned, and the grid.
SEED = 42
SEGMENTS = 5
RMSE_GATE = 1.5
FOLDS = 3
GRID_RANKS = (10, 20, 50)
GRID_REGULARIZATION = (0.01, 0.1, 0.5)
GRID_ITERATIONS = (10, 20)


@dataclass(frozen=True)
class AlsParams:
    """Settings of the factor model; the defaults are fixed values."""

    rank: int = 10
    iterations: int = 10
    regularization: float = 0.1
    nonnegative: bool = True
    seed: int = SEED
    # Blocks of users and of items. The model depends on them, so the cluster has no say in it.
    blocks: int = 10


def full_grid() -> list[AlsParams]:
    choices = product(GRID_RANKS, GRID_REGULARIZATION, GRID_ITERATIONS)
    return [AlsParams(rank=r, regularization=g, iterations=i) for r, g, i in choices]


def als_estimator(spark: SparkSession, params: AlsParams = AlsParams()) -> ALS:
    if spark.sparkContext.getCheckpointDir() is None:
        # Long iterations cut their lineage there.
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return ALS(
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="rating",
        coldStartStrategy="drop",
        nonnegative=params.nonnegative,
        rank=params.rank,
        maxIter=params.iterations,
        regParam=params.regularization,
        numUserBlocks=params.blocks,
        numItemBlocks=params.blocks,
        seed=params.seed,
        # A cut at an interval begins with the first iteration, which it computes three times.
        checkpointInterval=-1 if params.iterations <= LINEAGE else 10,
    )


def fit_als(train: DataFrame, params: AlsParams = AlsParams()) -> ALSModel:
    ratings = train.select("user_idx", "item_idx", "rating")
    return als_estimator(train.sparkSession, params).fit(ratings)


def predict(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Adds a prediction to pairs whose user and item both have factors; drops the others.

    Give ``pairs`` as a stored table, since it is read five times.
    """
    users = user_factors.select(F.col("id").alias("user_idx"), F.col("features").alias("_user"))
    items = item_factors.select(F.col("id").alias("item_idx"), F.col("features").alias("_item"))
    with_user = salted_join(pairs, users, "user_idx", heavy_keys(pairs, "user_idx"))
    both = salted_join(with_user, items, "item_idx", heavy_keys(pairs, "item_idx"))
    return both.select(*pairs.columns, dot_product(F.col("_user"), F.col("_item")).alias("prediction"))


def rmse_column(label: str = "rating", prediction: str = "prediction") -> Column:
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    return F.sqrt(F.avg(error * error))


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: the number of predictions and their root mean square error."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n"), rmse_column(label, prediction).alias("rmse")
    )


def model_rmse(model: ALSModel, test: DataFrame) -> float:
    predictions = predict(test, model.userFactors, model.itemFactors)
    return predictions.agg(rmse_column().alias("rmse")).first()["rmse"]


@dataclass(frozen=True)
class Tuned:
    model: ALSModel
    rmse: float
    tuned: bool


def tune_als_if_needed(
    train: DataFrame,
    test: DataFrame,
    threshold: float = RMSE_GATE,
    grid: Sequence[AlsParams] | None = None,
    folds: int = FOLDS,
    params: AlsParams = AlsParams(),
    parallelism: int = 2,
) -> Tuned:
    """Fits once; only if the error on ``test`` is above the gate, picks from ``grid`` by folds."""
    model = fit_als(train, params)
    error = model_rmse(model, test)
    if error is None:
        raise ValueError("no row of the test part has a user and an item that the model knows")
    if error <= threshold:
        return Tuned(model, error, False)
    als = als_estimator(train.sparkSession, params)
    maps = [
        {
            als.rank: p.rank,
            als.regParam: p.regularization,
            als.maxIter: p.iterations,
            als.nonnegative: p.nonnegative,
            als.seed: p.seed,
            als.numUserBlocks: p.blocks,
            als.numItemBlocks: p.blocks,
        }
        for p in (full_grid() if grid is None else grid)
    ]
    # Folds by hash of the pair: the same on every retry.
    fold = F.pmod(F.xxhash64(F.lit(params.seed), "user_idx", "item_idx"), F.lit(folds)).cast("int")
    search = CrossValidator(
        estimator=als,
        estimatorParamMaps=maps,
        evaluator=RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction"),
        numFolds=folds,
        foldCol="fold",
        seed=params.seed,
        parallelism=parallelism,
    )
    best = search.fit(train.select("user_idx", "item_idx", "rating", fold.alias("fold"))).bestModel
    return Tuned(best, model_rmse(best, test), True)


def export_factors(model: ALSModel, folder: str) -> dict[str, str]:
    """Writes both factor tables from the executors; returns their paths."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in ("user_factors", "item_factors")}
    model.userFactors.write.mode("overwrite").parquet(paths["user_factors"])
    model.itemFactors.write.mode("overwrite").parquet(paths["item_factors"])
    return paths


def training_summary(model: ALSModel, error: float) -> DataFrame:
    items = model.itemFactors.agg(F.count(F.lit(1))).scalar()
    return model.userFactors.agg(F.count(F.lit(1)).alias("user_factors")).select(
        F.lit(error).cast("double").alias("rmse"),
        F.lit(model.rank).alias("rank"),
        "user_factors",
        items.alias("item_factors"),
    )


def fit_segments(user_factors: DataFrame, k: int = SEGMENTS, seed: int = SEED) -> KMeansModel:
    kmeans = KMeans(k=k, seed=seed, featuresCol="features_vec", predictionCol="segment")
    return kmeans.fit(features_to_vector(user_factors))


def assign_segments(
    model: KMeansModel, user_factors: DataFrame, labels: Mapping[int, str] = SEGMENT_LABELS
) -> DataFrame:
    return model.transform(features_to_vector(user_factors)).select(
        F.col("id").alias("user_idx"), "segment", label_column(F.col("segment"), labels).alias("segment_label")
    )


def segment_by_history(ratings: DataFrame, segments: DataFrame) -> DataFrame:
    """A segment for users that have none: the one whose users rated the same items most.

    Every item a user touched gives each segment as many votes as it has ratings of that
    item; the lowest segment number wins a tie.
    """
    votes_per_item = (
        ratings_with_segment(ratings, segments)
        .groupBy("item_idx", "segment")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    without = salted_join(
        ratings.select("user_idx", "item_idx"),
        segments.select("user_idx"),
        "user_idx",
        heavy_keys(ratings, "user_idx"),
        "left_anti",
    )
    votes = (
        salted_join(without, votes_per_item, "item_idx", heavy_keys(ratings, "item_idx"))
        .groupBy("user_idx", "segment")
        .agg(F.sum("n").alias("votes"))
    )
    winner = F.max_by("segment", F.struct(F.col("votes"), -F.col("segment")))
    return votes.groupBy("user_idx").agg(winner.alias("segment"), F.max("votes").alias("votes"))
