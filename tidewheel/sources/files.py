"""Reading reviews, metadata and stored tables; writing tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        # Milliseconds since 1970.
        T.StructField("timestamp", T.LongType()),
    ]
)

METADATA_SCHEMA = T.StructType(
    [T.StructField("parent_asin", T.StringType()), T.StructField("title", T.StringType())]
)

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("user_idx", T.IntegerType()),
        T.StructField("item_idx", T.IntegerType()),
    ]
)

FACTOR_SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("features", T.ArrayType(T.FloatType()))]
)

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("user_idx", T.IntegerType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("segment_label", T.StringType()),
    ]
)

SEGMENT_TOP_SCHEMA = T.StructType(
    [
        T.StructField("segment", T.IntegerType()),
        T.StructField("item_idx", T.IntegerType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("n_ratings", T.LongType()),
        T.StructField("rank", T.IntegerType()),
    ]
)

WINDOW_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("interaction_count", T.LongType()),
        T.StructField("engagement_score", T.DoubleType()),
    ]
)


def read_reviews(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Review lines, one JSON object each. With a fixed schema the files are read once."""
    return spark.read.schema(REVIEW_SCHEMA).json(path)


def read_item_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Metadata lines without the malformed ones; ``record_order`` sorts as the files do."""
    corrupt = "_corrupt_record"
    schema = T.StructType([*METADATA_SCHEMA.fields, T.StructField(corrupt, T.StringType())])
    lines = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .json(path)
    )
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    # Numbered before the filter, which could otherwise run first in one plan and not in another.
    numbered = lines.select("parent_asin", "title", corrupt, place.alias("record_order"))
    return numbered.filter(F.col(corrupt).isNull()).select("parent_asin", "title", "record_order")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Written by the executors, whatever the size."""
    df.write.mode(mode).parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stored table, or an empty one of the same shape if nothing is stored there."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
