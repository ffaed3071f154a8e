"""From raw reviews to one valid rating per user and item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a rating, and the lowest and highest rating kept.
KEYS = ["user_id", "item_id"]
RATING_COLUMNS = ["user_id", "item_id", "rating", "timestamp"]
LOWEST, HIGHEST = 1.0, 5.0


def project_ratings(raw: DataFrame) -> DataFrame:
    return raw.select(
        "user_id",
        F.col("parent_asin").alias("item_id"),
        F.col("rating").try_cast("float").alias("rating"),
        "timestamp",
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(subset=RATING_COLUMNS)


def valid_ratings(df: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    return df.filter(F.col("rating").between(lowest, highest))


def latest_per_pair(
    df: DataFrame, keys: Sequence[str] = tuple(KEYS), order: Sequence[str] = ("timestamp", "rating")
) -> DataFrame:
    """The newest row of each key; the other columns settle ties in turn.

    An aggregate rather than a ranking window: each task sends on one row per key, however
    many copies of the key it read. A whole number and a rating, as in reviews, are made one number,
    which a hash aggregate keeps in place, so that nothing is sorted; ratings that differ by less than
    a billionth are one there. Other columns are compared as a struct, for which Spark sorts.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    kinds = [df.schema[c].dataType for c in order]
    if not rest and len(order) == 2 and isinstance(kinds[0], T.IntegralType) and isinstance(kinds[1], T.FractionalType):
        return _latest_rating(df, keys, *order)
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in df.columns]
    )


def _latest_rating(df: DataFrame, keys: Sequence[str], time: str, rating: str) -> DataFrame:
    # Seven digits before the point and nine after, below the 19 of the time; a null comes first, NaN last.
    most = F.lit(10**7 - 1).cast("double")
    inside = F.greatest(-most + 1, F.least(most - 1, F.col(rating).cast("double")))
    near = F.when(F.col(rating).isNull(), -most).when(F.isnan(rating), most).otherwise(inside)
    units = F.round((near + most) * 1e9).cast("decimal(17,0)")
    place = F.coalesce(F.col(time), F.lit(-(2**63))).cast("decimal(20,0)") * F.lit(10**17).cast("decimal(18,0)") + units
    newest = [F.max_by(name, "_place").alias(name) for name in (time, rating)]
    return df.withColumn("_place", place).groupBy(*keys).agg(*newest).select(*df.columns)


def clean_ratings(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(project_ratings)
        .transform(drop_incomplete)
        .transform(valid_ratings)
        .transform(latest_per_pair)
    )


def cleaning_report(raw: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    """Rows read, dropped by each rule, and kept, from a single pass."""
    complete = F.lit(True)
    for name in RATING_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    valid = complete & F.col("rating").between(lowest, highest)
    counts = raw.transform(project_ratings).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(complete).alias("complete"),
        F.count_if(valid).alias("valid"),
        F.count_distinct(F.when(valid, F.struct(*KEYS))).alias("rows_out"),
    )
    return counts.select(
        "rows_in",
        (F.col("rows_in") - F.col("complete")).alias("dropped_null"),
        (F.col("complete") - F.col("valid")).alias("dropped_range"),
        (F.col("valid") - F.col("rows_out")).alias("dropped_duplicate"),
        "rows_out",
    )


def _share(seed: int, keys: Sequence[str]) -> Column:
    """A number in 0..1 that depends on nothing but the seed and the row's keys.

    The first 52 bits of an md5, which other engines have too.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(key).cast("string") for key in keys)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42, keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """Keeps each key with the given chance.

    Drawn by hash, so the sample is the same for every file layout and on every retry.
    """
    return df.filter(_share(seed, keys) < fraction)


def train_test_split(
    df: DataFrame, train_fraction: float = 0.8, seed: int = 42, keys: Sequence[str] = tuple(KEYS)
) -> tuple[DataFrame, DataFrame]:
    """Two parts that share no key and together hold every row."""
    # A seed of its own: drawing both from one hash would put all of a sample on one side.
    in_train = _share(seed + 1_000_003, keys) < train_fraction
    return df.filter(in_train), df.filter(~in_train)
