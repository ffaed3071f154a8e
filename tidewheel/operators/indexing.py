"""Dense integer ids, titles, and the lookups that use them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import label_column, short_title
from tidewheel.functions.scalars import SEGMENT_LABELS
from tidewheel.operators.skew import (
    heavy_by_count,
    heavy_keys,
    repeated,
    salted_join,
    salted_outer_join,
    with_position,
)
from tidewheel.session import written

# Factor models take 32-bit ids.
MAX_ID = 2**31 - 1


def fit_dense_index(df: DataFrame, column: str, out: str = "idx") -> DataFrame:
    """Table ``(column, n, out)``: ids by falling frequency from 0, equal ones by name.

    The same numbering a frequency-ordered string indexer gives, but the label list is a
    stored table and never one array on the driver.
    """
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    placed = with_position(counts, [F.col("n").desc(), F.col(column).asc()], out)
    fits = F.when(F.col(out) <= MAX_ID, F.col(out).cast("int")).otherwise(
        F.raise_error(F.lit(f"more than {MAX_ID} different values of {column}"))
    )
    return placed.select(column, "n", fits.alias(out))


def apply_dense_index(df: DataFrame, mapping: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the dense id; rows whose value was not seen in fitting are left out."""
    total = mapping.agg(F.sum("n")).first()[0] or 0
    ids = mapping.select(column, F.col("idx").alias(out))
    return salted_join(df, ids, column, heavy_by_count(mapping, column, "n", total)).select(*df.columns, out)


def item_titles(items: DataFrame, metadata: DataFrame, record_order: str | None = None) -> DataFrame:
    """One title per item, the item's own id where there is none.

    The first metadata record of an item decides, also when it has no title. ``record_order``
    names the column that tells which one is first; without it the smallest title is taken.
    """
    if record_order is None:
        title = F.min("title")
    else:
        title = F.min_by("title", record_order)
    first = metadata.groupBy("parent_asin").agg(title.alias("title"))
    named = first.select(F.col("parent_asin").alias("item_id"), F.nullif("title", F.lit("")).alias("title"))
    return (
        items.select("item_id", "item_idx")
        .distinct()
        .join(named, "item_id", "left")
        .select("item_idx", F.coalesce("title", "item_id").alias("title"))
    )


def with_titles(
    rows: DataFrame, titles: DataFrame, item: str = "item_id", heavy: DataFrame | None = None
) -> DataFrame:
    """Adds a short display title, ``Item #<id>`` where the item has none.

    One item may stand in a large part of all lists, so its rows are spread; give ``rows``
    as a stored table, or the heavy items, since otherwise they are computed again.
    """
    names = titles.select(F.col("item_idx").alias(item), short_title(F.col("title")).alias("title"))
    if heavy is None:
        heavy = heavy_keys(rows, item)
    joined = salted_join(rows, names, item, heavy, "left")
    fallback = F.concat(F.lit("Item #"), F.col(item).cast("string"))
    return joined.select(*rows.columns, F.coalesce("title", fallback).alias("title"))


def ratings_with_segment(ratings: DataFrame, segments: DataFrame) -> DataFrame:
    """Ratings of users that have a segment, with its number; give ``ratings`` as a stored table."""
    numbers = segments.select("user_idx", "segment")
    return salted_join(ratings, numbers, "user_idx", heavy_keys(ratings, "user_idx"))


def known_users(users: DataFrame, table: DataFrame, user: str = "user_id", key: str = "id") -> DataFrame:
    """The users that a factor or segment table knows."""
    return _matched(users, table, user, key, "left_semi")


def unknown_users(users: DataFrame, table: DataFrame, user: str = "user_id", key: str = "id") -> DataFrame:
    return _matched(users, table, user, key, "left_anti")


def _matched(users: DataFrame, table: DataFrame, user: str, key: str, how: str) -> DataFrame:
    """Rows that agree in everything are counted first and repeated after the join.

    So a user in many equal rows is one row of the join; if the rows differ, Spark splits the
    user by its runtime rule for skewed joins.
    """
    ids = table.select(F.col(key).alias(user)).distinct()
    counted = users.groupBy(*users.columns).agg(F.count(F.lit(1)).alias("_n"))
    found = counted.join(ids, user, how)
    return repeated(found, "_n").select(*users.columns)


def reconciled_index(old: DataFrame, counts: DataFrame, column: str, out: str = "idx") -> DataFrame:
    """The index of a new run in which every value of the old one keeps its number.

    ``old`` is ``(column, out)``, ``counts`` ``(column, n)`` of the new run. Values that are new get the
    numbers after the largest old one, by falling frequency and name; values that are gone keep theirs
    with ``n`` 0, so that no number is given twice. ``state`` is kept, new or gone.
    """
    parts = F.lit(1)
    before = old.select(column, F.col(out).alias("_old"))
    both = salted_outer_join(
        counts.filter(F.col(column).isNotNull()).select(column, "n"), before.withColumn("_known", F.lit(True)), column, parts, parts
    )
    state = F.when(F.col("_known").isNull(), "new").when(F.col("n").isNull(), "gone").otherwise("kept")
    both = written(both.withColumn("state", state).withColumn("n", F.coalesce("n", F.lit(0))), "reconciled")
    fresh = with_position(both.filter("state = 'new'").select(column, "n", "state"), [F.desc("n"), F.asc(column)], "_at")
    start = F.coalesce(before.agg(F.max("_old") + 1).scalar(), F.lit(0))
    fresh = fresh.select(column, "n", (start + F.col("_at")).cast("bigint").alias(out), "state")
    kept = both.filter("state <> 'new'").select(column, "n", F.col("_old").cast("bigint").alias(out), "state")
    return kept.unionByName(fresh)


def segment_label(df: DataFrame, labels: Mapping[int, str] = SEGMENT_LABELS) -> DataFrame:
    return df.withColumn("segment_label", label_column(F.col("segment"), labels))
