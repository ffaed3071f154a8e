"""The best items for each user by inner product of factors."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Factor values per side of a grid cell, and rows of each side scored at once in a task.
CELL_VALUES = 1 << 23
USER_TILE = 1024
ITEM_TILE = 4096


def _cell_scorer(k: int, carried: list[str], names: list[str], user_tile: int, item_tile: int):
    """The function that scores one cell of the grid.

    Items are taken by falling length. An inner product is at most the product of both
    lengths, so a user is done once that bound falls below the k-th best score; the slack
    covers rounding. Once a list is full, only the scores that reach it are sorted. The function refers to nothing of this package, so executors need not
    have it installed.
    """
    slack = 1 + 1e-9

    def best(scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's k largest scores in order, with their ids; the lower id wins a tie."""
        last = min(k, scores.shape[1])
        kth = np.partition(scores, -last, axis=1)[:, -last]
        rows, cols = np.nonzero(scores >= kth[:, None])
        order = np.lexsort((ids[rows, cols], -scores[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        chosen = np.arange(len(rows)) - np.searchsorted(rows, rows) < last
        rows, cols = rows[chosen].reshape(-1, last), cols[chosen].reshape(-1, last)
        return scores[rows, cols], ids[rows, cols]

    def merged_few(top: np.ndarray, top_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray):
        """Full lists with those scores that reach them."""
        rows, cols = np.nonzero(scores >= top[:, -1:])
        n, width = top.shape
        all_rows = np.concatenate([np.repeat(np.arange(n), width), rows])
        all_scores = np.concatenate([top.ravel(), scores[rows, cols]])
        all_ids = np.concatenate([top_ids.ravel(), ids[cols]])
        order = np.lexsort((all_ids, -all_scores, all_rows))
        all_rows = all_rows[order]
        chosen = order[np.arange(len(order)) - np.searchsorted(all_rows, all_rows) < width]
        return all_scores[chosen].reshape(n, width), all_ids[chosen].reshape(n, width)

    def score_tile(users: np.ndarray, items: np.ndarray, lengths: np.ndarray, ids: np.ndarray):
        reach = np.linalg.norm(users, axis=1) * slack
        top, top_ids = np.empty((len(users), 0)), np.empty((len(users), 0), dtype=np.int64)
        for start in range(0, len(ids), item_tile):
            if top.shape[1] < k:
                open_rows = np.arange(len(users))
            else:
                open_rows = np.nonzero(reach * lengths[start] >= top[:, -1])[0]
                if not len(open_rows):
                    break
            part = slice(start, start + item_tile)
            scores = users[open_rows] @ items[part].T
            if top.shape[1] == k:
                top[open_rows], top_ids[open_rows] = merged_few(top[open_rows], top_ids[open_rows], scores, ids[part])
            else:
                ids_here = np.broadcast_to(ids[part], scores.shape)
                if top.shape[1]:
                    scores, ids_here = np.hstack([top, scores]), np.hstack([top_ids, ids_here])
                top, top_ids = best(scores, ids_here)
        return top, top_ids

    def vectors_of(table: pa.Table) -> np.ndarray:
        lists = table.column("features").combine_chunks()
        sizes = set(pc.list_value_length(lists).to_pylist())
        if len(sizes) > 1 or None in sizes:
            raise ValueError(f"vectors of different lengths: {sizes}")
        flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
        return flat.astype(np.float64).reshape(len(lists), -1)

    def score(users, items):
        """Arrow tables in and out; pandas frames are taken as well, and give one."""
        if not isinstance(users, pa.Table):
            users, items = (pa.Table.from_pandas(side, preserve_index=False) for side in (users, items))
            return score(users, items).to_pandas()
        if not users.num_rows or not items.num_rows:
            types = {"rank": pa.int32(), "item_id": pa.int64(), "score": pa.float64()}
            of = {name: types[name] if name in types else users.schema.field(name).type for name in names}
            return pa.schema(of.items()).empty_table()
        ids = items.column("item_id").to_numpy().astype(np.int64)
        vectors = vectors_of(items)
        lengths = np.linalg.norm(vectors, axis=1)
        falling = np.argsort(-lengths)
        ids, vectors, lengths = ids[falling], vectors[falling], lengths[falling]
        user_vectors = vectors_of(users)
        users = users.select(["user_id", *carried])
        parts = []
        for start in range(0, len(user_vectors), user_tile):
            top, top_ids = score_tile(user_vectors[start : start + user_tile], vectors, lengths, ids)
            n, width = top.shape
            who = users.take(pa.array(np.repeat(np.arange(start, start + n), width)))
            ranks = np.tile(np.arange(1, width + 1, dtype=np.int32), n)
            found = {"rank": pa.array(ranks), "item_id": pa.array(top_ids.ravel()), "score": pa.array(top.ravel())}
            parts.append(pa.table([*who.columns, *found.values()], names=[*who.column_names, *found]))
        return pa.concat_tables(parts).select(names)

    return score


def top_k_by_factors(
    user_factors: DataFrame,
    item_factors: DataFrame,
    k: int = 5,
    carry: Sequence[str] = (),
    n_users: int | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """``(user_id, rank, item_id, score)`` and the ``carry`` columns of the users.

    The scores are a matrix product cut into a grid: items go into cells of bounded size by
    hash of their id, users likewise, and each pair of cells is one group, scored by numpy
    tile by tile. A group hands on only ``k`` items per user, and neither table is broadcast
    or gathered in one place. ``n_users`` may give an upper bound of the rows of
    ``user_factors`` where counting them is costly.
    """
    spark = user_factors.sparkSession
    size = item_factors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("rank")).first()
    n_items = size["n"]
    if cell_rows is None:
        cell_rows = max(1, CELL_VALUES // max(1, size["rank"] or 1))
    n_users = user_factors.count() if n_users is None else n_users
    item_cells = max(1, math.ceil(n_items / cell_rows))
    for_memory = math.ceil(n_users / cell_rows)
    for_cores = min(4 * spark.sparkContext.defaultParallelism, math.ceil(n_users / 256))
    user_cells = max(1, for_memory, math.ceil(for_cores / item_cells))

    def every(cells: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias(name)

    def one_of(cells: int, name: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int").alias(name)

    cell = ["_item_cell", "_user_cell"]
    users = user_factors.select(
        F.col("id").cast("bigint").alias("user_id"),
        "features",
        *carry,
        one_of(user_cells, "_user_cell"),
        every(item_cells, "_item_cell"),
    ).repartition(item_cells * user_cells, *cell)
    items = item_factors.select(
        F.col("id").cast("bigint").alias("item_id"),
        # A column of its own, as both tables may be the same frame.
        F.col("features").alias("features"),
        one_of(item_cells, "_item_cell"),
        every(user_cells, "_user_cell"),
    ).repartition(item_cells * user_cells, *cell)

    out = T.StructType(
        [T.StructField("user_id", T.LongType())]
        + [user_factors.schema[c] for c in carry]
        + [
            T.StructField("rank", T.IntegerType()),
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    score = _cell_scorer(k, list(carry), out.names, USER_TILE, ITEM_TILE)
    best = users.groupBy(*cell).cogroup(items.groupBy(*cell)).applyInArrow(score, out)
    if item_cells == 1:
        return best
    order = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(*out.names)
    )


def top_k_by_model(model: ALSModel, users: DataFrame, k: int = 5) -> DataFrame:
    """The same list from a fitted model, for the ``users`` with a ``user_idx`` that it knows."""
    asking = users.select(F.col("user_idx").alias("id")).distinct()
    factors = model.userFactors.join(asking, "id", "left_semi")
    return top_k_by_factors(factors, model.itemFactors, k)
