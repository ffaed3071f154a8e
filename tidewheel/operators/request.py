"""Lists for the few users of one request, from stored tables."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.recommend import DEFAULT_SEGMENT, OUT, _one_segment_per_user, _segment_rows, global_trending_top_k
from tidewheel.operators.summary import COLD_USER

# Parameter: more users are a table, which ``recommend`` serves.
MOST = 1_000

SCHEMA = "user_id bigint, path string, rank int, item_id bigint, score double"


def recommend_request(
    user_ids: Iterable[int],
    user_factors: DataFrame,
    item_factors: DataFrame,
    segments: DataFrame,
    segment_top: DataFrame,
    window_metrics: DataFrame,
    k: int = 5,
) -> DataFrame:
    """What ``recommend`` gives for these users, with less to wait for.

    Their ids are a filter on each table, which stored tables push down to their files, and what is
    found of them, at most ``MOST`` users and ``k`` items for each, is put together on the driver. The
    tables are asked at the same time. The item factors are read once, by all tasks; each hands on the
    best ``k`` of its rows for each user. Nothing is shuffled, stored or broadcast but the vectors asked for.
    """
    spark = user_factors.sparkSession
    ids = list(dict.fromkeys(int(user) for user in user_ids))
    if len(ids) > MOST:
        raise ValueError(f"a request is for at most {MOST} users")

    def asked(column: Column) -> Column:
        return column.cast("bigint").isin(ids)

    with ThreadPoolExecutor(4) as pool:
        vectors = pool.submit(lambda: user_factors.filter(asked(F.col("id"))).select(F.col("id").cast("bigint"), "features").collect())
        modelled = pool.submit(lambda: not user_factors.limit(1).isEmpty())
        chosen = pool.submit(lambda: _one_segment_per_user(segments.filter(asked(F.col("user_idx")))).collect())
        trending = pool.submit(lambda: global_trending_top_k(window_metrics, k).collect() if COLD_USER in ids or not modelled.result() else [])
        known = {row["id"]: row["features"] for row in reversed(vectors.result())} if ids else {}
        known.pop(COLD_USER, None)
        scored = pool.submit(lambda: _best(item_factors, known, k))
        of_segment = {row["user_id"]: (row["segment"], row["segment_label"]) for row in chosen.result()}
        wanted = sorted({DEFAULT_SEGMENT, *(number for number, _ in of_segment.values())})
        lists: dict[int, list[tuple]] = {}
        for row in _segment_rows(segment_top, k).filter(F.col("segment").isin(wanted)).collect():
            lists.setdefault(row["segment"], []).append((row["rank"], row["item_id"], row["score"]))
        newest = [(place, row["item_id"], row["score"]) for place, row in enumerate(trending.result(), 1)]
        best, has_model = scored.result(), modelled.result()

    rows = []
    for user in ids:
        number, label = of_segment.get(user, (None, None))
        if user == COLD_USER or not has_model:
            path, found = ("cold_start_global", newest) if newest else ("default_fallback", lists.get(DEFAULT_SEGMENT, []))
        elif user in known:
            path, found = f"als_segment_{label or 'Unknown'}", best.get(user, [])
        elif number is not None:
            path, found = f"segment_fallback_{number}", lists.get(number, [])
        else:
            path, found = "default_fallback", lists.get(DEFAULT_SEGMENT, [])
        rows += [(user, path, *entry) for entry in sorted(found)] or [(user, path, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).select(*OUT)


def _best(item_factors: DataFrame, users: dict[int, list[float]], k: int) -> dict[int, list[tuple]]:
    """The ranked best items of each of a few vectors."""
    if not users:
        return {}
    names, vectors = list(users), np.array(list(users.values()), np.float64)

    def top(batches):
        kept = [(np.zeros(0, np.int64), np.zeros(0))] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            items = np.array(batch.column("features").to_pylist(), np.float64)
            for at, scores in enumerate(vectors @ items.T):
                every, own = np.concatenate([kept[at][0], ids]), np.concatenate([kept[at][1], scores])
                order = np.lexsort((every, -own))[:k]
                kept[at] = every[order], own[order]
        for at, (ids, scores) in enumerate(kept):
            yield pa.RecordBatch.from_pydict(
                {"user_id": pa.array([names[at]] * len(ids), pa.int64()), "item_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())}
            )

    items = item_factors.select(F.col("id").cast("bigint").alias("id"), "features")
    found: dict[int, list[tuple]] = {}
    for row in items.mapInArrow(top, "user_id bigint, item_id bigint, score double").collect():
        found.setdefault(row["user_id"], []).append((-row["score"], row["item_id"]))
    return {
        user: [(place, item, -score) for place, (score, item) in enumerate(sorted(entries)[:k], 1)] for user, entries in found.items()
    }
