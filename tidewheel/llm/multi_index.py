"""Nearest vectors by multi-index hashing of learned binary codes.

A rotation is learned on a bounded sample (principal axes, then turns that bring the axes close to
signs); a vector's code has one bit per axis. The code is split into substrings and each row is
indexed under each of them. By the pigeonhole principle two codes within a Hamming radius differ
in some substring by no more than the radius over the number of substrings, so that a query probes
every near value of every substring and finds every code within the radius. What it finds is
ranked by Euclidean distance of the vectors themselves, in double precision.

The radius is learned too: on the sample it holds the share RECALL of the true nearest neighbours.
A query that finds fewer rows than asked for is run again with the full radius, which is exact.

Index rows are dealt to blocks of bounded size by substring, leading bits of its value, and a hash;
queries go to the blocks that they probe, in parts of bounded size, and get the best of each block.
Equal vectors are one row of the index with their smallest ids, so a vector that a third of all
rows have is looked at once; equal queries are run once as well.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a
null vec_id or with another dimension than most rows. Ties go to the smaller vec_id; rows that
repeat a vec_id with the same vector count once. Extra columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.workers import importable
from tidewheel.session import written

# Parameters.
BITS = 64
SUBSTRINGS = 4
WIDTH = BITS // SUBSTRINGS
LEADING = 4  # leading bits of a substring that deal rows to cells
SAMPLE = 8_000  # vectors that the rotation and the radius are learned on
PROBES = 200  # of them, those whose neighbours are looked at for the radius
TURNS = 30
RECALL = 0.97
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 4_096
TOGETHER = 64  # queries compared with a block at a time


class Coder:
    """The learned rotation."""

    def __init__(self, sample: np.ndarray):
        self.mean = sample.mean(axis=0)
        spread = sample - self.mean
        axes = np.linalg.eigh(spread.T @ spread)[1][:, ::-1][:, :BITS]
        # Fewer axes than bits: the turns spread them over all bits.
        projected = np.zeros((len(sample), BITS))
        projected[:, : axes.shape[1]] = (sample - self.mean) @ axes
        turn = np.linalg.qr(np.random.default_rng(0).normal(size=(BITS, BITS)))[0]
        for _ in range(TURNS):
            left, _, right = np.linalg.svd(np.where(projected @ turn >= 0, 1.0, -1.0).T @ projected)
            turn = right.T @ left.T
        self.rotation = axes @ turn[: axes.shape[1]]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.mean) @ self.rotation >= 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def distances(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(others - one).sum(axis=1))


def learned_radius(coder: Coder, sample: np.ndarray, k: int) -> int:
    """The radius that holds RECALL of the k nearest neighbours within the sample."""
    codes = coder.codes(sample)
    near = []
    for n in range(min(PROBES, len(sample))):
        away = distances(sample[n], sample)
        away[n] = np.inf
        nearest = np.argsort(away, kind="stable")[: min(k, len(sample) - 1)]
        near.append(np.bitwise_count(codes[nearest] ^ codes[n]))
    found = np.concatenate(near) if near else np.zeros(0)
    return int(np.quantile(found, RECALL, method="higher")) if len(found) else BITS


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy().astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _coded(coder: Coder):
    def run(batches):
        for batch in batches:
            codes = coder.codes(_matrix(batch.column("vector"))).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes)], [*batch.schema.names, "code"])

    return run


def _substring(codes: np.ndarray, which: int) -> np.ndarray:
    return (codes >> np.uint64(which * WIDTH)) & np.uint64((1 << WIDTH) - 1)


def _search(radius: int, k: int):
    """Best rows of one block for each query that came to it."""
    near = radius // SUBSTRINGS

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query": [], "vec_id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            which = rows.column("which")[0].as_py()
            codes = rows.column("code").to_numpy().view(np.uint64)
            # The index of this block: each value of the substring and the rows that have it.
            values, of = np.unique(_substring(codes, which), return_inverse=True)
            vectors, ids = _matrix(rows.column("vector")), rows.column("ids").to_pylist()
            asked = queries.column("code").to_numpy().view(np.uint64)
            wanted, names = _matrix(queries.column("vector")), queries.column("query").to_pylist()
            for start in range(0, len(asked), TOGETHER):
                some = asked[start : start + TOGETHER, None]
                probed = np.bitwise_count(_substring(some, which) ^ values[None]) <= near
                inside = probed[:, of] & (np.bitwise_count(some ^ codes[None]) <= radius)
                for earlier in range(which):
                    # Found under an earlier substring already.
                    before = np.bitwise_count(_substring(some, earlier) ^ _substring(codes, earlier)[None])
                    inside &= before > near
                for n in range(len(some)):
                    found = np.flatnonzero(inside[n])
                    if not len(found):
                        continue
                    away = distances(wanted[start + n], vectors[found])
                    best = np.flatnonzero(away <= np.partition(away, min(k, len(away)) - 1)[min(k, len(away)) - 1])
                    pairs = sorted((away[b], i) for b in best for i in ids[found[b]])[:k]
                    out["query"] += [names[start + n]] * len(pairs)
                    out["vec_id"] += [i for _, i in pairs]
                    out["score"] += [float(a) for a, _ in pairs]
        types = {"query": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({name: pa.array(out[name], types[name]) for name in out})

    return run


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vector (as doubles) of the rows that take part."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    counts = rows.groupBy(F.size("vector").alias("size")).count()
    usual = counts.orderBy(F.desc("count"), "size").select("size").limit(1)
    return rows.filter(F.size("vector") == usual.scalar())


def _best(rows: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy("score", "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _run(index: DataFrame, queries: DataFrame, radius: int, k: int) -> DataFrame:
    """The k best rows that each query finds within the radius: query, vec_id, score."""
    near = radius // SUBSTRINGS

    def cell(which: Column) -> Column:
        # The leading bits of the substring.
        shift = which * WIDTH + (WIDTH - LEADING)
        return F.call_function("shiftrightunsigned", "code", shift.cast("int")).bitwiseAND(F.lit((1 << LEADING) - 1))

    each = F.explode(F.sequence(F.lit(0), F.lit(SUBSTRINGS - 1)))
    rows = index.withColumn("which", each)
    rows = rows.withColumn("cell", F.col("which") * (1 << LEADING) + cell(F.col("which")))
    sizes = {row["cell"]: row["count"] for row in rows.groupBy("cell").count().collect()}  # SUBSTRINGS << LEADING rows
    parts = [max(1, -(-sizes.get(n, 0) // BLOCK_ROWS)) for n in range(SUBSTRINGS << LEADING)]
    query_parts = max(1, -(-queries.count() // BLOCK_QUERIES))
    part_of = F.array(*(F.lit(n) for n in parts))
    part = F.pmod(F.xxhash64("class", "which"), part_of[F.col("cell")])
    rows = rows.withColumn("part", part).withColumn("query_part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))

    asked = queries.withColumn("which", each)
    asked = asked.withColumn("lead", cell(F.col("which")))
    asked = asked.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit((1 << LEADING) - 1))))
    asked = asked.filter(F.bit_count(F.col("lead").bitwiseXOR(F.col("other").cast("long"))) <= near)
    asked = asked.withColumn("cell", F.col("which") * (1 << LEADING) + F.col("other"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), part_of[F.col("cell")] - 1)))
    asked = asked.withColumn("query_part", F.pmod(F.xxhash64("query"), F.lit(query_parts)).cast("int"))

    keys = ["cell", "part", "query_part"]
    rows = rows.select(*(F.col(key).cast("long").alias(f"r_{key}") for key in keys), "which", "code", "vector", "ids")
    asked = asked.select(*(F.col(key).cast("long").alias(f"q_{key}") for key in keys), "query", "code", "vector")
    met = rows.groupBy(*(f"r_{key}" for key in keys)).cogroup(asked.groupBy(*(f"q_{key}" for key in keys)))
    found = met.applyInArrow(_search(radius, k), "query long, vec_id long, score double")
    return _best(found, "query", k).drop("rank")


def nearest(
    vectors: DataFrame, asked: Callable[[Column], Column], k: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows of every row whose id ``asked`` picks."""
    spark = vectors.sparkSession
    importable(spark)
    rows = written(usable(vectors, vec_id, vector), "vectors")
    # One more than asked for, as a row is no neighbour of its own.
    first = Window.partitionBy("vector").orderBy("vec_id")
    some = rows.distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    classes = some.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = written(classes.withColumn("class", F.col("ids")[0]), "classes")
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector").collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    learned = np.array([row["vector"] for row in sample], dtype=np.float64)
    coder = Coder(learned)
    radius = learned_radius(coder, learned, k)
    index = classes.mapInArrow(_coded(coder), "vector array<double>, ids array<bigint>, class long, code long")
    index = written(index, "index")
    members = written(rows.filter(asked(F.col("vec_id"))).distinct(), "members")
    queries = members.groupBy("vector").agg(F.min("vec_id").alias("query"))
    queries = queries.mapInArrow(_coded(coder), "vector array<double>, query long, code long")
    queries = written(queries, "queries")

    found = written(_run(index, queries, radius, k + 1), "found")
    enough = min(k + 1, rows.select("vec_id").distinct().count())
    full = found.groupBy("query").count().filter(F.col("count") >= enough).select("query")
    short = written(queries.join(full, "query", "left_anti"), "short")
    if not short.isEmpty():
        wider = written(_run(index, short.select("vector", "query", "code"), BITS, k + 1), "wider")
        found = found.join(short.select("query"), "query", "left_anti").unionByName(wider)
    # Each row with the query's vector gets the list, without itself.
    named = members.join(queries.select("vector", "query"), "vector").select(F.col("vec_id").alias("query_id"), "query")
    each = named.join(found, "query").filter("vec_id <> query_id")
    return _best(each, "query_id", k).select("query_id", "rank", "vec_id", "score")
