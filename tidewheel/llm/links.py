"""Components of documents that are linked when they are alike, from buckets of possible partners."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.sized import broadcast_if_few
from tidewheel.session import discard, written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of ``edges`` (a, b).

    Large and small stars by turns: each node hands its larger, then its smaller neighbours to the
    smallest one it knows, until the edges are stars. Every round is an aggregate and a join, and
    is stored, so nothing is gathered in one place.
    """
    now = written(_downward(edges), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("small").alias("big"), F.col("big").alias("small")))
        least = both.groupBy("big").agg(F.least("big", F.min("small")).alias("least"))
        larger = both.select(F.col("big").alias("at"), F.col("small").alias("other")).filter("other > at")
        large = larger.join(least.withColumnRenamed("big", "at"), "at").select(
            F.col("other").alias("big"), F.col("least").alias("small")
        )
        large = large.filter("big <> small").distinct()
        smallest = large.groupBy("big").agg(F.min("small").alias("least"))
        hung = large.join(smallest, "big").filter("small <> least").select(
            F.col("small").alias("big"), F.col("least").alias("small")
        )
        turned = hung.unionByName(smallest.withColumnRenamed("least", "small")).distinct()
        older, now = now, written(_gathered(turned, mark[0]), "edges")
        discard(older)
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("small").alias("node")).distinct()
    stars = now.select(F.col("big").alias("node"), F.col("small").alias("component"))
    out = written(_gathered(stars.unionByName(roots.withColumn("component", F.col("node"))), 2 * mark[0]), "components")
    discard(now)
    return out


#: Rows of two numbers that a task writes, so that small tables have few files.
ROWS_PER_FILE = 250_000


def _gathered(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))


def _downward(edges: DataFrame) -> DataFrame:
    pair = edges.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"))
    return pair.filter("big <> small").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and one row whatever their number."""
    mixed = F.xxhash64("big", "small").cast("decimal(20)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed), F.sum(F.col("small").cast("decimal(20)"))).first())


def shared_keys(buckets: DataFrame) -> DataFrame:
    """Rows of ``buckets`` (key, node, size) whose key several nodes have, with ``weight``, stored."""
    ends = buckets.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    several = written(ends.filter("least <> most").select("key"), "keys")
    shared = written(buckets.join(broadcast_if_few(several), "key").distinct(), "buckets")
    discard(several)
    # A node is as central as its buckets are large: an original shares more of them than its edited
    # copies, which have n-grams of their own.
    sizes = written(shared.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "sizes")
    central = shared.join(broadcast_if_few(sizes), "key").groupBy("node").agg(F.sum("members").alias("weight"))
    central = written(central, "central")
    weighed = written(shared.join(broadcast_if_few(central), "node"), "weighed")
    discard(shared, sizes, central)
    return weighed


def linked(
    shared: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    sketches: DataFrame,
    percent: int,
) -> DataFrame:
    """Components of all nodes that share a bucket and that ``verify`` links.

    ``shared`` comes from ``shared_keys`` and is read often;
    ``verify`` takes pairs (a, b) and returns those that are links, which need a Jaccard similarity
    of ``percent``; ``sketches`` has the ``sketch`` of each node.

    A group of k nodes that share buckets has k * k pairs, but most links say nothing new. So each
    bucket first compares its members with one of them, the most central, and components are formed.
    Then all pairs of a bucket whose ends lie in different components are compared, in blocks where
    the bucket is large. So every pair has been compared or is connected already: the components
    are those of all links.
    """
    spark = shared.sparkSession

    def may(a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    rank = F.struct((-F.col("weight")).alias("first"), "node", "size")
    leaders = shared.groupBy("key").agg(F.min(rank).alias("leader"))
    found = shared.join(leaders, "key").filter("node <> leader.node").filter(may(F.col("size"), F.col("leader.size")))
    none = spark.createDataFrame([], "a long, b long")
    edges, labels = _grown(none, found.select(F.col("leader.node").alias("x"), F.col("node").alias("y")), verify)

    known = shared.join(broadcast_if_few(labels), "node", "left")
    known = known.select("key", "node", "size", F.coalesce("component", "node").alias("component"))
    labelled = written(known, "labelled")
    ends = labelled.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("members")
    )
    now = written(labelled.join(ends.filter("least <> most").select("key", "members"), "key"), "open")
    discard(labelled, labels)
    few = now.filter(F.col("members") <= FEW_MEMBERS)
    other = few.select("key", F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("component").alias("apart"))
    across = few.join(other, "key").filter("component < apart").filter(may(F.col("size"), F.col("other_size")))
    pairs = across.select(F.col("node").alias("x"), F.col("other").alias("y"))
    many = now.filter(F.col("members") > FEW_MEMBERS)
    edges, labels = _grown(edges, pairs.unionByName(_across(many, sketches, percent)), verify)
    discard(now, edges)
    return labels


#: Members of a bucket up to which its pairs are rows of a join: no more than half as many per member.
FEW_MEMBERS = 16
#: Members of a larger bucket that a task compares with as many others.
BLOCK = 1_024


def sketch(one: np.ndarray, places: int) -> np.ndarray:
    """How many of a set's hashes fall to each place, four 16-bit counts in a number.

    The counts of two sets bound their overlap: it is at most the sum of the smaller ones. A
    count that would not fit is set to the largest.
    """
    counts = np.bincount((one & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.minimum(counts, 0xFFFF).astype("<u2").view(np.int64)


def _most(counts: np.ndarray, others: np.ndarray, size: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """The largest overlap that sketches allow, row by row."""
    smaller = np.minimum(size, other_size)
    most = np.minimum(np.minimum(counts, others).sum(axis=-1), smaller)
    # A full count says nothing.
    return np.where((counts == 0xFFFF).any(axis=-1) | (others == 0xFFFF).any(axis=-1), smaller, most)


def _counts(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(rows, -1).view("<u2").astype(np.int32)


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link; ``sketches`` has node, size and sketch."""

    def of(name: str) -> DataFrame:
        renamed = [F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}")]
        return sketches.select(*renamed).join(broadcast_if_few(pairs), name)

    both = of("a").join(of("b"), ["a", "b"])

    def compare(batches):
        for batch in batches:
            n = batch.num_rows
            sizes = [batch.column(name).to_numpy() for name in ("size_a", "size_b")]
            most = _most(*(_counts(batch.column(name), n) for name in ("sketch_a", "sketch_b")), *sizes)
            kept = pa.array(100 * most >= percent * (sizes[0] + sizes[1] - most))
            yield batch.select(["a", "b"]).filter(kept)

    return both.mapInArrow(compare, "a long, b long")


def _across(many: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of larger buckets that lie in different components and may be links.

    The members of a bucket are dealt to blocks, and each pair of blocks is compared in one task
    by sketches; only pairs whose sketches allow a link come out.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = many.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "size", "component"
    )
    dealt = dealt.join(sketches.select("node", "sketch"), "node")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        own = table.column("own").to_numpy()
        node, size, component = (table.column(name).to_numpy() for name in ("node", "size", "component"))
        counts = _counts(table.column("sketch"), len(node))
        first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = []
        for x in first:
            ys = second[(component[second] != component[x]) & ((node[second] > node[x]) if i == j else True)]
            smaller, larger = np.minimum(size[ys], size[x]), np.maximum(size[ys], size[x])
            ys = ys[smaller * 100 >= larger * percent]
            most = _most(counts[ys], counts[x], size[ys], size[x])
            ys = ys[100 * most >= percent * (size[ys] + size[x] - most)]
            found.append(np.stack([np.full(len(ys), node[x]), node[ys]]))
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"x": pa.array(pairs[0], pa.int64()), "y": pa.array(pairs[1], pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "x long, y long")


def _grown(edges: DataFrame, found: DataFrame, verify) -> tuple[DataFrame, DataFrame]:
    """Edges and their components after the pairs that were found have been compared."""
    pairs = written(found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
    grown = written(edges.unionByName(verify(pairs)), "links")
    again = components(grown)
    discard(pairs, edges)
    return grown, again
