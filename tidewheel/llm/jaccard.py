"""Documents linked by the Jaccard similarity of their word n-grams, by vertical partitioning.

All n-grams have one global order: by how many documents hold them, roughly, then by hash. Cut
into fragments, the order cuts every document's set into segments. Two documents can only be
alike if the leading parts of their sets share an n-gram; those that do are possible partners.
For a pair, each fragment counts how much its two segments overlap, and the counts are summed.

How many documents hold an n-gram is counted in a table of fixed size by hash, so the order is the
same everywhere but only about right; being a total order is all that the result needs, and rare
n-grams first keeps the leading parts apart. Documents with equal sets are one node of the graph.

Words are runs of anything but space and the characters 09 to 0D, with A-Z as a-z. A document with
fewer words than an n-gram has its whole sequence as one. A document without words, or a null text,
has an empty set, is linked with nothing and is its own component. The component is named by the
smallest doc_id in it; rows with a null doc_id take part, and have a null component if no other id
is in theirs. Repeated rows get a row each. N-grams are told apart by 64 bits. Texts of any length
count whole. Extra columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.links import linked, possible, shared_keys, sketch
from tidewheel.llm.shingles import gathered
from tidewheel.llm.shingles import sets as sets_of
from tidewheel.llm.sized import broadcast_if_few
from tidewheel.llm.workers import importable
from tidewheel.session import discard, written

# Parameters.
WIDTH = 3
PERCENT = 90
TABLE_BITS = 22
SKETCH = 256
CHUNK = 1 << 16


def _count(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            for one in sets_of((text.as_py() for text in batch.column("text")), width):
                # Places of one set may meet in the table.
                np.add.at(counts, (one >> np.uint64(64 - TABLE_BITS)).astype(np.int64), 1)
        for number, chunk in enumerate(counts.reshape(-1, CHUNK)):
            if chunk.any():
                packed = pa.compress(chunk.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int32()), "counts": pa.array([packed], pa.binary())})

    return run


def _classes(table: pa.Table) -> pa.Table:
    """Powers of two up to which the places of a chunk were counted."""
    total = np.zeros(CHUNK, np.int64)
    for packed in table.column("counts"):
        total += np.frombuffer(pa.decompress(packed.as_py(), CHUNK * 8, codec="zstd", asbytes=True), np.int64)
    classes = np.ceil(np.log2(total + 1)).astype(np.uint8)
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "classes": pa.array([classes.tobytes()], pa.binary())})


def frequency_classes(docs: DataFrame, width: int) -> np.ndarray:
    """For each place of the table, the magnitude of its count: 1 << TABLE_BITS bytes."""
    parts = docs.mapInArrow(_count(width), "chunk int, counts binary")
    out = np.zeros((1 << TABLE_BITS) // CHUNK * CHUNK, np.uint8).reshape(-1, CHUNK)
    for row in parts.groupBy("chunk").applyInArrow(_classes, "chunk int, classes binary").collect():
        out[row["chunk"]] = np.frombuffer(row["classes"], np.uint8)
    return out.reshape(-1)


class Order:
    """The global order of n-grams, and its fragments."""

    def __init__(self, classes: np.ndarray):
        self.classes = classes

    def ordered(self, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A sorted set in the global order, and the fragment of each member."""
        of = self.classes[one >> np.uint64(64 - TABLE_BITS)].astype(np.uint64)
        # A fragment is the upper or lower half of a class.
        fragments = (of << np.uint64(1)) | (one >> np.uint64(63))
        places = np.argsort(fragments, kind="stable")
        return one[places], fragments[places].astype(np.int32)


def _digest(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _sets(order: Broadcast, width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Order(order.value)
        for batch in batches:
            rows = {"n": [], "node": [], "leading": []}
            for one in sets_of((text.as_py() for text in batch.column("text")), width):
                n = len(one)
                # Two sets that are alike share one of these, whichever the partner's size.
                leading = n - -(-n * percent // 100) + 1 if n else 0
                rows["n"].append(n)
                rows["node"].append(_node(_digest(one)))
                rows["leading"].append(own.ordered(one)[0][:leading].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("version"),
                    pa.array(rows["n"], pa.int64()),
                    pa.array(rows["node"], pa.int64()),
                    pa.array(rows["leading"], pa.list_(pa.int64())),
                ],
                ["doc_id", "version", *rows],
            )

    return run


def _segments(order: Broadcast, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Order(order.value)
        for batch in batches:
            wanted = iter(batch.column("node").to_pylist())
            for texts in gathered(text.as_py() for text in batch.column("text")):
                nodes, fragments, lengths, segments = [], [], [], []
                for one in sets_of(texts, width):
                    node = next(wanted)
                    if _node(_digest(one)) != node:
                        continue  # another text with the same hash
                    members, places = own.ordered(one)
                    cuts = np.flatnonzero(np.diff(places, prepend=-1))
                    nodes.append(np.full(len(cuts), node, np.int64))
                    fragments.append(places[cuts])
                    lengths.append(np.diff(cuts, append=len(members)))
                    segments.append(members.view(np.int64))
                if nodes:
                    ends = np.cumsum(np.concatenate([[0], *lengths])).astype(np.int32)
                    lists = pa.ListArray.from_arrays(ends, np.concatenate(segments))
                    rows = [pa.array(np.concatenate(nodes)), pa.array(np.concatenate(fragments)), lists]
                    yield pa.RecordBatch.from_arrays(rows, ["node", "fragment", "segment"])

    return run


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = iter(batch.column("node").to_pylist())
            for texts in gathered(text.as_py() for text in batch.column("text")):
                nodes, sizes, sketches = [], [], []
                for one in sets_of(texts, width):
                    node = next(wanted)
                    if _node(_digest(one)) == node:
                        nodes.append(node)
                        sizes.append(len(one))
                        sketches.append(sketch(one, SKETCH))
                columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "size", "sketch"])

    return run


def joined(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its doc_id, n_shingles and component_id; see the module."""
    return versions(docs, width, percent).drop("version")


def versions(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """As ``joined``, with ``version``, the hash of the row's text: rows may share a doc_id."""
    spark = docs.sparkSession
    importable(spark)
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("text"))
    order = spark.sparkContext.broadcast(frequency_classes(texts.select("text"), width))
    schema = "doc_id long, version long, n long, node long, leading array<bigint>"
    sets = written(texts.mapInArrow(_sets(order, width, percent), schema), "sets")
    # A row with an id stands for its node, as far as there is one.
    stands = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "version")).alias("row")
    nodes = sets.filter("n > 0").groupBy("node", "n").agg(stands)
    nodes = written(nodes.select("node", "n", "row.doc_id", "row.version"), "nodes")
    buckets = sets.select(F.explode("leading").alias("key"), "node", F.col("n").alias("size"))
    shared = shared_keys(buckets)
    slim = written(sets.select("doc_id", "version", "n", "node"), "slim")
    discard(sets)

    def again(some: DataFrame) -> DataFrame:
        """Texts of the documents that stand for ``some`` nodes."""
        wanted = nodes.join(broadcast_if_few(some), "node")
        wanted = written(wanted.select("node", F.col("doc_id").alias("_id"), F.col("version").alias("_version")), "wanted")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
        return texts.join(broadcast_if_few(wanted), same).select("node", "text")

    # Only documents that share a leading n-gram with another are looked at again.
    partners = written(shared.select("node").distinct(), "partners")
    sketched = again(partners).mapInArrow(_sketches(width), "node long, size long, sketch array<bigint>")
    sketches = written(sketched.dropDuplicates(["node"]), "sketches")
    sizes = nodes.select("node", "n")

    def verify(pairs: DataFrame) -> DataFrame:
        # Sketches leave little but links, and only documents of pairs left are cut into segments.
        pairs = written(possible(pairs, sketches, percent), "possible")
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        cut = again(written(ends, "ends")).mapInArrow(_segments(order, width), "node long, fragment int, segment array<bigint>")
        segments = written(cut, "segments")
        some = broadcast_if_few(pairs)
        one = segments.join(some, F.col("node") == F.col("a")).select("a", "b", "fragment", F.col("segment").alias("of_a"))
        two = segments.join(some, F.col("node") == F.col("b")).select("a", "b", "fragment", F.col("segment").alias("of_b"))
        met = one.join(two, ["a", "b", "fragment"])
        overlap = F.size(F.array_intersect("of_a", "of_b"))
        # A repeated row has its segments twice, with the same overlap.
        partial = met.groupBy("a", "b", "fragment").agg(F.max(overlap).alias("overlap"))
        total = partial.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))
        total = total.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
        total = total.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
        links = total.filter(F.expr(f"100 * overlap >= {percent} * (n_a + n_b - overlap)")).select("a", "b")
        found = written(links, "found")
        discard(segments, pairs)
        return found

    labels = linked(shared, verify, sketches, percent)
    discard(shared, sketches)
    ids = nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = ids.join(least, "component").select("node", "component_id")
    out = slim.select("doc_id", "version", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "version", "n_shingles", own.alias("component_id"))
