"""Passages that repeat across documents, by MinHash banding of short paragraphs.

A text is cut into paragraphs at line feeds and after words that end in a full stop, question or
exclamation mark; a longer stretch without any is cut after words that a hash picks. So the
cuts depend on the words around them only, and a passage is cut alike wherever it stands. Paragraphs
of fewer than LEAST_WORDS words are passed over. A paragraph's set are its runs of five words,
A-Z as a-z; its signature, cut into bands, makes it collide with like ones. The number of bands
is the smallest that finds pairs of the wanted similarity with probability RECALL. Paragraphs that
collide are compared by the exact Jaccard similarity of their sets, and linked at SIMILAR or more.
Components of links that occur in two documents or more are repeats.

Wherever a passage begins and ends, and whatever marks it has, it is also found by stretches: of
every REACH neighbouring runs of LEAST_WORDS words the one with the smallest hash is picked, and a
stretch goes from the first word of one picked run to the last word of the next. Stretches that are
equal word by word in two documents are repeats as well. Inside a run of 50 words that two documents
share both pick alike, and the first and the last pick are at most REACH - 1 words from its ends, so
that the stretches between cover 50 - 2 * (REACH - 1) = MOST_SHORT words or more.

Neighbouring repeats, with no more than SKIP words between, form a passage, reported if MOST_SHORT
of its words or more are in repeats; the earliest occurrence of each component stays, the others are
to be removed.

Hashes that occur once are most of all and say nothing, so only those seen twice are shuffled with
what belongs to them; filters of fixed size tell tasks which may be (``filters``).

Earlier means smaller doc_id (null first), then hash of the text, then place. Rows that agree in
doc_id and text are one document. Null or empty texts have no paragraphs. Texts of any length are cut
whole. Extra columns are not read. An empty table gives an empty one. Whole paragraphs are told
apart by 64-bit hashes, and so are runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.filters import among, bits_of
from tidewheel.llm.links import linked, shared_keys, sketch
from tidewheel.llm.shingles import STEP, Text, finished, gathered
from tidewheel.llm.sized import broadcast_if_few
from tidewheel.llm.workers import importable
from tidewheel.session import discard, written

# Parameters.
WIDTH = 5
SIMILAR = 80  # percent
RECALL = 0.99
ROWS = 2  # hashes per band
LEAST_WORDS = 8
LONG = 48  # words without a mark after which cuts by hash begin
PICK = 16  # one word in so many is cut after then
SKIP = 8
MOST_SHORT = 20
REACH = 16  # neighbouring runs of which one is picked
SKETCH = 64

BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - (SIMILAR / 100) ** ROWS))
SEEDS = finished(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
MARKS = np.zeros(256, bool)
MARKS[list(b".!?")] = True


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, STEP, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


class Paragraphs:
    """Paragraphs of several texts that have LEAST_WORDS words or more."""

    def __init__(self, texts: list[bytes | None]):
        self.text = text = Text(texts)
        n = len(text.hashes)
        feeds = np.cumsum(text.raw == 0x0A)
        last = np.zeros(n, bool)  # words that end a paragraph
        last[:-1] = feeds[text.starts[1:]] > feeds[text.ends[:-1] - 1]
        # A row of marks is ornament, and ends nothing.
        last |= MARKS[text.raw[text.ends - 1]] & ~MARKS[text.raw[text.ends - 2]]
        last[-1:] = True
        last[text.bounds[1:][np.diff(text.bounds) > 0] - 1] = True
        # Stretches that stay long are cut after the words that a hash picks.
        ends = np.flatnonzero(last)
        lengths = np.diff(ends, prepend=-1)
        long = np.repeat(lengths > LONG, lengths)
        last |= long & (text.hashes % np.uint64(PICK) == 0)
        ends = np.flatnonzero(last) + 1
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        kept = ends - starts >= LEAST_WORDS
        self.starts, self.ends = starts[kept], ends[kept]
        self.of = np.searchsorted(text.bounds, self.starts, side="right") - 1
        self.runs = text.runs(WIDTH)

    def nodes(self) -> np.ndarray:
        """A hash of the words of each paragraph."""
        return _hashed(self.text, self.starts, self.ends)

    def keys(self) -> np.ndarray:
        """Band keys: one row per paragraph."""
        lengths = self.ends - self.starts - WIDTH + 1
        if not len(lengths):
            return np.zeros((0, BANDS), np.int64)
        own = self.runs[_spread(self.starts, lengths)]
        begins = np.cumsum(lengths) - lengths
        out = np.empty((len(lengths), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(lengths), band + 1, np.uint64)
            for row in range(ROWS):
                key = key * STEP + np.minimum.reduceat(finished(own ^ SEEDS[band * ROWS + row]), begins)
            out[:, band] = finished(key)
        return out.view(np.int64)

    def sets(self) -> list[np.ndarray]:
        return [np.unique(self.runs[s : e - WIDTH + 1]) for s, e in zip(self.starts, self.ends, strict=True)]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of stretches one after another."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _hashed(text: Text, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words from each start to its end."""
    if not len(starts):
        return np.zeros(0, np.int64)
    lengths = ends - starts
    members = _spread(starts, lengths)
    place = members - np.repeat(starts, lengths)
    mixed = text.hashes[members] * _powers(int(lengths.max()))[place]
    sums = np.add.reduceat(mixed, np.cumsum(lengths) - lengths)
    return finished(sums ^ lengths.astype(np.uint64)).view(np.int64)


def stretches(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches of all texts."""
    runs = text.runs(LEAST_WORDS)
    n = max(len(runs) - REACH + 1, 0)
    least, picked = runs[:n].copy(), np.arange(n)
    for step in range(1, REACH):
        # Of equal hashes the last one, so that what lies beyond a shared run changes no pick inside.
        lower = runs[step : step + n] <= least
        picked[lower] = np.flatnonzero(lower) + step
        np.minimum(least, runs[step : step + n], out=least)
    limits = np.repeat(text.bounds[1:], np.diff(text.bounds))[:n]
    picked = np.unique(picked[np.arange(n) + REACH + LEAST_WORDS - 1 <= limits])
    of = np.searchsorted(text.bounds, picked, side="right")
    same = of[1:] == of[:-1]
    return picked[:-1][same], picked[1:][same] + LEAST_WORDS


UNITS = "doc_id long, version long, place int, start int, words int, runs int, node long, keys array<bigint>"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        ids, versions = batch.column("doc_id"), batch.column("version")
        for texts in gathered(text.as_py() for text in batch.column("text")):
            own = Paragraphs(texts)
            rows = pa.array(own.of + at)
            first = own.text.bounds[own.of]
            # The number of the paragraph within its text.
            place = np.arange(len(own.of)) - np.searchsorted(own.of, own.of)
            keys = pa.array(own.keys().reshape(-1))
            offsets = np.arange(0, len(keys) + 1, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(rows),
                    versions.take(rows),
                    pa.array(place.astype(np.int32)),
                    pa.array((own.starts - first).astype(np.int32)),
                    pa.array((own.ends - own.starts).astype(np.int32)),
                    pa.array(np.array([len(one) for one in own.sets()], np.int32)),
                    pa.array(own.nodes()),
                    pa.ListArray.from_arrays(offsets, keys),
                ],
                ["doc_id", "version", "place", "start", "words", "runs", "node", "keys"],
            )
            at += len(texts)


STRETCHES = "doc_id long, version long, start int, words int, component long"


def _stretches(bits: Broadcast | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of texts; with ``bits`` only those that may occur in several documents."""
    for batch in batches:
        at = 0
        ids, versions = batch.column("doc_id"), batch.column("version")
        for texts in gathered(text.as_py() for text in batch.column("text")):
            own = Text(texts)
            starts, ends = stretches(own)
            # Not the hash of a paragraph of the same words.
            hashes = ~_hashed(own, starts, ends)
            if bits is not None:
                may = among(bits.value, hashes)
                starts, ends, hashes = starts[may], ends[may], hashes[may]
            of = np.searchsorted(own.bounds, starts, side="right") - 1
            rows = pa.array(of + at)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(rows),
                    versions.take(rows),
                    pa.array((starts - own.bounds[of]).astype(np.int32)),
                    pa.array((ends - starts).astype(np.int32)),
                    pa.array(hashes),
                ],
                ["doc_id", "version", "start", "words", "component"],
            )
            at += len(texts)


def _several(rows: DataFrame, key: str, who: Column) -> DataFrame:
    """The keys that more than one of ``who`` has, stored."""
    ends = rows.groupBy(key).agg(F.min(who).alias("least"), F.max(who).alias("most"))
    return written(ends.filter("least <> most").select(key), "several")


def _document() -> Column:
    return F.xxhash64("doc_id", "version")


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """Stretches (doc_id, version, start, words, component) that occur in several documents.

    The first pass sends on hashes only; the second one cuts the texts again and keeps what the first
    has found.
    """
    spark = docs.sparkSession
    several = _several(docs.mapInArrow(partial(_stretches, None), STRETCHES), "component", _document())
    bits = spark.sparkContext.broadcast(bits_of(several))
    again = docs.mapInArrow(partial(_stretches, bits), STRETCHES)
    found = written(again.join(several, "component").select("doc_id", "version", "start", "words", "component"), "equal")
    discard(several)
    return found


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in gathered(text.as_py() for text in batch.column("text")):
            own = Paragraphs(texts)
            sets = own.sets()
            members = pa.array([one.view(np.int64) for one in sets], pa.list_(pa.int64()))
            sketches = pa.array([sketch(one, SKETCH) for one in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(own.nodes()), members, sketches], ["node", "members", "sketch"])


def _shared(bits: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, node and size of the band keys that several nodes may have."""
    for batch in batches:
        keys = batch.column("keys").flatten().to_numpy()
        hit = np.flatnonzero(among(bits.value, keys))
        rows = pa.array(hit // BANDS)
        sizes = batch.column("runs").cast(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), batch.column("node").take(rows), sizes.take(rows)], ["key", "node", "size"])


def _active(bits: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paragraphs whose node may have a partner or stand in several documents."""
    for batch in batches:
        own = batch.select(["doc_id", "version", "place", "start", "words", "node"])
        yield own.filter(pa.array(among(bits.value, batch.column("node").to_numpy())))


def classes(docs: DataFrame) -> DataFrame:
    """Paragraphs (doc_id, version, place, start, words, node) with their ``component``.

    ``docs`` has doc_id, version and the text as bytes. A component is named by its smallest node. All
    paragraphs are there that equal or resemble one of another document, and some that do not.
    """
    spark = docs.sparkSession
    units = written(docs.mapInArrow(_units, UNITS), "units")
    met = _several(units.select(F.explode("keys").alias("key"), "node"), "key", F.col("node"))
    bits = spark.sparkContext.broadcast(bits_of(met))
    discard(met)
    shared = shared_keys(units.mapInArrow(partial(_shared, bits), "key long, node long, size long"))
    equal = _several(units, "node", _document())
    known = spark.sparkContext.broadcast(bits_of(equal.unionByName(shared.select("node").distinct())))
    active = units.mapInArrow(partial(_active, known), "doc_id long, version long, place int, start int, words int, node long")
    units, whole = written(active, "active"), units
    discard(whole, equal)
    partners = shared.select("node").distinct()
    wanted = units.join(broadcast_if_few(partners), "node").groupBy("node").agg(
        F.min(F.struct("doc_id", "version")).alias("d")
    )
    wanted = written(wanted.select("node", "d.*"), "wanted")
    holders = wanted.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    again = docs.join(broadcast_if_few(written(holders, "holders")), same).select("text")
    cut = again.mapInArrow(_sets, "node long, members array<bigint>, sketch array<bigint>")
    sets = written(cut.join(broadcast_if_few(wanted.select("node")), "node").dropDuplicates(["node"]), "sets")

    def verify(pairs: DataFrame) -> DataFrame:
        some = broadcast_if_few(pairs)
        one = sets.join(some, F.col("node") == F.col("a")).select("a", "b", F.col("members").alias("of_a"))
        two = sets.join(some, F.col("node") == F.col("b")).select("a", "b", F.col("members").alias("of_b"))
        met = one.join(two, ["a", "b"])
        met = met.withColumn("overlap", F.size(F.array_intersect("of_a", "of_b")))
        both = F.size("of_a") + F.size("of_b") - F.col("overlap")
        return met.filter(F.col("overlap") * 100 >= both * SIMILAR).select("a", "b")

    labels = linked(shared, verify, sets.select("node", "sketch"), SIMILAR)
    discard(shared, sets, wanted)
    named = units.join(broadcast_if_few(labels), "node", "left")
    return named.withColumn("component", F.coalesce("component", "node"))


def repeated(docs: DataFrame) -> DataFrame:
    """Repeated passages of each document.

    doc_id, start_word and n_words of the passage, n_paragraphs (paragraphs and stretches) repeated
    in it, n_removed of them (all but the earliest of their component), and first_doc_id, the
    smallest id that shares one.
    """
    importable(docs.sparkSession)
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("text"))
    columns = ["doc_id", "version", "start", "words", "component"]
    paragraphs = classes(texts).select(*columns, (F.col("start") * 2).alias("place"))
    equal = repeated_stretches(texts).select(*columns, (F.col("start") * 2 + 1).alias("place"))
    units = written(paragraphs.unionByName(equal), "classes")
    doc = F.struct("doc_id", "version")
    ends = units.groupBy("component").agg(
        F.min(doc).alias("least"), F.max(doc).alias("most"), F.min(F.struct("doc_id", "version", "place")).alias("first")
    )
    several = written(ends.filter("least <> most").select("component", "first"), "repeats")
    found = units.join(broadcast_if_few(several), "component").dropDuplicates(["doc_id", "version", "place"])
    own = Window.partitionBy("doc_id", "version").orderBy("place")
    end = F.col("start") + F.col("words")
    # Where the repeats before end: they may overlap.
    found = found.withColumn("before", F.max(end).over(own.rowsBetween(Window.unboundedPreceding, -1)))
    found = found.withColumn("new", F.coalesce((F.col("start") - F.col("before") > SKIP).cast("int"), F.lit(1)))
    found = found.withColumn("passage", F.sum("new").over(own))
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("before", F.lit(0))))
    here = F.struct("doc_id", "version", "place")
    passages = found.groupBy("doc_id", "version", "passage").agg(
        F.min("start").alias("start_word"),
        (F.max(F.col("start") + F.col("words")) - F.min("start")).alias("n_words"),
        F.sum(fresh).alias("repeated"),
        F.count(F.lit(1)).alias("n_paragraphs"),
        F.count_if(F.col("first") != here).alias("n_removed"),
        F.min("first.doc_id").alias("first_doc_id"),
    )
    passages = passages.filter(F.col("repeated") >= MOST_SHORT)
    return passages.select("doc_id", "start_word", "n_words", "n_paragraphs", "n_removed", "first_doc_id")
