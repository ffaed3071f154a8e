"""Toxicity scores from an online logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, pairs of neighbours and pairs with one word between, with A-Z as
a-z, hashed to 2 ** 20 buckets; a bucket counts once however often the text has it. The weights are
learned by FTRL-proximal: per coordinate a sum of adjusted gradients and one of their squares, the
second setting the rate; a coordinate whose first sum stays within the L1 bound has weight 0. So
only some hundreds of weights are left, which are broadcast, and every whole text is scored by them.

The learner is fitted on a bounded sample: at most ``LABELLED`` labelled ids, those with the
smallest hash, each with one text. One task reads their features in an order by hash, ``ROUNDS``
times, and holds nothing but the two sums and one batch. Toxic rows count ``WEIGHT`` times.

A label counts if it is 0 or 1 and has a doc_id; an id with both is toxic. Of several rows with a
labelled doc_id the smallest text is learned. Null texts count as empty ones and are scored by the
bias alone. Rows with the same text have the same score, whatever their other columns. Labels
without a document, and extra columns, do nothing. Without any label to learn from, every score is
0. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.hashes import even_hash
from tidewheel.llm.shingles import STEP, Text, finished, gathered
from tidewheel.llm.workers import importable
from tidewheel.operators.skew import with_position
from tidewheel.session import discard, written

# Parameters: buckets, sample and rounds; rate, its damping and the L1 bound; weight of toxic rows.
BITS = 20
LABELLED = 10_000
ROUNDS = 5
RATE, DAMPING, L1 = 3.0, 1.0, 6.0
WEIGHT = 2.0
# Sums beyond it are as good as certain.
CERTAIN = 35.0


def buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, as numbers of texts and, sorted in each, buckets."""
    text = Text(texts)
    words, of = text.hashes, np.repeat(np.arange(len(texts)), np.diff(text.bounds))
    apart = finished((words[:-2] * STEP + words[2:]) * STEP + STEP)
    hashes = np.concatenate([words, text.runs(2)[of[:-1] == of[1:]], apart[of[:-2] == of[2:]]])
    owners = np.concatenate([of, of[:-1][of[:-1] == of[1:]], of[:-2][of[:-2] == of[2:]]])
    both = np.unique(owners << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return both >> BITS, both & ((1 << BITS) - 1)


def _features(batches):
    for batch in batches:
        rows = [batch.column(name).to_pylist() for name in ("doc_id", "toxic")]
        done = 0
        for texts in gathered(text.as_py() for text in batch.column("text")):
            of, found = buckets(texts)
            ends = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))
            own = [pa.array(values[done : done + len(texts)], kind) for values, kind in zip(rows, (pa.int64(), pa.int32()), strict=True)]
            done += len(texts)
            yield pa.RecordBatch.from_arrays([*own, lists], ["doc_id", "toxic", "features"])


class Learner:
    """The two sums per coordinate; the last coordinate is the bias, which has no L1 bound."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        bound = np.full(len(z), L1)
        bound[-1] = 0.0
        return -np.sign(z) * np.maximum(np.abs(z) - bound, 0.0) * RATE / (DAMPING + np.sqrt(self.n[at]))

    def learn(self, features: np.ndarray, toxic: int) -> None:
        at = np.append(features, 1 << BITS)
        w = self.weights(at)
        error = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -CERTAIN, CERTAIN))) - toxic
        gradient = error * (WEIGHT if toxic else 1.0)
        n = self.n[at]
        slower = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / RATE
        self.z[at] += gradient - slower * w
        self.n[at] = n + gradient * gradient


def _learn(batches):
    learner, seen = Learner(), False
    for batch in batches:
        lists = batch.column("features")
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        for row, toxic in enumerate(batch.column("toxic").to_pylist()):
            learner.learn(values[ends[row] : ends[row + 1]], toxic)
            seen = True
    if seen:
        weights = learner.weights(slice(None))
        kept = np.flatnonzero(weights)
        kept = np.union1d(kept, [1 << BITS])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(kept, pa.int32()), "weight": pa.array(weights[kept])})


def chosen(labels: DataFrame, learned: Column, most: int = LABELLED) -> DataFrame:
    """doc_id and toxic of the labelled ids to learn from; ``learned`` tells which ids may be."""
    told = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(learned)
    told = told.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    placed = with_position(told, [even_hash(F.lit("toxic"), F.col("doc_id")), F.col("doc_id")], "_at")
    return placed.filter(F.col("_at") < most).drop("_at")


def fitted(docs: DataFrame, labels: DataFrame, learned: Column, most: int = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of the model, the bias last; at most 12 bytes for each bucket there is."""
    importable(docs.sparkSession)
    # At most ``most`` rows of two numbers.
    some = docs.select("doc_id", "text").join(F.broadcast(chosen(labels, learned, most)), "doc_id")
    one = some.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(F.coalesce("text", F.lit(""))).cast("binary").alias("text"))
    rows = written(one.mapInArrow(_features, "doc_id long, toxic int, features array<int>"), "toxic-features")
    rounds = rows.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(ROUNDS))))
    rounds = rounds.withColumn("place", even_hash(F.col("round"), F.col("doc_id")))
    # One task, whose input is bounded by the sample.
    ordered = rounds.repartition(1).sortWithinPartitions("round", "place", "doc_id").select("toxic", "features")
    model = sorted(ordered.mapInArrow(_learn, "bucket int, weight double").collect())
    discard(rows)
    return np.array([row[0] for row in model], np.int64), np.array([row[1] for row in model])


def scored(docs: DataFrame, labels: DataFrame, held_out: Column, most: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    ``held_out`` marks, by doc_id, the rows whose labels are not learned from.
    """
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False))
    model = spark.sparkContext.broadcast(fitted(docs, labels, ~held, most))

    def score(batches):
        at, weights = model.value
        dense = np.zeros((1 << BITS) + 1)
        dense[at] = weights
        bias = dense[-1] if len(at) else -np.inf
        for batch in batches:
            sums = []
            for texts in gathered(text.as_py() for text in batch.column("text")):
                of, found = buckets(texts)
                sums.append(np.bincount(of, dense[found], len(texts)) + bias)
            total = np.concatenate(sums) if sums else np.zeros(0)
            chance = np.where(np.isinf(total), 0.0, 1.0 / (1.0 + np.exp(-np.clip(total, -CERTAIN, CERTAIN))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(chance)], ["doc_id", "score"])

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    chances = texts.mapInArrow(score, "doc_id long, score double")
    return chances.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
