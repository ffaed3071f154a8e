"""Documents resampled towards a target by the ratio of hashed n-gram models.

Words and pairs of neighbours, with A-Z as a-z, are hashed to buckets. One bag-of-n-grams model is
counted on the target rows, one on all rows. A document's log weight is the sum over its n-grams
of the log ratio of the two; both counts are smoothed by the same number of expected n-grams, so
that what is rare in both says little. Adding Gumbel noise to the log weights and keeping the k
largest draws k documents without replacement, in proportion to their weights. The noise comes
from a hash of the doc_id, so that the same documents are drawn in every run.

k is a share of all documents. Every document gets its log weight, key and verdict. The k-th
largest key is found by a distributed sort of ids and keys.

Null and empty texts have weight 0 (in logs). Texts of any length count whole. Extra columns are not
read. An empty table gives an empty one. Rows with the same doc_id have the same noise; ties
go to the smaller doc_id. Without any target row all weights are 0 and the noise alone decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.hashes import HASH_BITS, even_hash
from tidewheel.llm.shingles import Text, gathered
from tidewheel.llm.sized import broadcast_if_few
from tidewheel.llm.workers import importable
from tidewheel.operators.skew import with_position
from tidewheel.session import written

# Parameters.
BUCKET_BITS = 18
SMOOTH = 20.0
CHUNK = 1 << 14


def _buckets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the text of each."""
    text = Text(texts)
    of = np.repeat(np.arange(len(texts)), np.diff(text.bounds))
    pairs = text.runs(2)
    inside = of[:-1] == of[1:] if len(of) else np.zeros(0, bool)
    hashes = np.concatenate([text.hashes, pairs[inside]])
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.concatenate([of, of[:-1][inside]])


def _count(batches):
    counts = np.zeros((1 << BUCKET_BITS, 2), np.int64)
    for batch in batches:
        chosen = iter(batch.column("target").to_pylist())
        for texts in gathered(text.as_py() for text in batch.column("text")):
            wanted = np.array([next(chosen) for _ in texts])
            buckets, of = _buckets(texts)
            counts[:, 0] += np.bincount(buckets, minlength=len(counts))
            counts[:, 1] += np.bincount(buckets[wanted[of]], minlength=len(counts))
    for number, chunk in enumerate(counts.reshape(-1, CHUNK)):
        if chunk.any():
            yield pa.RecordBatch.from_pydict(
                {"chunk": pa.array([number], pa.int32()), "counts": pa.array([chunk.tobytes()], pa.binary())}
            )


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(counts.as_py(), np.int64) for counts in table.column("counts"))
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def log_ratios(marked: DataFrame) -> np.ndarray:
    """The log ratio of each bucket, from rows of text and target: 8 << BUCKET_BITS bytes."""
    counts = np.zeros((2 << BUCKET_BITS) // CHUNK * CHUNK, np.int64).reshape(-1, CHUNK)
    parts = marked.mapInArrow(_count, "chunk int, counts binary").groupBy("chunk")
    for row in parts.applyInArrow(_add, "chunk int, counts binary").collect():
        counts[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    raw, target = counts.reshape(-1, 2).T.astype(np.float64)
    if not target.sum():
        return np.zeros(len(raw))
    return np.log((target + SMOOTH) / (raw * (target.sum() / raw.sum()) + SMOOTH))


def resampled(docs: DataFrame, target: DataFrame, share: float) -> DataFrame:
    """doc_id, log_weight, key and kept of every row of ``docs`` (doc_id, text).

    ``target`` holds the ids of the target rows; ``share`` of all rows are kept, rounded.
    """
    spark = docs.sparkSession
    importable(spark)
    ids = target.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    wanted = broadcast_if_few(ids.withColumn("target", F.lit(True)))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    marked = texts.join(wanted, "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    ratios = spark.sparkContext.broadcast(log_ratios(marked))

    def weigh(batches):
        for batch in batches:
            found = []
            for some in gathered(text.as_py() for text in batch.column("text")):
                buckets, of = _buckets(some)
                found.append(np.bincount(of, ratios.value[buckets], len(some)))
            weights = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), weights], ["doc_id", "log_weight"])

    # Strictly between 0 and 1.
    even = (even_hash(F.lit("gumbel"), F.col("doc_id")) + 0.5) / float(1 << HASH_BITS)
    weighed = texts.mapInArrow(weigh, "doc_id long, log_weight double")
    keyed = written(weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(even))), "keys")
    count = round(share * keyed.count())
    ranked = with_position(keyed, [F.desc("key"), F.asc_nulls_first("doc_id")], "_position")
    return ranked.withColumn("kept", F.col("_position") < count).drop("_position")
