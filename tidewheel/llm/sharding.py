"""Rows dealt to shards of bounded size by extendible hashing.

A row's hash is that of its doc_id and text. The directory starts with one shard of all rows; a shard over
the byte limit splits by the next bit of the hash, and only such a shard does, until each fits. So
a shard is named by its depth (number of leading bits) and its prefix (their value). Several
bits are looked at in one round: sums are taken by the deepest prefix of the round, and the depth
of a row is the first at which its shard fits. Only rows of shards that don't fit yet go on.

A row that is over the limit by itself gets a shard of its own, and rows that agree in doc_id and
text, which no bit tells apart, share one; both are marked ``oversized``. A null doc_id or text
hashes as ''. A null text has no bytes. Texts of any length count whole. Extra columns are not
read, and kept by ``write_shards``. An empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.hashes import HASH_BITS, even_hash
from tidewheel.session import written

# Parameters.
SHARD_BYTES = 1 << 20
ROUND_BITS = 8  # bits that one round looks at
MOST_BITS = 56


def prefix(bits: Column | int) -> Column:
    """The leading bits of the hash."""
    return F.call_function("shiftright", F.col("_hash"), F.lit(HASH_BITS) - bits)


def _round(rows: DataFrame, base: int, limit: int) -> DataFrame:
    """Deepest prefixes of this round with the depth and size of their shard; null if none fits."""
    deepest = base + ROUND_BITS
    cells = rows.groupBy(prefix(deepest).alias("_cell")).agg(F.sum("bytes").alias("size"), F.count(F.lit(1)).alias("n"))
    first = base + 1 if base else 0
    depth = F.explode(F.sequence(F.lit(first), F.lit(deepest))).alias("depth")
    deep = written(cells, "cells").select("_cell", "size", "n", depth)
    deep = deep.withColumn("prefix", F.call_function("shiftright", "_cell", F.lit(deepest) - F.col("depth")))
    shards = deep.groupBy("depth", "prefix").agg(F.sum("size").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") >= MOST_BITS)
    fitting = deep.select("_cell", "depth", "prefix").join(shards.filter(fits), ["depth", "prefix"])
    found = fitting.groupBy("_cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("shard"))
    return found.select("_cell", "shard.*")


def _row_hash() -> Column:
    return even_hash(F.col("doc_id"), F.col("text"))


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Each row's doc_id and bytes with its shard: depth, prefix, shard_bytes, shard_rows, oversized."""
    return _placed(docs, limit).drop("_hash")


def _placed(docs: DataFrame, limit: int) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = written(docs.select("doc_id", size.alias("bytes"), _row_hash().alias("_hash")), "rows")
    parts, base = [], 0
    while True:
        found = written(_round(rows, base, limit), "shards")
        keyed = rows.withColumn("_cell", prefix(base + ROUND_BITS))
        parts.append(keyed.join(found, "_cell").drop("_cell"))
        base += ROUND_BITS
        if base >= MOST_BITS:
            break
        rows = written(keyed.join(found, "_cell", "left_anti").drop("_cell"), "rows")
        if rows.isEmpty():
            break
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("oversized", F.col("shard_bytes") > limit)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Writes the rows of ``docs`` as Parquet, one folder per shard.

    Rows of one shard meet in one task; a shard holds the byte limit at most, unless it is oversized.
    """
    names = _placed(docs, limit).select("_hash", F.concat_ws("-", "depth", "prefix").alias("shard")).distinct()
    named = docs.withColumn("_hash", _row_hash()).join(names, "_hash").drop("_hash")
    named.repartition("shard").write.partitionBy("shard").parquet(path)


#: What ``sharded`` gives for documents, with the default parameters.
SQL = f"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
shards AS (
    SELECT d, h >> ({HASH_BITS} - d) AS p, sum(bytes)::BIGINT AS size, count(*) AS n
    FROM docs, unnest(range(0, {MOST_BITS + 1})) AS u(d) GROUP BY ALL),
found AS (
    SELECT docs.*, min(d) AS depth FROM docs JOIN shards ON h >> ({HASH_BITS} - d) = p
    WHERE size <= {SHARD_BYTES} OR n = 1 OR d >= {MOST_BITS} GROUP BY ALL)
SELECT doc_id, bytes, depth::INTEGER AS depth, p AS prefix, size AS shard_bytes, n AS shard_rows,
       size > {SHARD_BYTES} AS oversized
FROM found JOIN shards ON depth = d AND h >> ({HASH_BITS} - d) = p
"""
