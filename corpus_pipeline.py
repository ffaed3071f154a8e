"""From raw documents to token ids, stage by stage.

Each stage takes all documents that the one before kept and gives documents again; the last gives
the number of ids and digests for every document. ``run`` stores the documents between stages.
Stages store tables of their own as well, which ``run`` deletes once the result of the stage after it
is stored.

Defined cases: a null text fails the quality rules. A document that has lost repeated lines must pass
the base rules again, so that no copy leaves a fragment. Of each group of similar documents the one with the smallest doc_id stays,
with rows that repeat its id and text once; a row with a null doc_id stays if no other id is in
its group. The mixture takes every document at least once, and documents of scarce sources
again, in rows of their own. Columns beside those of documents are dropped. Empty tables give
empty ones.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import byte_bpe, jaccard, line_dedup, mixing, quality_rules
from tidewheel.llm.queries import VOCABULARY, table
from tidewheel.llm.sized import broadcast_if_few
from tidewheel.session import delete_tables, recorded, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def _version() -> Column:
    return F.xxhash64("text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    slim = docs.select("doc_id", "text", _version().alias("version"))
    judged = written(quality_rules.judged(slim, trusted).select("doc_id", "version", "kept"), "judged")
    failed = judged.filter("NOT kept").select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (_version() == F.col("_version"))
    return docs.join(broadcast_if_few(failed), same, "left_anti").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; those that lost some must pass the base rules again."""
    left = line_dedup.deduplicated(docs.select(*COLUMNS))
    cut = F.col("n_removed") > 0
    # The rules are worked out for texts that have changed only.
    told = quality_rules.base_rules(left.withColumn("_left", F.col("text")).withColumn("text", F.when(cut, F.col("text"))))
    size = F.when(cut, F.length("_left").cast("long")).otherwise(F.col("n_chars"))
    kept = told.filter(~cut | ~F.col("base_failed")).withColumn("n_chars", size).withColumn("text", F.col("_left"))
    return kept.select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id."""
    found = written(jaccard.versions(docs), "components")
    copies = found.filter("n_shingles > 0 AND component_id <> doc_id OR doc_id IS NULL AND component_id IS NOT NULL")
    # Rows may share a doc_id, or have none, and differ in their texts.
    goes = copies.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (_version() == F.col("_version"))
    docs = docs.join(broadcast_if_few(goes), same, "left_anti")
    # Ids that occur more than once are rare; only their rows are compared.
    again = written(found.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    if again.isEmpty():
        return docs.select(*COLUMNS)
    some = broadcast_if_few(again)
    once = docs.join(some, "doc_id", "left_semi").withColumn("_version", _version())
    once = once.dropDuplicates(["doc_id", "_version"])
    return docs.join(some, "doc_id", "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids, and digests of the ids and of what they decode to."""
    return byte_bpe.digests(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE", token_ids),
]

#: Hashed likelihoods, components and token ids are not for SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of all documents that come through the stages."""
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with recorded() as paths:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        delete_tables(spark, before)
        before = list(paths)
    return STAGES[-1][1](spark, docs, sf_dir)
