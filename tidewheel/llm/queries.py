"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import byte_bpe, context_mixing, jaccard, line_dedup, merkle, mixing, multi_index, phrases, quality_rules, resampling, sharding, substring_dedup, toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model score of every document."""
    return context_mixing.score(table(spark, folder, "documents"))


def op2_extendible_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document."""
    return sharding.sharded(table(spark, folder, "documents"))


def op3_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every pass of every document in the mixture of sources."""
    taken = mixing.mixed(table(spark, folder, "documents").select("doc_id", "source", "text"))
    whole = taken.drop("text").withColumn("source", F.coalesce("source", F.lit("")))
    return whole.withColumn("mix_weight", F.round("mix_weight", 9))


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of similar n-grams."""
    return jaccard.joined(table(spark, folder, "documents"))


def op5_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return multi_index.nearest(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op6_likelihood_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and verdict of every document."""
    trusted = quality_rules.trusted_ids(table(spark, folder, "labels"))
    return quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text"), trusted)


def op7_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight and verdict of every document, drawn towards the ones labelled good."""
    labels = table(spark, folder, "labels")
    # As many documents as the labels call good; those that are not toxic are the target.
    share = labels.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0] or 0.0
    return resampling.resampled(table(spark, folder, "documents"), quality_rules.trusted_ids(labels), share)


def op8_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Passages that several documents share."""
    return substring_dedup.repeated(table(spark, folder, "documents"))


def op9_line_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Lines removed from every document, and a digest of what is left."""
    left = line_dedup.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    return byte_bpe.digests(table(spark, folder, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op11_pair_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of every language whose words occur together."""
    return phrases.mined(table(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digests, proof and check of every document."""
    return merkle.checked(table(spark, folder, "documents"))


def op13_ftrl_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the labels is held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_context_mixing, op2_extendible_shards, op3_temperature_mix, op4_ngram_jaccard, op5_multi_index, op6_likelihood_rules, op7_importance_resampling, op8_paragraph_minhash, op9_line_neighbours, op10_byte_bpe, op11_pair_tiles, op12_merkle_manifest, op13_ftrl_toxicity)}


def oracle_sql() -> dict[str, str]:
    return {"op2_extendible_shards": sharding.SQL, "op3_temperature_mix": mixing.SQL, "op9_line_neighbours": line_dedup.SQL, "op11_pair_tiles": phrases.SQL, "op12_merkle_manifest": merkle.SQL}
