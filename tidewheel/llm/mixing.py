"""Sources mixed to weights that are a power of their token shares.

Source i has the share p of all tokens and gets a weight in proportion to p ** a. The exponent a is
found by bisection: the smallest between 0 (all sources alike) and 1 (as they are) that keeps
the most repeated source within a number of passes over its rows, if the least repeated one is
passed once; or the one with a given entropy, above 1 where that is less than the sources have. An
entropy that no exponent gives is an error. A weight times the token budget is a number of
passes. Each pass of a source is a permutation of its rows by a hash that differs by pass: blocks
in the order of the upper bits, rows in the order of the rest. Whole passes take all rows; the last
one stops before the budget would be exceeded. Without a budget the least repeated source is passed
exactly once, so that every row appears.

Tokens are words and one end mark. A null source counts as the source ''. A null or empty text has
one token. A row's place comes from its doc_id and text; rows that agree in both stand at the same
place and are taken or left together. Texts of any length count whole. Extra columns are kept. Columns named
mix_* are replaced; names that begin with an underscore are reserved. An empty table gives an empty
one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.hashes import HASH_BITS, even_hash
from tidewheel.llm.sized import broadcast_if_few
from tidewheel.session import written

# Parameters.
REPEATS = 1.5
BLOCK_BITS = 12
STEPS = 60
DOUBLINGS = 20

WORD = r"[^\x20\x09-\x0D]+"


def tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long") + 1


def source() -> Column:
    return F.coalesce(F.col("source"), F.lit(""))


def exponent(shares: Column, repeats: float | None, entropy: float | None) -> Column:
    """Bisects the exponent for the array ``shares``."""

    def meets(a: Column) -> Column:
        if entropy is None:
            passes = F.transform(shares, lambda p: F.pow(p, a - 1))
            return F.array_max(passes) <= F.lit(repeats) * F.array_min(passes)
        # Beside the largest share, so that a high power leaves something.
        powers = F.transform(shares, lambda p: F.pow(p / F.array_max(shares), a))
        mass = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
        # The entropy of x / mass is log(mass) less the mean of log(x).
        logs = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0)))
        return F.log(mass) - logs / mass <= F.lit(entropy)

    def halve(bounds: Column, _: Column) -> Column:
        middle = (bounds["low"] + bounds["high"]) / 2
        ok = meets(middle)
        return F.struct(
            F.when(ok, bounds["low"]).otherwise(middle).alias("low"),
            F.when(ok, middle).otherwise(bounds["high"]).alias("high"),
        )

    # With an entropy the upper bound is doubled until it is high enough.
    doubled = F.aggregate(
        F.sequence(F.lit(1), F.lit(DOUBLINGS)), F.lit(1.0), lambda high, _: F.when(meets(high), high).otherwise(high * 2)
    )
    start = F.struct(F.lit(0.0).alias("low"), (F.lit(1.0) if entropy is None else doubled).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve, lambda bounds: bounds["high"])


def weights(totals: DataFrame, repeats: float | None, entropy: float | None, budget: int | None) -> DataFrame:
    """Per source its weight, number of passes, whole passes and the tokens of the last one.

    ``totals`` has one row per source; their shares meet in one row.
    """
    one = totals.agg(F.sort_array(F.collect_list("total")).alias("totals"), F.sum("total").alias("all"))
    one = one.withColumn("shares", F.transform("totals", lambda t: t / F.col("all")))
    one = one.withColumn("exponent", exponent(F.col("shares"), repeats, entropy))
    mass = F.aggregate("shares", F.lit(0.0), lambda acc, p: acc + F.pow(p, F.col("exponent")))
    # Tokens of one whole pass for each unit of weight: the largest belongs to the least repeated source.
    least = F.array_max(F.transform("shares", lambda p: p / F.pow(p, F.col("exponent")))) * F.col("all") * mass
    one = one.select("all", "exponent", mass.alias("mass"), (F.lit(budget) if budget else least).cast("double").alias("budget"))
    share = F.pow(F.col("total") / F.col("all"), F.col("exponent")) / F.col("mass")
    each = totals.crossJoin(F.broadcast(one)).withColumn("weight", share)  # one row
    each = each.withColumn("passes", F.round(F.col("weight") * F.col("budget") / F.col("total"), 9))
    whole = F.floor("passes")
    rest = F.floor(F.round((F.col("passes") - whole) * F.col("total"), 3))
    return each.select("_source", "weight", "passes", whole.alias("whole"), rest.cast("long").alias("rest"))


def text_digest() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def place(number: Column) -> Column:
    return even_hash(F.col("doc_id"), F.col("_digest"), number)


def block(at: Column) -> Column:
    return F.shiftright(at, HASH_BITS - BLOCK_BITS)


def plan(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """``shares`` with the place at which the last pass stops: its block, and the last place in it.

    ``rows`` has doc_id, _digest, _source and _tokens. Sums of blocks find the block; only its rows are sorted.
    """
    last = rows.join(broadcast_if_few(shares), "_source").withColumn("_place", place(F.col("whole")))
    last = last.withColumn("_block", block(F.col("_place")))
    before = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = last.groupBy("_source", "_block", "rest").agg(F.sum("_tokens").alias("size"))
    sums = sums.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    # The one block in which the budget ends.
    stops = sums.filter("before <= rest AND before + size > rest").select("_source", "_block", "before")
    inside = last.join(broadcast_if_few(stops), ["_source", "_block"])
    running = Window.partitionBy("_source").orderBy("_place", "_tokens", "doc_id")
    inside = inside.withColumn("running", F.col("before") + F.sum("_tokens").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    ends = inside.groupBy("_source", F.col("_block").alias("stop_block")).agg(
        F.max(F.when(F.col("running") <= F.col("rest"), F.struct("_place", "_tokens"))).alias("stop")
    )
    return shares.join(ends, "_source", "left").select("_source", "weight", "passes", "whole", "stop_block", "stop")


def _check(totals: DataFrame, entropy: float) -> None:
    """Raises unless the entropy is one that weights of these sources can have."""
    largest = totals.agg(F.max("total")).scalar()
    some = totals.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("total") == largest).alias("largest")).first()
    if some["all"] and not math.log(some["largest"]) - 1e-9 <= entropy <= math.log(some["all"]) + 1e-9:
        raise ValueError(f"the entropy of {some['all']} sources of these sizes cannot be {entropy}")


def mixed(docs: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it.

    Added are ``mix_weight`` of the source, ``mix_pass`` (from 0), ``mix_block`` and ``mix_place``:
    reading in the order of pass, block and place reads the permutations.
    """
    slim = docs.select("doc_id", source().alias("_source"), tokens().alias("_tokens"), text_digest().alias("_digest"))
    slim = written(slim, "mix-rows")
    totals = slim.groupBy("_source").agg(F.sum("_tokens").alias("total"))
    if entropy is not None:
        _check(totals, entropy)
    shares = written(weights(totals, repeats, entropy, budget), "mix-weights")
    ends = written(plan(slim, shares), "mix-plan")
    ends = ends.select("_source", *(F.col(name).alias(f"_{name}") for name in ("weight", "whole", "stop_block", "stop")))
    added = ("mix_weight", "mix_pass", "mix_block", "mix_place")
    docs = docs.drop(*added)
    rows = docs.withColumns({"_source": source(), "_tokens": tokens(), "_digest": text_digest()}).join(broadcast_if_few(ends), "_source")
    rows = rows.withColumn("mix_pass", F.explode(F.sequence(F.lit(0), F.col("_whole").cast("int"))))
    rows = rows.withColumn("mix_place", place(F.col("mix_pass"))).withColumn("mix_block", block(F.col("mix_place")))
    here = F.struct(F.col("mix_place").alias("_place"), "_tokens")
    last = (F.col("mix_block") == F.col("_stop_block")) & (here <= F.col("_stop"))
    taken = (F.col("mix_pass") < F.col("_whole")) | F.coalesce((F.col("mix_block") < F.col("_stop_block")) | last, F.lit(False))
    return rows.filter(taken).select(*docs.columns, F.col("_weight").alias("mix_weight"), *added[1:])


#: What ``mixed`` takes from documents, with the default parameters.
SQL = f"""
WITH RECURSIVE slim AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(text, '')) AS digest,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) + 1 AS tokens
    FROM documents),
totals AS MATERIALIZED (SELECT source, sum(tokens)::DOUBLE AS total FROM slim GROUP BY source),
bounds AS (SELECT min(total) AS low, max(total) AS high, sum(total) AS everything FROM totals),
bisect(step, low, high) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT step + 1,
           CASE WHEN pow(b.low / everything, (bisect.low + bisect.high) / 2 - 1)
                     <= {REPEATS} * pow(b.high / everything, (bisect.low + bisect.high) / 2 - 1)
                THEN bisect.low ELSE (bisect.low + bisect.high) / 2 END,
           CASE WHEN pow(b.low / everything, (bisect.low + bisect.high) / 2 - 1)
                     <= {REPEATS} * pow(b.high / everything, (bisect.low + bisect.high) / 2 - 1)
                THEN (bisect.low + bisect.high) / 2 ELSE bisect.high END
    FROM bisect, bounds b WHERE step < {STEPS}),
exponent AS (SELECT high AS a FROM bisect WHERE step = {STEPS}),
powers AS (
    SELECT source, total, pow(total / everything, a) AS power,
           sum(pow(total / everything, a)) OVER () AS mass,
           max(total / pow(total / everything, a)) OVER () AS least
    FROM totals, bounds, exponent),
passes AS (
    SELECT source, total, power / mass AS weight, round(power * least / total, 9) AS passes FROM powers),
shares AS MATERIALIZED (
    SELECT source, weight, floor(passes)::BIGINT AS whole,
           floor(round((passes - floor(passes)) * total, 3))::BIGINT AS rest FROM passes),
placed AS (
    SELECT s.doc_id, s.source, s.tokens, weight, whole, rest, p AS mix_pass,
           ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':' || digest || ':' || p), 1, 15))::BIGINT AS mix_place
    FROM slim s JOIN shares USING (source), unnest(range(0, whole + 1)) AS u(p)),
running AS (
    SELECT *, sum(tokens) OVER (PARTITION BY source, mix_pass ORDER BY mix_place, tokens, doc_id
                                ROWS UNBOUNDED PRECEDING) AS running
    FROM placed)
SELECT doc_id, source, round(weight, 9) AS mix_weight, mix_pass::INTEGER AS mix_pass,
       mix_place >> {HASH_BITS - BLOCK_BITS} AS mix_block, mix_place
FROM running WHERE mix_pass < whole OR running <= rest
"""
