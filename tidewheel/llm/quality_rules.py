"""Rules on words and lines, and a likelihood ratio of hashed n-grams with a fixed threshold.

Words are runs of anything but space and the characters 09 to 0D. Single words and pairs of
neighbours are hashed to buckets. Two multinomials over buckets are counted: one from trusted
rows, one from all rows. A bucket weighs the log of its share among trusted rows over its share
of the raw corpus, both smoothed by the same share, so that rare n-grams weigh little. An occurrence
does not count for itself: it is taken out of the corpus, and of the trusted rows if it is in one. As
nothing but shares enters, a corpus of the same kind of text gives the same weights whatever its
size. A text scores the mean weight of its n-grams, and is rejected below a fixed threshold. All of
it is DataFrame functions; the weights are one table of fixed length.

A null text has no words and fails the base rules, as an empty one does. Texts of any length are
judged whole. Rows are judged one by one, repeated rows too. Without trusted rows the ratio says
nothing: every weight is 0. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.sized import broadcast_if_few

# Parameters.
BUCKET_BITS = 18
SMOOTH = 4e-5  # share of all n-grams
THRESHOLD = -0.1
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent

GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of the text (``_words``), their number (``_n``), and the hashes of
    words (``_hashes``) and of pairs of neighbours (``_pairs``)."""
    text = F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(SPACES))
    df = docs.withColumn("_trimmed", text)
    words = F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", GAP))
    df = df.withColumn("_words", words).drop("_trimmed")
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).withColumn("_n", F.size("_words"))
    first = F.slice("_hashes", F.lit(1), F.greatest(F.col("_n") - 1, F.lit(0)))
    return df.withColumn("_pairs", F.transform(first, lambda h, i: F.xxhash64(h, F.col("_hashes")[i + 1])))


def ngrams() -> Column:
    """Hashes of all words and of all pairs of neighbours."""
    return F.concat("_hashes", "_pairs")


def bucket() -> Column:
    return F.col("_hash").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).cast("int")


def weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The weight of every bucket that occurs, for an occurrence in a trusted row (``own``) and elsewhere.

    ``trusted`` holds ids (doc_id).
    """
    counts = (
        with_words(_marked(docs.select("doc_id", "text"), trusted))
        .select("_trusted", F.explode(ngrams()).alias("_hash"))
        .groupBy(bucket().alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target"))
    )
    # One row per bucket, so the totals of both multinomials need no more than a task.
    whole = Window.partitionBy()
    totals = counts.withColumns({"_target": F.sum("target").over(whole), "_raw": F.sum("raw").over(whole)})

    def weight(out: int) -> Column:
        found = F.greatest(F.col("target") - out, F.lit(0)) / F.col("_target") + SMOOTH
        ratio = F.log(found / ((F.col("raw") - 1) / F.col("_raw") + SMOOTH))
        return F.when(F.col("_target") > 0, ratio).otherwise(F.lit(0.0))

    return totals.select("bucket", weight(1).alias("own"), weight(0).alias("weight"))


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with ``_trusted``, true or null."""
    ids = trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct().withColumn("_trusted", F.lit(True))
    return docs.join(broadcast_if_few(ids), "doc_id", "left")


def repeated_words(df: DataFrame) -> DataFrame:
    """``df`` with the number of words in windows that occur twice or more (``n_repeat_words``)."""
    at = F.when(F.col("_n") >= WINDOW, F.sequence(F.lit(0), F.col("_n") - WINDOW)).otherwise(F.array().cast("array<int>"))
    window = F.transform(at, lambda i: F.xxhash64(*(F.col("_pairs")[i + k] for k in range(0, WINDOW, 2))))
    df = df.withColumn("_windows", window)
    # Most texts repeat no window; only the others are sorted.
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    in_order = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.lit(None).cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_order", F.when(some, in_order).otherwise(nothing))

    def twice(s: Column, i: Column) -> Column:
        before = F.get("_order", i - 1)["h"]
        after = F.get("_order", i + 1)["h"]
        return F.coalesce(before == s["h"], F.lit(False)) | F.coalesce(after == s["h"], F.lit(False))

    df = df.withColumn("_places", F.sort_array(F.transform(F.filter("_order", twice), lambda s: s["i"])))
    # Each window adds the words up to the next one, at most its own.
    steps = F.transform(
        "_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - p, F.lit(WINDOW)))
    )
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, s: acc + s)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_windows", "_order", "_places")


def _base_failed(n_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n_words)


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base_failed``, by the text alone."""
    df = repeated_words(with_words(docs))
    # Through a generator: a filter on the verdict would otherwise work the measures out once more per word.
    df = df.withColumn("base_failed", F.explode(F.array(_base_failed(F.col("_n")))))
    return df.select(*[name for name in docs.columns if name != "base_failed"], "base_failed")


def judged(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` without the text, with the base measures, ``llr`` (null without words) and ``kept``.

    Columns of ``docs`` with the name of a measure are replaced; names that begin with an
    underscore are reserved.
    """
    df = repeated_words(with_words(_marked(docs.drop(*MEASURES, "llr", "base_failed", "kept"), trusted)))
    df = df.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    df = df.withColumn("_lines", F.filter("_lines", lambda line: line.rlike(HAS_WORD)))
    df = (
        df.withColumn("n_words", F.col("_n").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_hash", F.explode_outer(ngrams()))
        .drop("text", "_words", "_hashes", "_pairs", "_n", "_lines")
    )
    # At most 1 << BUCKET_BITS rows, whatever the corpus.
    table = weights(docs, trusted).select(F.col("bucket").alias("_bucket"), F.col("own").alias("_own"), F.col("weight").alias("_other"))
    weighed = df.join(F.broadcast(table), bucket() == F.col("_bucket"), "left")
    weighed = weighed.withColumn("_weight", F.when(F.col("_trusted"), F.col("_own")).otherwise(F.col("_other")))
    # The n-grams of a row lie in one task, so that one partial sum of each row is shuffled. The
    # measures are the same on all of them.
    others = [name for name in df.columns if name not in ("_hash", "_row", "_trusted", "doc_id", *MEASURES)]
    same = [F.max(name).alias(name) for name in ("doc_id", *MEASURES)]
    df = weighed.groupBy("_row", *others).agg(*same, F.avg("_weight").alias("llr")).drop("_row")
    df = df.withColumn("base_failed", _base_failed(F.col("n_words")))
    return df.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= THRESHOLD, F.lit(False)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of rows that are labelled good and not toxic."""
    return labels.filter("quality = 1 AND toxic = 0").select("doc_id")
