import hashlib
import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from harness import spark_rows
from pyspark.sql import functions as F

from tidewheel.llm import quality_rules as qr
from tidewheel.llm import queries, resampling
from tidewheel.llm.shingles import Text

FOLDER = "/root/testdata/sf0.001"


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[n : n + 8]) for n in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {n + k for n, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return words, (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def buckets(words):
    own = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pairs = [
        xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42))
        for a, b in zip(own, own[1:], strict=False)
    ]
    return [h & ((1 << qr.BUCKET_BITS) - 1) for h in own + pairs]


def brute(rows, trusted):
    raw, target = Counter(), Counter()
    cut = [(doc_id, *measures(text)) for doc_id, text in rows]
    for doc_id, words, _ in cut:
        raw.update(buckets(words))
        if doc_id in trusted:
            target.update(buckets(words))
    every, wanted = sum(raw.values()), sum(target.values())

    def weight(b, own):
        return math.log((max(target[b] - own, 0) / wanted + qr.SMOOTH) / ((raw[b] - 1) / every + qr.SMOOTH)) if wanted else 0.0

    out = []
    for doc_id, words, found in cut:
        own = buckets(words)
        llr = sum(weight(b, doc_id in trusted) for b in own) / len(own) if own else None
        failed = found[0] < 20 or 100 * found[4] > 30 * found[0]
        out.append((doc_id, *found, None if llr is None else round(llr, 9), failed, not failed and llr >= qr.THRESHOLD))
    return sorted(out, key=repr)


def judged(docs, ids):
    rows = qr.judged(docs, ids).collect()
    return sorted(
        (
            (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
             None if r.llr is None else round(r.llr, 9), r.base_failed, r.kept)
            for r in rows
        ),
        key=repr,
    )


def corpus():
    good = "the quick brown fox jumps over the lazy dog and runs far away from all of its many happy friends today"
    junk = " ".join(f"x{n}### | y{n}$$$" for n in range(30))
    rows = [(n, f"{good} number {n}\nand a short end") for n in range(60)] + [(100 + n, junk + f" {n}") for n in range(30)]
    rows += [(200, None), (201, ""), (202, " \n\t\x0b"), (203, "a " * 100), (204, "é" * 50 + "\x1c b\xa0c"), (None, good)]
    rows += [(205, "one two three four five six seven eight " * 2), (206, "w " * 5000 + good), (0, "again"), (0, "again")]
    return rows


def test_measures_ratio_and_verdict(spark, make_docs):
    rows = corpus()
    ids = spark.createDataFrame([(n,) for n in (*range(40), 1, 206, None)], "doc_id long")
    got = judged(make_docs(rows), ids)
    assert got == brute(rows, {*range(40), 206})
    kept = {r[0] for r in got if r[-1]}
    assert set(range(1, 60)) <= kept and not kept & set(range(100, 130))


def test_no_trusted_rows_and_no_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long")
    assert judged(make_docs(corpus()), none) == brute(corpus(), set())
    assert judged(make_docs(corpus()).limit(0), none) == []


def test_verdicts_do_not_depend_on_the_size_of_the_corpus(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    trusted = qr.trusted_ids(spark.read.parquet(f"{folder}/labels.parquet"))
    some = docs.filter("doc_id % 4 = 0")
    alone = {r.doc_id: r.kept for r in qr.judged(some, trusted).select("doc_id", "kept").collect()}
    # Four times as many documents, and the same ones several times over.
    whole = {r.doc_id: r.kept for r in qr.judged(docs, trusted).select("doc_id", "kept").collect()}
    more = some.crossJoin(spark.range(6).select(F.col("id").alias("copy"))).drop("copy")
    copied = {r.doc_id: r.kept for r in qr.judged(more, trusted).select("doc_id", "kept").collect()}
    assert sum(copied[i] == alone[i] for i in alone) >= 0.995 * len(alone)
    assert sum(alone[i] == whole[i] for i in alone) >= 0.985 * len(alone)


def test_base_rules_alone_are_those_of_the_verdict(make_docs, spark):
    docs = make_docs(corpus()).select("doc_id", "text")
    none = spark.createDataFrame([], "doc_id long")
    want = sorted((repr(r.doc_id), r.base_failed) for r in qr.judged(docs, none).collect())
    got = qr.base_rules(docs)
    assert got.columns == ["doc_id", "text", "base_failed"]
    assert sorted((repr(r.doc_id), r.base_failed) for r in got.collect()) == want


def test_query_over_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    want = brute(rows, {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0})
    names, got = spark_rows(queries.op6_likelihood_rules(spark, FOLDER))
    order = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]
    assert sorted(order) == names
    picked = sorted((tuple(r[names.index(n)] for n in order) for r in got), key=repr)
    assert [r[:6] + r[7:] for r in picked] == [r[:6] + r[7:] for r in want]
    assert all(a[6] == pytest.approx(b[6], abs=1e-8) for a, b in zip(picked, want, strict=True) if b[6] is not None)


def test_hashes_tell_words_apart():
    texts = [b"The the THE tHe", b"of\x0bthe\x0c\xc3\x89", None, b"", b"a" * 700_000 + b" the", b"\xc3\xa9 the"]
    text = Text(texts)
    words = [w for t in texts for w in (t or b"").lower().split()]
    assert len(text.hashes) == len(words) == text.bounds[-1]
    assert len({(w, h) for w, h in zip(words, text.hashes.tolist(), strict=True)}) == len(set(words)) == len(set(text.hashes.tolist()))
    assert text.bounds.tolist() == [0, 4, 7, 7, 7, 9, 11]


MASK = (1 << 64) - 1
BASE, STEP, FINAL = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93


def finished(h):
    h = (h ^ (h >> 32)) * FINAL & MASK
    h = (h ^ (h >> 29)) * STEP & MASK
    return h ^ (h >> 32)


def plain_buckets(text):
    """Buckets of words and of pairs of neighbours, byte by byte."""
    own = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        raw = word.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
        own.append(finished(sum((byte + 1) * pow(BASE, k, 1 << 64) for k, byte in enumerate(raw)) & MASK))
    pairs = [finished(((2 * STEP + a) * STEP + b) & MASK) for a, b in zip(own, own[1:], strict=False)]
    return [h >> (64 - resampling.BUCKET_BITS) for h in own + pairs]


def brute_weights(rows, target):
    raw, wanted, own = Counter(), Counter(), {}
    for doc_id, text in rows:
        own[doc_id, text] = found = plain_buckets(text)
        raw.update(found)
        if doc_id in target:
            wanted.update(found)
    share = sum(wanted.values()) / sum(raw.values())
    weight = {b: math.log((wanted[b] + resampling.SMOOTH) / (n * share + resampling.SMOOTH)) for b, n in raw.items()}
    return {key: sum(weight[b] for b in found) for key, found in own.items()}


def gumbel(doc_id):
    told = f"gumbel:{'' if doc_id is None else doc_id}"
    even = (int(hashlib.md5(told.encode()).hexdigest()[:15], 16) + 0.5) / float(1 << 60)
    return -math.log(-math.log(even))


def test_weights_and_draw(spark, make_docs):
    rows = corpus()
    target = spark.createDataFrame([(n,) for n in (*range(40), None)], "doc_id long")
    got = resampling.resampled(make_docs(rows), target, 0.5).collect()
    want = brute_weights(rows, set(range(40)))
    assert sorted(round(r.log_weight, 6) for r in got) == sorted(round(want[key], 6) for key in rows)
    for r in got:
        assert r.key == pytest.approx(r.log_weight + gumbel(r.doc_id), abs=1e-9)
    keys = sorted((r.key for r in got), reverse=True)
    count = round(0.5 * len(rows))
    assert sum(r.kept for r in got) == count
    assert min(r.key for r in got if r.kept) >= keys[count - 1]
    again = resampling.resampled(make_docs(rows).repartition(2), target, 0.5).collect()
    assert sorted((repr(r.doc_id), r.key, r.kept) for r in got) == sorted((repr(r.doc_id), r.key, r.kept) for r in again)


def test_draw_follows_the_weights_and_empty_cases(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long")
    plain = resampling.resampled(make_docs([(n, "same words here") for n in range(400)]), none, 0.25).collect()
    assert sum(r.kept for r in plain) == 100 and {r.log_weight for r in plain} == {0.0}
    # Gumbel noise: mean 0.577, variance 1.645.
    mean = sum(r.key for r in plain) / 400
    assert abs(mean - 0.577) < 0.25
    assert resampling.resampled(make_docs([(1, "x")]).limit(0), none, 0.5).count() == 0


def test_held_out_labels_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = qr.trusted_ids(labels).filter("doc_id % 2 = 0")
    kept = resampling.resampled(docs, half, 0.87).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    shares = {(r.quality, r.toxic): r.share for r in kept.groupBy("quality", "toxic").agg({"kept": "count"}).withColumnRenamed("count(kept)", "share").collect()}
    good = kept.filter("quality = 1 AND toxic = 0")
    bad = kept.filter("quality = 0")
    assert good.filter("kept").count() >= 0.97 * shares[1, 0]
    assert bad.filter("kept").count() <= 0.2 * bad.count()
