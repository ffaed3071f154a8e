"""Toxicity scores against a learner in plain Python with its own hashing, and on held-out labels."""

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidewheel.llm import queries, toxicity
from tidewheel.llm.hashes import even_hash

MASK = (1 << 64) - 1
BASE, STEP, FINAL = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
LABELS = "doc_id long, quality int, toxic int, text string"


def finished(h):
    h = (h ^ (h >> 32)) * FINAL & MASK
    h = (h ^ (h >> 29)) * STEP & MASK
    return h ^ (h >> 32)


def word_hash(word):
    lowered = word.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    return finished(sum((byte + 1) * pow(BASE, k, 1 << 64) for k, byte in enumerate(lowered)) & MASK)


def features(text):
    words = [word_hash(word) for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    pairs = [finished(((2 * STEP + a) * STEP + b) & MASK) for a, b in zip(words, words[1:])]
    apart = [finished(((a * STEP + b) * STEP + STEP) & MASK) for a, b in zip(words, words[2:])]
    return sorted({h >> 44 for h in words + pairs + apart})


def learned(rows):
    """Weights after all rounds over ``rows`` (features, toxic), each round in its own order."""
    z, n = {}, {}

    def weight(i):
        bound = 0.0 if i == "bias" else toxicity.L1
        left = max(abs(z.get(i, 0.0)) - bound, 0.0)
        return -math.copysign(left, z.get(i, 0.0)) * toxicity.RATE / (toxicity.DAMPING + math.sqrt(n.get(i, 0.0)))

    for found, toxic in rows:
        at = [*found, "bias"]
        w = {i: weight(i) for i in at}
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values())))))
        g = (p - toxic) * (toxicity.WEIGHT if toxic else 1.0)
        for i in at:
            slower = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.RATE
            z[i] = z.get(i, 0.0) + g - slower * w[i]
            n[i] = n.get(i, 0.0) + g * g
    return weight


def run(spark, docs, labels, most=toxicity.LABELLED):
    made = spark.createDataFrame(labels or [], "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    held = F.col("doc_id") % 5 == 0
    return sorted(map(tuple, toxicity.scored(docs, made, held, most).collect()), key=repr)


@pytest.mark.parametrize("most", [1000, 25])
def test_same_as_plain_python(spark, make_docs, most):
    texts = {i: f"the Plain words {i % 7} of text {i % 11} " + ("awful Thing indeed" if i % 4 == 1 else "fine thing") for i in range(60)}
    toxic = {i: int(i % 4 == 1) for i in range(50)}
    got = run(spark, make_docs(texts.items()), [(i, 1, t) for i, t in toxic.items()], most)
    ids = [i for i in toxic if i % 5]
    places = spark.createDataFrame([(i, r) for i in ids for r in range(6)], "doc_id long, r int")
    hashes = {
        (row["doc_id"], row["r"]): (row["first"], row["later"])
        for row in places.select("*", even_hash(F.lit("toxic"), F.col("doc_id")).alias("first"), even_hash(F.col("r"), F.col("doc_id")).alias("later")).collect()
    }
    ids = sorted(ids, key=lambda i: hashes[i, 0][0])[:most]
    order = [i for r in range(1, toxicity.ROUNDS + 1) for i in sorted(ids, key=lambda i: hashes[i, r][1])]
    weight = learned([(features(texts[i]), toxic[i]) for i in order])
    for doc_id, held_out, score, predicted in got:
        total = sum(weight(i) for i in features(texts[doc_id])) + weight("bias")
        assert held_out == (doc_id % 5 == 0)
        assert score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
        assert predicted == int(score >= 0.5)
    assert {p for _, _, _, p in got} == {0, 1}


def test_odd_rows(spark, make_docs):
    long = "plain " * 200_000 + "awful thing"
    texts = [(i, "awful thing" if i % 2 else "plain text") for i in range(1, 40)]
    odd = [(None, "awful thing"), (None, None), (3, None), (3, "awful thing"), (50, ""), (51, long), (52, "awful thing"), (52, "awful thing")]
    labels = [(i, 1, i % 2) for i in range(1, 40)] + [(None, 1, 1), (2, 1, 2), (4, 1, None), (6, 1, 1), (6, 1, 0), (999, 0, 1)]
    rows = run(spark, make_docs(texts + odd), labels)
    assert len(rows) == len(texts) + len(odd)
    assert len({score for doc_id, _, score, _ in rows if doc_id == 52}) == 1
    assert {p for doc_id, _, _, p in rows if doc_id in (51, 52)} == {1}
    assert [held for doc_id, held, _, _ in rows if doc_id is None] == [False, False]
    # Null and empty texts have the score of the bias.
    assert len({score for doc_id, _, score, _ in rows if doc_id in (50, 3) or doc_id is None}) == 2


def test_without_labels_or_rows(spark, make_docs):
    assert run(spark, make_docs([(1, "some text"), (2, None)]), []) == [(1, False, 0.0, 0), (2, False, 0.0, 0)]
    assert run(spark, make_docs([]), [(1, 1, 1)]) == []


def test_scores_do_not_depend_on_layout_or_on_other_columns(spark, make_docs):
    texts = [(i, "awful thing" if i % 3 == 1 else f"plain text {i % 5}", f"s{i}") for i in range(1, 60)]
    labels = [(i, 1, int(i % 3 == 1)) for i in range(1, 60)]
    first = run(spark, make_docs(texts), labels)
    moved = make_docs([(i, t, "other") for i, t, _ in texts]).repartition(7).withColumn("lang", F.lit(None).cast("string"))
    assert run(spark, moved, labels) == first


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op13_ftrl_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = rows.join(labels, "doc_id").filter("held_out").select("doc_id", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 for row in held)
    caught = [row["predicted"] for row in held if row["toxic"]]
    wrong = [row["predicted"] for row in held if not row["toxic"]]
    # Some labels stand on junk without any toxic word.
    assert sum(caught) / len(caught) > 0.7
    assert sum(wrong) / len(wrong) < 0.01
