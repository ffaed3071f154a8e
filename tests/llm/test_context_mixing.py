import binascii
import math
import random
from collections import Counter

import numpy as np
import pytest

from tidewheel.llm import context_mixing as cm


def base(rows):
    """What the scores rest on, by plain counting."""
    def held(doc_id):
        return doc_id is None or binascii.crc32(str(doc_id).encode()) % 10 == 0

    counts = Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            counts.update([*(text or "").encode().lower().split(), None])
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        tokens = [*(text or "").encode().lower().split(), None]
        score = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens)
        out.append((doc_id, held(doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), total, round(score, 6)))
    return sorted(out, key=repr)


def scored(spark, rows, lang=None):
    docs = spark.createDataFrame([(i, t, lang, 1) for i, t in rows], "doc_id long, text string, lang string, c long")
    return cm.score(docs).collect()


def test_base_columns_and_odd_rows(spark):
    rng = random.Random(3)
    words = ["Of", "of", "the", "tion", "é", "x y", "\x1cz", "ing"]
    rows = [(n, " \t\n\x0b".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, " \r\n"), (None, "the end"), (7, "the the"), (7, "the the"), (200, "w" * 20_000)]
    got = scored(spark, rows, "en")
    plain = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr
    )
    assert plain == base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in got)


def test_no_training_rows_and_no_rows(spark):
    held = next(n for n in range(100) if binascii.crc32(str(n).encode()) % 10 == 0)
    (row,) = scored(spark, [(held, "a b")])
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert math.isfinite(row.score)
    assert scored(spark, []) == []


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return cm.score(docs).collect()


def test_model_beats_the_base_on_held_out_texts(corpus):
    held = [r for r in corpus if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_all_next_bytes_sum_to_one():
    rng = np.random.default_rng(0)
    odds = rng.integers(-60, 60, (cm.PREDICTORS, 1 << cm.SLOT_BITS)).astype(np.int8)
    mixer = cm.Mixer(odds, rng.uniform(0, 0.5, (cm.GATES, cm.PREDICTORS)), cm._plain_map())
    # One byte words: the byte, then a space.
    first = [bytes([b]) for b in range(256) if b not in (cm.SPACE, cm.END)]
    alone = mixer.score(first)
    after = {word: mixer.score([word + bytes([b]) for b in range(256) if b not in (cm.SPACE, cm.END)]) for word in first[:3]}
    assert (10**alone).sum() <= 1 + 1e-6
    for word, longer in after.items():
        # A word, and all words of one byte more, are different texts.
        assert 10 ** alone[first.index(word)] + (10**longer).sum() <= 1


def test_gate_follows_the_better_model():
    good, bad = np.full(200, -1.0), np.full(200, -3.0)
    got = cm.gated(np.vstack([bad, good]))
    assert -200 * 1.05 < got < -199


def test_scores_do_not_depend_on_the_layout(spark, corpus):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
    try:
        again = cm.score(docs).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in corpus)


def test_steps_are_the_same_for_all_batches():
    import pyarrow as pa

    rows = [(n // 900, b"%d" % n, n + 1) for n in range(2000)]

    def batches(size):
        for at in range(0, len(rows), size):
            some = rows[at : at + size]
            yield pa.RecordBatch.from_pydict({"learner": [r[0] for r in some], "word": [r[1] for r in some], "c": [r[2] for r in some]})

    def told(size):
        return [(learner, [(words, c.tolist()) for words, c in steps]) for learner, steps in cm._steps(batches(size))]

    assert told(7) == told(2000)
    assert [learner for learner, _ in told(100)] == [0, 1, 2]


def test_a_word_is_predicted_from_the_one_before_it(spark):
    """Two words with equal counts everywhere, whose order alone tells texts apart."""
    rng = random.Random(5)
    pairs = [("red", "fox"), ("old", "hat")]
    rows = [(n, " ".join(w for _ in range(20) for w in rng.choice(pairs))) for n in range(400)]
    held = [n for n in range(1000, 1400) if binascii.crc32(str(n).encode()) % 10 == 0][:2]
    rows += [(held[0], "red fox old hat " * 10), (held[1], "red hat old fox " * 10)]
    found = {r.doc_id: r for r in scored(spark, rows)}
    usual, odd = found[held[0]], found[held[1]]
    assert usual.base_score == pytest.approx(odd.base_score)
    assert usual.score > odd.score + 5


def test_joints_and_words_code_each_byte_of_a_text_after_the_bytes_before_it():
    words = [b"of", b"thered", b"a", b"the", b"x" * 30, b"ab", b"thered"]
    ids = np.array([0, 1, 2, 3, 4, 5, 1], "<i4")
    distinct = [b"of", b"thered", b"a", b"the", b"x" * 30, b"ab"]
    running = cm.Running(distinct, cm._packed(ids.tobytes()), [len(ids)])
    joints = running.joints(running.keys)
    assert joints == [cm.joint(before, word) for before, word in zip([b"", *words], [*words, cm.END_TOKEN], strict=True)]
    coded = [bytes(cm.spell([one]).codes) for pair in zip(joints, [*words, cm.END_TOKEN], strict=True) for one in pair]
    assert b"".join(coded) == b" ".join(words) + b" " + cm.END_TOKEN
    # The contexts of 1 to ORDERS bytes are those of the running text, from the start of the word before on.
    for before, word, pair in zip([b"", *words], [*words, cm.END_TOKEN], joints, strict=True):
        text, at = before + b" " + word + b" ", len(before) + 1
        for spelling in (cm.spell([pair]), cm.spell([word])):
            for place in range(len(spelling.codes)):
                for k in range(1, cm.ORDERS + 1):
                    seen = int.from_bytes(text[max(at - k, 0) : at], "big")
                    own = (seen + (k << 56)) * int(cm.MULTIPLIERS[1]) % 2**64
                    assert int(spelling.contexts[k - 1][place]) == own
                at += 1


def plainly_spelled(mixer, text, start, coded_from):
    """log10 probability of the bytes of a stretch from ``coded_from`` on, bit by bit in Python."""
    wrap, total = 2**64, 0.0
    m = [int(x) for x in cm.MULTIPLIERS]
    weights = mixer.weights.astype(np.float32).astype(float)
    for at in range(coded_from, len(text)):
        hashes = []
        for k in (*range(1, cm.ORDERS + 1), cm.FAR):
            seen = int.from_bytes(text[max(at - k, 0) : at], "big")
            hashes.append((seen + (k << 56)) * m[1] % wrap)
        so_far = sum((byte + 1) * pow(m[2], place + 1, wrap) for place, byte in enumerate(text[start:at]))
        hashes.append((so_far + cm.PREDICTORS) * m[1] % wrap)
        for t in range(cm.DEPTHS[text[at]]):
            bit, gate = int(cm.BITS[t][text[at]]), min(at - start, 3) + min(t, 7) * 4
            node = int(cm.NODES[cm.PATHS[t][text[at]]])
            slots = [((h ^ node) * m[0] % wrap) >> (64 - cm.SLOT_BITS) for h in hashes]
            odds = sum(weights[gate, k] * mixer.odds[k][slot] / 10 for k, slot in enumerate(slots))
            odds = min(max(odds, -8), 8)
            low = min(int((odds + 8) * 2), cm.LEVELS - 2)
            part = (odds + 8) * 2 - low
            refined = mixer.refined[gate * cm.LEVELS + low : gate * cm.LEVELS + low + 2]
            odds = (refined[0] * (1 - part) + refined[1] * part + odds) / 2
            total -= math.log10(1 + math.exp(-odds if bit else odds))
    return total


def test_stretches_are_spelled_from_arrow_in_pieces_as_bit_by_bit(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(cm, "FEW", 3)
    rng = np.random.default_rng(8)
    odds = rng.integers(-60, 60, (cm.PREDICTORS, 1 << cm.SLOT_BITS)).astype(np.int8)
    mixer = cm.Mixer(odds, rng.uniform(0, 0.5, (cm.GATES, cm.PREDICTORS)), cm._plain_map() + rng.normal(0, 1, cm.GATES * cm.LEVELS))
    words = [b"a", b"of", b"the", b"\xc3\xa9tude", b"x" * 40, cm.END_TOKEN, b"\x00\xff\x00zq", b"thered"]
    joints = [cm.joint(before, word) for before in (b"", b"a", b"red") for word in words]
    stretches = words + joints
    expected = []
    for one in stretches:
        joined = b" " in one
        text = one if joined else b" " + one + (b"" if one == cm.END_TOKEN else b" ")
        start = text.index(b" ") + 1
        expected.append(plainly_spelled(mixer, text, start, start if joined else start + cm.HEAD))
    # A slice, as batches of a table are.
    told = pa.array([b"before", *stretches, None], pa.binary()).slice(1, len(stretches))
    assert mixer.spelled(told) == pytest.approx(expected, abs=1e-4)
    assert mixer.spelled(stretches).tolist() == mixer.spelled(told).tolist()
    begun = dict(zip(stretches, expected, strict=True))
    assert mixer.begun(pa.array(words, pa.binary())) == pytest.approx([begun[cm.joint(b"", word)] for word in words], abs=1e-4)
    batch = pa.RecordBatch.from_pydict({"word": told, "c": pa.array(range(len(stretches)), pa.int64())})
    parts = list(cm.batches_of(iter([batch]), 5))
    assert all(isinstance(part, pa.Array) for part, _ in parts)
    assert sum((part.to_pylist() for part, _ in parts), []) == stretches
