import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from tidewheel.llm import byte_bpe
from tidewheel.llm.queries import VOCABULARY

RANKS = byte_bpe.read_ranks(VOCABULARY)
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.serialise(RANKS), sorted(RANKS.values()), PATTERN)


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_ids_and_round_trip_on_odd_texts(reference, codec):
    rng = random.Random(7)
    parts = ["\x1c", "\x85", "\xa0", " ", "▁", " ", "\n", "\t", "a", "é", "'s", "'LL", "don't", "1", "²", "中"]
    parts += ["\U0001f600", "é", "\x00", "﻿", "​", "<unk>", "Ā", "the", " of", "tion"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = codec.encode(text)
        assert ids == packed(reference.encode_ordinary(text)), text
        assert codec.decode(ids) == text.encode()


def test_pieces_of_the_vocabulary(reference, codec):
    rng = random.Random(8)
    for raw in rng.sample(sorted(RANKS), 3000):
        text = raw.decode(errors="ignore")
        assert codec.encode(text) == packed(reference.encode_ordinary(text))


def test_memory_is_bounded(reference, codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    text = "one two three four five six one two"
    assert codec.encode(text) == packed(reference.encode_ordinary(text))
    assert codec.encode("seven") == packed(reference.encode_ordinary("seven"))


def test_rows(spark, reference):
    long = "word and more, " * 20_000
    texts = [(1, None), (2, ""), (3, "Hello world"), (3, "Hello world"), (None, "x"), (4, long)]
    docs = spark.createDataFrame([(i, t, "a", 0) for i, t in texts], "doc_id long, text string, token_ids string, n long")
    got = sorted((tuple(r) for r in byte_bpe.digests(docs, VOCABULARY, PATTERN).collect()), key=repr)
    want = []
    for doc_id, text in texts:
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        want.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), digest))
    assert got == sorted(want, key=repr)
    assert byte_bpe.digests(docs.limit(0), VOCABULARY, PATTERN).count() == 0
    assert byte_bpe.encoded(docs, VOCABULARY, PATTERN).columns == ["doc_id", "text", "token_ids", "n"]
