"""Phrase mining against plain Python, with all phrases numbered and with almost none."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from harness import duck_rows, spark_rows

from tidewheel.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, n long, f long, phrase string, code long, size int"


def brute(rows, first, least):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + size])) for size in (1, 2, 3, 4) for i in range(len(words) - size + 1))
    known = {key: n for key, n in counts.items() if n >= least}
    found = []
    for (lang, words), a in known.items():
        if len(words) == 1:
            continue
        longer = [n for (other, w), n in known.items() if other == lang and len(w) > len(words) and words in [w[i : i + len(words)] for i in range(len(w))]]
        if any(100 * n >= 80 * a for n in longer):
            continue
        cuts = [(2_000_000 * a // (known[lang, words[:k]] + known[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.append((lang, score, a, " ".join(words), known[lang, words[:k]], known[lang, words[k:]]))
    found.sort(key=lambda row: (row[0], -row[1], -row[2], row[3].encode()))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in found:
        rank[lang] += 1
        if rank[lang] <= first:
            out.append((lang, rank[lang], phrase, a, left, right, totals[lang], score))
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, t, lang, 1, 2, "x", 3, 4) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    got = phrases.mined(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(map(tuple, got), key=lambda row: (row[0], row[1]))


def prose(seed, n):
    rng = random.Random(seed)
    words = [f"W{k}" for k in range(12)] + ["é", "ÉÉ", "#", "a\x1cb", " "]
    ends = [" ", " ", " ", "\t", "  ", ", ", ".\n", "\r", "?", "\x0b"]
    for k in range(n):
        text = "".join(rng.choice(words[: 5 + k % 13]) + rng.choice(ends) for _ in range(rng.randrange(60)))
        yield text + "New York City Hall " * rng.randrange(3), ["en", "de", None, "und"][k % 7 % 4]


@pytest.mark.parametrize("words, longer", [(phrases.WORDS, phrases.PHRASES), (5, 4), (8, 0), (0, 0)])
def test_same_as_plain_python(spark, words, longer):
    rows = list(prose(1, 150))
    assert mined(spark, rows, first=40, least=6, words=words, phrases=longer) == brute(rows, 40, 6)


def test_odd_rows(spark):
    rows = [(None, "en"), ("", None), (" \t ", "en"), (".,;", "en"), ("one", "en")] + [("A b\na B, a b c", None)] * 9
    rows += [("x " * 30_000 + "y z", "long")] * 2 + [("y z", "long")] * 5
    assert mined(spark, rows, first=10, least=5) == brute(rows, 10, 5)
    assert mined(spark, [], least=1) == []
    assert mined(spark, [("a b", "en")], least=2) == []


def test_first_phrases_by_ties(spark):
    rows = [(f"{a} {b}", "en") for a in "qrst" for b in "uvwx" for _ in range(3)]
    got = mined(spark, rows, first=7, least=3)
    assert got == brute(rows, 7, 3)
    assert [row[2] for row in got] == ["q u", "q v", "q w", "q x", "r u", "r v", "r w"]


def test_tiles_count_like_a_table():
    rng = np.random.default_rng(3)
    tiles, want = phrases.Tiles(), Counter()
    for size in (200_000, 50, 0, 200_000):
        left = np.concatenate([rng.integers(0, 300, size), rng.integers(0, 1 << 28, size // 4)])
        right = np.concatenate([rng.integers(0, 300, size), rng.integers(0, 1 << 18, size // 4)])
        tiles.add(left, right)
        want.update(zip(left.tolist(), right.tolist(), strict=True))
    assert tiles.arrays
    (rows,) = tiles.rows()
    got = dict(zip(rows.column("code").to_pylist(), rows.column("n").to_pylist(), strict=True))
    assert got == {a << 32 | b: n for (a, b), n in want.items()}
    assert list(tiles.rows()) == []


def test_exact_beyond_64_bits(spark):
    huge = 9 * 10**17
    rows = [("en", "a", 1, huge), ("en", "b", 1, huge + 1), ("en", "a b", 2, huge - 1)]
    known = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    got = phrases.scored(known.filter("size = 2"), known).collect()
    assert got[0]["score"] == 2_000_000 * (huge - 1) // (2 * huge + 1)


def test_same_rows_as_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert spark_rows(queries.op11_pair_tiles(spark, folder)) == duck_rows(folder, queries.oracle_sql()["op11_pair_tiles"])
