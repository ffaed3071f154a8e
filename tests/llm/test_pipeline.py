import hashlib
import random
import struct
from collections import Counter

import public_tokenizers
import pytest
import test_jaccard
import test_line_dedup
import test_mixing_and_sharding
import test_quality
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tidewheel.llm import byte_bpe, mixing
from tidewheel.llm.queries import VOCABULARY


def corpus():
    rng = random.Random(21)
    vocabulary = [f"v{n}" for n in range(400)]

    def prose(words):
        own = [rng.choice(vocabulary) for _ in range(words)]
        return "\n".join(" ".join(own[n : n + 15]) for n in range(0, words, 15))

    rows = [(n, prose(rng.randint(30, 90)), rng.choice(["a", "a", "a", "b", None])) for n in range(60)]
    for n in range(60, 75):
        doc_id, text, source = rng.choice(rows[:60])
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((n, rng.choice([text, " ".join(words), text.replace("\n", " "), text + "\n" + prose(15)]), source))
    rows += [(80 + n, " ".join(f"z{n}### | y{k}$$$" for k in range(30)), "b") for n in range(10)]
    return [*rows, (200, None, "a"), (201, "", "a"), (None, prose(40), "b"), (202, "too short", "a"), rows[3], rows[3]]


def passes_base(text):
    words, found = test_quality.measures(text)
    return len(words) >= 20 and 100 * found[4] <= 30 * len(words)


def brute(rows, trusted):
    verdicts = test_quality.brute([(i, t) for i, t, _ in rows], trusted)
    kept = Counter()
    for row in verdicts:
        kept[row[0]] += row[-1]
    rows = [r for r in rows if kept[r[0]]]
    source = {i: s for i, _, s in rows}
    left = test_line_dedup.brute([(i, t) for i, t, _ in rows])
    rows = [(i, t) for i, t, _, removed in left if not removed or passes_base(t)]
    groups = Counter((i, c) for i, _, c in test_jaccard.brute(rows))
    stays = {i for i, c in groups if i == c or (i is None and c is None)}
    rows = list(dict.fromkeys(r for r in rows if r[0] in stays))
    passes = test_mixing_and_sharding.brute_mix([(i, t, source[i]) for i, t in rows], mixing.REPEATS)
    tokenizer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(VOCABULARY), special_tokens={})
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode_ordinary(text)
        digests = (hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        times = sum(n for (i, s, _), n in passes.items() if i == doc_id and s == (source[doc_id] or ""))
        out += [(doc_id, len(ids), *digests)] * times
    return sorted(out, key=repr)


@pytest.fixture
def folder(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("kept", F.lit("other")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(n, 1, 0) for n in range(40)] + [(41, 0, 0), (42, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_rows_are_those_of_plain_python(spark, folder):
    got = sorted((tuple(r) for r in corpus_pipeline.run(spark, folder).collect()), key=repr)
    want = brute(corpus(), set(range(40)))
    assert got == want
    assert len(got) > 60


def test_stages(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "byte-level BPE"
    ]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0
        assert number == 4 or empty.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = entry_point.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))
    assert set(entry_point.oracle_sql()) <= set(names)


def test_no_fragments_of_copies_are_left(spark, make_docs):
    rng = random.Random(8)
    page = "\n".join(" ".join(f"v{rng.randrange(5000)}" for _ in range(12)) for _ in range(6))
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(60_000))
    rows = [(1, page), (2, page + "\na few words of its own"), (3, page.replace("v1", "u1", 1)), (4, long), (5, page + "\n" + long[:400]), (6, None)]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, make_docs(rows), "").collect()}
    assert set(got) == {1, 4, 5, 6}
    assert got[1] == page and got[4] == long and got[5] == long[:400]


def test_near_copies_go_row_by_row(spark, make_docs):
    rng = random.Random(3)

    def prose():
        return " ".join(f"v{rng.randrange(5000)}" for _ in range(80))

    first, other, alone = prose(), prose(), prose()
    near = first + " more"
    # Without an id: a near copy of 1, a text of its own, a repeated text that no id has. Id 5: a near copy and a text of its own.
    rows = [(1, first), (None, near), (None, alone), (None, other), (None, other), (5, near), (5, prose()), (6, None)]
    got = corpus_pipeline.near_copies(spark, make_docs(rows), "")
    left = [r for r in rows if r[1] != near]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(left, key=repr)
