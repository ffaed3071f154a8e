import random

import pytest

from tidewheel.llm import substring_dedup as sd


def prose(rng, words):
    out = []
    while len(out) < words:
        size = rng.randint(9, 16)
        out += [f"q{rng.randrange(10_000)}" for _ in range(size - 1)] + [f"q{rng.randrange(10_000)}."]
    return " ".join(out)


def passages(docs):
    return {(r.doc_id, r.first_doc_id): r for r in sd.repeated(docs).collect()}


def test_bands_find_what_they_should():
    assert 1 - (1 - (sd.SIMILAR / 100) ** sd.ROWS) ** sd.BANDS >= sd.RECALL


@pytest.fixture(scope="module")
def planted():
    """Documents of their own text; every third pair shares a passage in the middle of a line."""
    rng = random.Random(11)
    rows, shared = [], set()
    for n in range(0, 60, 2):
        passage = prose(rng, 55)
        for k in (0, 1):
            own = prose(rng, 120).split(" ")
            at = rng.randrange(len(own))
            middle = [passage] if n % 6 == 0 else []
            rows.append((n + k, " ".join(own[:at] + middle + own[at:])))
            if n % 6 == 0:
                shared.add(n + k)
    return rows, shared


def test_planted_passages_are_found_and_others_left_alone(make_docs, planted):
    rows, shared = planted
    got = sd.repeated(make_docs(rows)).collect()
    assert {r.doc_id for r in got} == shared
    for r in got:
        assert r.first_doc_id == r.doc_id // 2 * 2
        assert 20 <= r.n_words <= 75
        assert (r.n_removed == 0) == (r.doc_id % 2 == 0)


def test_near_copies_line_breaks_and_case(make_docs):
    rng = random.Random(4)
    words = prose(rng, 200).split(" ")
    changed = list(words)
    changed[100] = "other"
    rows = [(1, " ".join(words)), (2, "\n".join(words[:40]) + " " + " ".join(words[40:]).upper()), (3, " ".join(changed))]
    got = {}
    for r in sd.repeated(make_docs(rows)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_words
    assert got[1] >= 190 and got[2] >= 140 and got[3] >= 170


def test_odd_rows(make_docs):
    rng = random.Random(5)
    text = prose(rng, 60)
    rows = [(1, None), (2, ""), (3, " \n"), (None, text), (7, text), (7, text), (8, "short. lines. only. here."), (9, "w " * 50_000)]
    got = sd.repeated(make_docs(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_removed > 0) for r in got) == [(False, 7, True), (True, None, False)]
    # One document given twice repeats nothing.
    assert sd.repeated(make_docs([(7, text), (7, text)])).count() == 0
    assert sd.repeated(make_docs([(7, text)]).limit(0)).count() == 0


def test_common_short_lines_are_left_alone(make_docs):
    rng = random.Random(6)
    notice = "all rights are reserved by the owners of this small page."
    rows = [(n, prose(rng, 80) + "\n" + notice + "\n" + prose(rng, 80)) for n in range(30)]
    assert sd.repeated(make_docs(rows)).count() == 0


def test_links_are_those_of_all_pairs(spark, make_docs):
    rng = random.Random(7)
    base = [prose(rng, 14).split(" ") for _ in range(12)]
    rows = []
    for n in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2])):
            words[rng.choice([0, 1, len(words) - 2])] = f"n{rng.randrange(50)}"
        rows.append((n, " ".join(w.replace(".", "") for w in words)))
    from pyspark.sql import functions as F

    docs = make_docs(rows).select("doc_id", F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("text"))
    got = {r.doc_id: r.component for r in sd.classes(docs).collect()}
    sets = {n: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for n, t in rows}
    root = {n: n for n in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(j)] = find(i)
    links = [(i, j) for i in sets for j in sets if i < j and find(i) == find(j)]
    # Bands find a link with probability RECALL or more, the rest is exact.
    assert sum(got[i] == got[j] for i, j in links) >= 0.97 * len(links)
    assert not [(i, j) for i in sets for j in sets if i < j and got[i] == got[j] and find(i) != find(j)]


def test_every_shared_run_of_51_words_is_found(make_docs):
    rng = random.Random(12)
    rows, shared = [], {}
    # Without marks, in long sentences, and in sentences too short for paragraphs.
    for n in range(0, 240, 2):
        every = [10**6, 45, 6][n // 2 % 3]
        words = lambda k: [f"u{rng.randrange(10_000)}" + ("." if rng.randrange(every) == 0 else "") for _ in range(k)]
        passage = words(51 + n // 2 % 20)
        for k in (0, 1):
            before = words(rng.randrange(90))
            rows.append((n + k, " ".join(before + passage + words(rng.randrange(90)))))
            shared[n + k] = (len(before), len(before) + len(passage))
    got = {r.doc_id: r for r in sd.repeated(make_docs(rows)).collect()}
    assert set(got) == set(shared)
    for doc_id, (start, end) in shared.items():
        r = got[doc_id]
        # A paragraph at its ends may be similar with a few words of its own.
        assert min(end, r.start_word + r.n_words) - max(start, r.start_word) >= 20
        assert r.first_doc_id == doc_id // 2 * 2 and (r.n_removed == 0) == (doc_id % 2 == 0)
