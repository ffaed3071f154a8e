import random

import pytest

from tidewheel.llm import jaccard, links


def brute(rows, width=3, percent=90):
    sets = []
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        runs = {tuple(words[n : n + width]) for n in range(max(1, len(words) - width + 1))} if words else set()
        sets.append((doc_id, runs))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for n, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(n)] = min(least.get(find(n), doc_id), doc_id)
    return sorted(
        ((doc_id, len(runs), least.get(find(n)) if runs else doc_id) for n, (doc_id, runs) in enumerate(sets)), key=repr
    )


def found(docs):
    return sorted((tuple(r) for r in jaccard.joined(docs).collect()), key=repr)


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(60)] + ["Été", "A", "a"]
    rows = []
    for group in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 60, 200]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 1000, "  \x0b".join(copy)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "W1 w2"), (2004, "w1 W2"), (None, rows[0][1]), (None, "solo text")]
    return [*rows, rows[3], rows[3]]


@pytest.mark.parametrize("seed", [5, 6])
def test_components_are_those_of_all_pairs(make_docs, seed):
    rows = corpus(seed)
    assert found(make_docs(rows)) == brute(rows)


def test_a_large_group_of_near_copies(make_docs):
    rng = random.Random(1)
    base = [f"b{n}" for n in range(120)]
    rows = []
    for n in range(60):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        rows.append((n, " ".join(copy)))
    assert found(make_docs(rows)) == brute(rows)


def test_blocks_of_large_buckets_find_all(make_docs, monkeypatch):
    monkeypatch.setattr(links, "FEW_MEMBERS", 1)
    monkeypatch.setattr(links, "BLOCK", 2)
    rows = corpus(8)
    assert found(make_docs(rows)) == brute(rows)


def test_very_long_texts(make_docs):
    rng = random.Random(4)
    long = [f"l{rng.randrange(40_000)}" for _ in range(60_000)]
    few, many = list(long), list(long)
    for k in range(0, 60_000, 100):
        few[k] = "x"
    for k in range(0, 60_000, 8):
        many[k] = f"y{k}"
    rows = [(1, " ".join(long)), (2, " ".join(few)), (3, " ".join(many)), (4, " ".join(long[:30_000])), (5, "w " * 200_000)]
    assert found(make_docs(rows)) == brute(rows)


def test_nothing_to_join(make_docs):
    assert found(make_docs([(1, "a b c")]).limit(0)) == []
    assert found(make_docs([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_components_of_chains_and_stars(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 130)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: 0 for n in range(41)} | {n: 100 for n in range(100, 130)} | {200: 200, 201: 200}
    assert got == want
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_that_share_a_doc_id_are_looked_at_once(spark, make_docs, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    sketches = jaccard._sketches

    def counted(width):
        run = sketches(width)

        def counting(batches):
            def each():
                for batch in batches:
                    read.add(batch.num_rows)
                    yield batch

            yield from run(each())

        return counting

    monkeypatch.setattr(jaccard, "_sketches", counted)
    base = [f"b{n}" for n in range(120)]
    rows = [(None, " ".join([*base, f"x{n}"])) for n in range(20)]
    assert found(make_docs(rows)) == brute(rows)
    assert 0 < read.value <= 2 * len(rows)
