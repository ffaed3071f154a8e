import numpy as np
import pytest

from tidewheel.llm import multi_index


def brute(rows, k=10):
    out = {}
    for query, vector in rows:
        if query % 100:
            continue
        away = sorted({(float(np.sqrt(((np.float64(v) - np.float64(vector)) ** 2).sum())), i) for i, v in rows if i != query})
        out[query] = [(rank, i, score) for rank, (score, i) in enumerate(away[:k], 1)]
    return out


def search(spark, rows, extra=()):
    vectors = spark.createDataFrame([(i, list(map(float, v)), 1) for i, v in rows] + list(extra), "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in multi_index.nearest(vectors, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return got


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    rows = [(n, rng.normal(size=24).round(3)) for n in range(1500)]
    want, got = brute(rows), search(spark, rows)
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    of = dict(rows)
    for query, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        for _, i, score in found:
            assert score == pytest.approx(float(np.linalg.norm(of[i] - of[query])), abs=1e-12)


def test_equal_vectors_and_ties_by_id(spark):
    rng = np.random.default_rng(3)
    same = rng.normal(size=8).round(2)
    rows = [(n, same) for n in range(0, 400, 2)] + [(n, rng.normal(size=8).round(2)) for n in range(1, 100, 2)]
    want, got = brute(rows), search(spark, rows)
    assert set(got) == {0, 100, 200, 300}
    for query in got:
        assert [i for _, i, _ in got[query]] == [i for _, i, _ in want[query]]


def test_few_rows_and_odd_vectors(spark):
    odd = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [float("nan"), 1.0], 1), (4, [None, 1.0], 1), (None, [1.0, 1.0], 1)]
    odd += [(5, [float("inf"), 1.0], 1), (6, [1.0, 2.0, 3.0], 1), (7, [], 1)]
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (101, [1.0, 1.0])]
    got = search(spark, rows, [*odd, (101, [1.0, 1.0], 2)])
    assert {q: [i for _, i, _ in found] for q, found in got.items()} == {0: [101, 100], 100: [101, 0]}
    assert search(spark, []) == {}
    assert search(spark, [(0, [1.0, 2.0])]) == {}


def test_small_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(n, rng.normal(size=16)) for n in range(600)]
    before = search(spark, rows)
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 50)
    monkeypatch.setattr(multi_index, "BLOCK_QUERIES", 2)
    assert search(spark, rows) == before
