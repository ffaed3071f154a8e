import hashlib
import math
from collections import Counter, defaultdict

import pytest
from harness import duck_rows, spark_rows

from tidewheel.llm import mixing, queries, sharding

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_extendible_shards", "op3_temperature_mix", "op9_line_neighbours"])
def test_same_rows_as_sql(spark, name):
    names, rows = spark_rows(queries.queries()[name](spark, FOLDER))
    sql_names, sql_rows = duck_rows(FOLDER, queries.oracle_sql()[name])
    assert names == sql_names
    assert rows == sql_rows


def corpus():
    rows = [(n, "w " * (n % 17 + 1), "big") for n in range(200)]
    rows += [(1000 + n, "w " * 9, "small") for n in range(20)]
    rows += [(2000 + n, None if n % 2 else "", None) for n in range(6)]
    return [*rows, (None, "lost words", "small"), (5, "again", "big")]


def place(doc_id, text, number):
    digest = hashlib.md5((text or "").encode()).hexdigest()
    text = ("" if doc_id is None else str(doc_id)) + f":{digest}:{number}"
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute_mix(rows, repeats):
    """Passes of every row, by plain lists."""
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        by_source[source or ""].append((doc_id, len((text or "").split()) + 1, text))
    totals = {s: sum(t for _, t, _ in own) for s, own in by_source.items()}
    largest, smallest = max(totals.values()), min(totals.values())
    # The bisected exponent in closed form.
    a = max(0.0, 1 - math.log(repeats) / math.log(largest / smallest)) if largest > smallest else 0.0
    out = Counter()
    for source, own in by_source.items():
        passes = round((totals[source] / largest) ** (a - 1), 9)
        whole = math.floor(passes)
        rest = math.floor(round((passes - whole) * totals[source], 3))
        for doc_id, _, _ in own:
            for n in range(whole):
                out[doc_id, source, n] += 1
        running = 0
        for doc_id, size, _ in sorted(own, key=lambda r: (place(r[0], r[2], whole), r[1])):
            running += size
            if running > rest:
                break
            out[doc_id, source, whole] += 1
    return out


@pytest.mark.parametrize("repeats", [1.5, 3.0])
def test_passes_are_those_of_plain_lists(make_docs, repeats):
    got = mixing.mixed(make_docs(corpus()), repeats=repeats)
    assert got.columns[:8] == ["doc_id", "text", "lang", "source", "n_chars", "n", "key", "weight"]
    assert Counter((r.doc_id, r.source or "", r.mix_pass) for r in got.collect()) == brute_mix(corpus(), repeats)


@pytest.mark.parametrize("target", [0.9, 0.3, 0.05, 0.6])
def test_entropy_is_met(make_docs, target):
    rows = mixing.mixed(make_docs(corpus()), entropy=target).select("source", "mix_weight").distinct().collect()
    weights = [r.mix_weight for r in rows]
    assert sum(weights) == pytest.approx(1)
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(target, abs=1e-6)


@pytest.mark.parametrize("target", [-0.1, 1.2])
def test_an_entropy_that_cannot_be_is_told(make_docs, target):
    with pytest.raises(ValueError):
        mixing.mixed(make_docs(corpus()), entropy=target)


def test_rows_without_an_id_are_spread_over_blocks(make_docs):
    rows = [(None, f"text {n}", "a") for n in range(300)] + [(n, "b", "b") for n in range(10)]
    got = mixing.mixed(make_docs(rows)).filter("doc_id IS NULL AND mix_pass = 0")
    assert got.select("mix_block").distinct().count() > 200


def test_a_very_long_text_is_passed_whole(make_docs):
    rows = [(1, "w " * 300_000, "a"), *((n, "w " * 9, "a") for n in range(2, 20)), (50, "x", "b"), (51, None, "b")]
    got = mixing.mixed(make_docs(rows), repeats=2.0)
    assert Counter((r.doc_id, r.source or "", r.mix_pass) for r in got.collect()) == brute_mix(rows, 2.0)
    assert {r.n for r in got.filter("doc_id = 1").selectExpr("length(text) AS n").collect()} == {600_000}


def test_a_budget_is_kept(make_docs):
    rows = mixing.mixed(make_docs(corpus()), budget=500).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.source or ""] += len((r.text or "").split()) + 1
    share = {r.source or "": r.mix_weight for r in rows}
    assert all(used[s] <= 500 * share[s] + 1e-3 for s in used)
    assert sum(used.values()) > 500 - 3 * 18


def test_nothing_to_mix(make_docs):
    assert mixing.mixed(make_docs(corpus()).limit(0)).count() == 0


def test_shards_fit_and_split_only_where_needed(make_docs):
    rows = [(n, "x" * (n % 50)) for n in range(500)] + [(7, "x" * 400), (7, "y" * 400), (None, None), (9999, "z" * 5000)]
    got = sharding.sharded(make_docs(rows), limit=1000).collect()
    assert len(got) == len(rows)
    hashes = defaultdict(list)
    for doc_id, text in rows:
        told = ("" if doc_id is None else str(doc_id)) + ":" + (text or "")
        hashes[doc_id, len(text or "")].append(int(hashlib.md5(told.encode()).hexdigest()[:15], 16))
    shards = defaultdict(list)
    for r in got:
        shards[r.depth, r.prefix].append(r)
    for (depth, prefix), own in shards.items():
        assert {r.shard_bytes for r in own} == {sum(r.bytes for r in own)}
        for r in own:
            assert any(h >> (60 - depth) == prefix for h in hashes[r.doc_id, r.bytes])
            # The shard one bit shorter did not fit, or it would have stayed whole.
            if depth:
                above = [size for (_, size), found in hashes.items() for h in found if h >> (61 - depth) == prefix >> 1]
                assert sum(above) > 1000 and len(above) > 1
    assert {r.doc_id for r in got if r.oversized} == {9999}
    assert sharding.sharded(make_docs(rows).limit(0)).count() == 0


def test_equal_rows_share_an_oversized_shard(make_docs):
    got = sharding.sharded(make_docs([(1, "x" * 80), (1, "x" * 80), (2, "z")]), limit=100).collect()
    assert {(r.doc_id, r.oversized, r.shard_rows) for r in got} == {(1, True, 2), (2, False, 1)}


def test_rows_without_or_with_one_id_are_told_apart_by_their_texts(spark, make_docs, tmp_path):
    rows = [(None, f"text {n} " + "x" * 60) for n in range(300)] + [(1, f"{n}" + "y" * 60) for n in range(200)] + [(None, None)] * 3
    got = sharding.sharded(make_docs(rows), limit=2000).collect()
    assert len(got) == len(rows) and not any(r.oversized for r in got)
    assert len({(r.depth, r.prefix) for r in got}) > 15
    sharding.write_shards(make_docs(rows), str(tmp_path / "out"), limit=2000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, rows)) == sorted(repr((r.doc_id, r.text)) for r in back.collect())


def test_a_very_long_text_has_a_shard_of_its_own(make_docs):
    got = sharding.sharded(make_docs([(1, "x" * 3_000_000), (2, "y"), (3, "z")]), limit=1000).collect()
    assert {(r.doc_id, r.bytes, r.oversized) for r in got} == {(1, 3_000_000, True), (2, 1, False), (3, 1, False)}


def test_written_shards(spark, make_docs, tmp_path):
    sharding.write_shards(make_docs([(n, "x" * 50) for n in range(60)]), str(tmp_path / "out"), limit=1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60
    assert back.groupBy("shard").count().filter("count * 50 > 1000").count() == 0
