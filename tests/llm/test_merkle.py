"""The manifest against plain Python that builds the trees node by node."""

import hashlib
import zlib

import pytest
from harness import duck_rows, spark_rows

from tidewheel.llm import merkle, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, at long, n int, digest string, path string"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(*row):
    return h(*["-" if value is None else f"{len(str(value).encode())}:{value}" for value in row])


def tree(nodes):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            first, slot = at[i] // 8 * 8, at[i] % 8
            run = nodes[first : first + 8]
            path.append((slot, run[:slot] + run[slot + 1 :]))
            at[i] //= 8
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    ordered = [sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for lang in langs]
    grown = [tree([leaf(*row) for row in group]) for group in ordered]
    root, tops = tree([subroot for subroot, _ in grown]) if grown else (None, [])
    found = []
    for group, (subroot, paths), top in zip(ordered, grown, tops, strict=True):
        for row, path in zip(group, paths, strict=True):
            end = own = leaf(*row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                end = leaf(*row[:4], None if row[4] is None else row[4].translate(LOWER))
            for slot, others in path + top:
                end = h(*others[:slot], end, *others[slot:])
            siblings = h(*[digest for _, others in path + top for digest in others])
            found.append((row[0], own, subroot, root, siblings, end, end == root))
    return sorted(found, key=repr)


def checked(spark, rows):
    extra = [(*row, 5, 6, 7, "d", "p") for row in rows]
    df = spark.createDataFrame(extra, SCHEMA).repartition(3)
    return sorted(map(tuple, merkle.checked(df).collect()), key=repr)


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 200])
def test_same_as_plain_python(spark, size):
    rows = [(i * 7 % size, f"s{i % 3}", "en", i, f"Text Ä {i}") for i in range(size)]
    assert checked(spark, rows) == brute(rows)


def test_groups_of_many_sizes(spark):
    rows = [(i, None, lang, None, f"A{i}") for i in range(75) for lang in ["a", "é", "z", "", None][: 1 + i % 5]]
    rows += [(1000 + k, "s", f"l{k}", 1, "One") for k in range(12)]
    assert checked(spark, rows) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None, None, None)] * 5 + [(3, "a", "en", 0, "")] * 9 + [(3, "a", "en", 1, "B"), (None, "x", "en", 2, "C" * 300_000)]
    assert checked(spark, rows) == brute(rows)


def test_nothing(spark):
    assert checked(spark, []) == []


def test_a_change_of_any_field_shows(spark):
    rows = [(i, "s", "en", 1, "t") for i in range(20)]
    before = {row[0]: row for row in checked(spark, rows)}
    for place, value in ((1, None), (3, 2), (4, "T")):
        changed = list(rows)
        changed[4] = tuple(value if k == place else old for k, old in enumerate(rows[4]))
        assert checked(spark, changed)[0][3] != before[0][3]


def test_same_rows_as_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert spark_rows(queries.op12_merkle_manifest(spark, folder)) == duck_rows(folder, merkle.SQL)
