import random
from functools import lru_cache

import pytest

from tidewheel.llm import line_dedup as ld


@lru_cache(maxsize=None)
def edits(a, b):
    """Whether a and b are within one edit."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else a[same:] == b[same + 1 :]


def brute(rows):
    cut = []
    for row, (doc_id, text) in enumerate(rows):
        for place, line in enumerate(text.split("\n") if text is not None else []):
            cut.append((row, (-1 << 70 if doc_id is None else doc_id, place), line))
    gone = set()
    for n, (_, order, line) in enumerate(cut):
        if len(line) >= ld.LEAST_CHARS and any(
            other < order and len(each) >= ld.LEAST_CHARS and edits(each, line) for _, other, each in cut
        ):
            gone.add(n)
    out = []
    for row, (doc_id, text) in enumerate(rows):
        own = [n for n, c in enumerate(cut) if c[0] == row]
        left = "\n".join(cut[n][2] for n in own if n not in gone)
        out.append((doc_id, None if text is None else left, len(own), sum(n in gone for n in own)))
    return sorted(out, key=repr)


def run(docs):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in ld.deduplicated(docs).collect()), key=repr)


def edited(rng, line, times):
    for _ in range(times):
        at = rng.randrange(len(line))
        new = rng.choice("abcé ")
        line = rng.choice([line[:at] + line[at + 1 :], line[:at] + new + line[at:], line[:at] + new + line[at + 1 :]])
    return line


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_all_pairs(make_docs, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.choice([19, 20, 21, 33, 48, 120]))) for _ in range(40)]
    rows = []
    for n in range(60):
        lines = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randint(0, 6))]
        lines += rng.choice([[], ["short"], [""], ["  "]])
        rng.shuffle(lines)
        rows.append((rng.choice([n, n, 500]), "\n".join(lines)))
    rows += [(900, None), (901, ""), (None, base[0] + "\n" + base[1]), (None, base[1]), rows[4], rows[4]]
    assert run(make_docs(rows)) == brute(rows)


def test_every_kind_of_edit_at_every_place(make_docs):
    line = "abcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(0, line)]
    for n in range(len(line)):
        rows += [(len(rows), line[:n] + line[n + 1 :]), (len(rows) + 1, line[:n] + "#" + line[n:]), (len(rows) + 2, line[:n] + "#" + line[n + 1 :])]
    rows += [(len(rows), line + "#"), (len(rows) + 1, "##" + line[1:-1]), (len(rows) + 2, line[2:]), (len(rows) + 3, line[::-1])]
    got = {doc_id: removed for doc_id, _, _, removed in run(make_docs(rows))}
    assert got == {doc_id: removed for doc_id, _, _, removed in brute(rows)}
    # One edit from the first line goes, two edits stay unless they are one from another.
    assert sum(got.values()) >= 3 * len(line) + 1


@pytest.mark.parametrize("size", [17, 255, 256, 257, 1024, 1025, 3000, 5000])
def test_long_lines_go_as_a_whole(make_docs, size):
    rng = random.Random(size)
    line = "".join(rng.choice("abcdefé ") for _ in range(size))
    rows = [(0, line + "#" * 3)]
    line = rows[0][1]
    places = sorted({0, 1, size // 3, size // 2, size // 2 + 1, size - 1, size, *(rng.randrange(size) for _ in range(4))})
    for at in places:
        rows += [(len(rows), "head\n" + line[:at] + line[at + 1 :]), (len(rows) + 1, line[:at] + "+" + line[at:]), (len(rows) + 2, line[:at] + "+" + line[at + 1 :])]
    # Two edits, far apart and not one from any other line.
    rows += [(len(rows), "==" + line[2:-2] + "=="), (len(rows) + 1, line), (len(rows) + 2, line[: size // 2])]
    got = run(make_docs(rows))
    assert got == brute(rows)
    removed = {doc_id: n for doc_id, _, _, n in got}
    expected = 1 if size >= ld.LEAST_CHARS else None
    if expected:
        assert all(removed[doc_id] == 1 for doc_id in range(1, len(rows) - 3))
    assert removed[0] == 0


def test_a_very_long_line_with_one_edit(make_docs):
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefgh ") for _ in range(100_000))
    edits_at = [0, 1, 777, 50_000, 99_998, 99_999]
    rows = [(0, line)] + [(n + 1, line[:at] + line[at + 1 :]) for n, at in enumerate(edits_at)]
    rows += [(20 + n, line[:at] + "+" + line[at:]) for n, at in enumerate(edits_at)] + [(40, line), (41, "+" + line[:-1]), (42, line[:500] + "++" + line[502:])]
    got = {doc_id: (text, removed) for doc_id, text, _, removed in run(make_docs(rows))}
    assert {doc_id for doc_id, (_, removed) in got.items() if not removed} == {0, 42}
    assert all(text == "" for text, removed in got.values() if removed)


def test_a_line_of_most_rows(make_docs):
    common = "the same line that stands in every document"
    rows = [(n, f"own line number {n * 7919} of this document\n{common}") for n in range(120)]
    got = run(make_docs(rows))
    assert got == brute(rows)
    assert sum(removed for *_, removed in got) >= 119


def test_a_template_with_many_fillings(make_docs):
    rows = [(n, f"page number {n % 10}{n // 10 % 10} of the whole volume") for n in range(100)]
    assert run(make_docs(rows)) == brute(rows)


def test_nothing(make_docs):
    assert run(make_docs([(1, "x")]).limit(0)) == []
    assert run(make_docs([(1, None), (2, "")])) == [(1, None, 0, 0), (2, "", 1, 0)]


def test_columns_stay_as_they_are(make_docs):
    docs = make_docs([(1, "x")])
    assert ld.deduplicated(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    again = ld.deduplicated(ld.deduplicated(docs))
    assert again.columns == [*docs.columns, "n_lines", "n_removed"]
