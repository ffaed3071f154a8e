"""Lines that repeat an earlier line, up to one edit, taken out of documents.

A line is removed if an earlier one is equal to it or within one insertion, deletion or
substitution of a character. Earlier means smaller doc_id (null first), then the place in the text;
in rows that share a doc_id, lines at the same place are equally early and none goes for the other.
Whether the earlier line is removed itself makes no difference.

Lines are split at line feeds, compared as they are and whole, whatever their length, and go or stay as
a whole. Lines of fewer than LEAST_CHARS characters are kept and never compared. A document that
loses all lines has an empty text. Null texts stay null. All other columns are kept; n_lines and
n_removed are replaced, and names that begin with an underscore are reserved. An empty table gives
an empty one.

Deletion neighbourhoods: two lines within one edit become equal when one character of the longer
(or of both, at the same place) is deleted. To emit variants only where they can meet, whole parts
are deleted first: halves of all lines, then, of those lines that agree with another one in the
rest, each of FAN parts, then each of FAN parts of a part that agreed, until a part has WINDOW characters
or fewer, then its single characters. At each step equal hashes are joined. In the last, each variant
keeps its earliest line, whose window is compared by edit distance. No step forms pairs, so a line
that many lines resemble costs no more than its own rows, and a long line takes FAN times its length
per step, and a step more for FAN times the length. What lies outside a window is compared by two
64-bit hashes. Places of a line that very many rows have are found in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.sized import broadcast_if_few
from tidewheel.operators.skew import heavy_by_count, salted_join
from tidewheel.session import discard, written

# Parameters. A document has fewer than 1 << 32 lines.
LEAST_CHARS = 20
WINDOW = 16
FAN = 16


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def _text_hash() -> Column:
    return F.xxhash64("text")


def _order(doc_id: Column, place: Column) -> Column:
    """One number that grows with doc_id and place; rows without an id come first."""
    number = F.coalesce(doc_id.cast("decimal(20)"), F.lit("-9223372036854775809").cast("decimal(20)"))
    return (number * F.lit(1 << 32).cast("decimal(11)") + place).cast("decimal(38)")


def _whole(docs: DataFrame) -> DataFrame:
    """One row per line that takes part, with its text, length and two hashes."""
    rows = docs.select("doc_id", _text_hash().alias("version"), F.posexplode(split_lines(F.col("text"))).alias("place", "line"))
    rows = rows.withColumn("n", F.length("line")).filter(F.col("n") >= LEAST_CHARS)
    return rows.withColumns({"h": F.xxhash64("line"), "c": F.crc32(F.col("line").cast("binary"))})


def _halves() -> Column:
    """Hashes of the line without one half, as the longer and as the shorter of two lines."""
    keys = []
    for length in (F.col("n"), F.col("n") + 1):
        half = F.ceil(length / 2).cast("int")
        rest = (F.substring("line", F.lit(1), half), F.substring("line", half - (length - F.col("n")) + 1, length - half))
        keys += [F.xxhash64(F.lit(which), length, part) for which, part in enumerate(rest)]
    return F.array(*keys)


def _lines(docs: DataFrame) -> DataFrame:
    """Where each line stands and its identity, without its text."""
    return _whole(docs).select("doc_id", "version", "place", "h", "c", _halves().alias("halves"))


def _outside() -> Column:
    """Hashes of what a line has outside the window that spans start to end in the longer line.

    ``length`` is that of the longer line. What stands before the window is aligned to the start,
    what stands after it to the end.
    """
    length, start, end = F.col("length"), F.col("start"), F.col("end")
    before = F.substring("line", F.lit(1), start)
    after = F.substring("line", F.col("n") - (length - end) + 1, length - end)
    return F.struct(F.xxhash64(before).alias("before"), F.xxhash64(after).alias("after"))


def _narrowed(rows: DataFrame) -> DataFrame:
    """``rows`` for each part of their window, with ``key``: the part and what lies outside it."""
    step = F.greatest(F.lit(WINDOW), F.ceil((F.col("end") - F.col("start")) / FAN).cast("int"))
    parts = rows.withColumn("_step", step).withColumn("_start", F.explode(F.sequence(F.col("start"), F.col("end") - 1, F.col("_step"))))
    parts = parts.withColumns({"start": F.col("_start"), "end": F.least(F.col("_start") + F.col("_step"), F.col("end"))})
    return parts.drop("_start", "_step").withColumn("key", F.struct("length", "start", "end", _outside().alias("rest")))


def _met(keys: DataFrame) -> DataFrame:
    """Keys that at least two different lines have."""
    some = keys.groupBy("key").agg(F.min("h").alias("least"), F.max("h").alias("most"))
    return some.filter("least <> most").select("key")


def _close(lines: DataFrame) -> DataFrame:
    """The narrowest windows outside which a line agrees with another one, stored.

    ``lines`` has each line once; a line takes part as the longer and as the shorter of two.
    """
    length = F.explode(F.array(F.col("n"), F.col("n") + 1)).alias("length")
    now = lines.select("*", length, F.lit(0).alias("start")).withColumn("end", F.col("length"))
    widest, stored = WINDOW + 1, []
    while widest > WINDOW:
        windows = written(_narrowed(now), "windows")
        now = written(windows.join(_met(windows), "key"), "close")
        widest = now.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 0
        discard(windows, *stored)
        stored = [now]
        if widest > WINDOW:
            now = now.drop("key")
    return stored[0]


def near_repeats(docs: DataFrame, lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Identities (h, c) of lines that an earlier, different line comes within one edit of."""
    halves = lines.select("h", F.explode("halves").alias("key"))
    met = written(_met(halves), "met")
    alike = written(halves.join(broadcast_if_few(met), "key").select("h").distinct(), "alike")
    discard(met)
    # Only these lines are looked at again, once each.
    again = _whole(docs).join(broadcast_if_few(alike), "h").groupBy("h", "c", "n").agg(F.min("line").alias("line"))
    again = again.join(firsts.select("h", "c", "first"), ["h", "c"]).withColumn("id", F.struct("h", "c"))
    windows = _close(again)
    inner = F.substring("line", F.col("start") + 1, F.col("end") - F.col("start") - (F.col("length") - F.col("n")))
    close = windows.select("id", "first", "key", (F.col("n") == F.col("length")).alias("longer"), inner.alias("inner"))
    # The shorter line stays whole (place 0); the longer one loses each of its characters in turn.
    places = F.when(F.col("longer"), F.sequence(F.lit(1), F.length("inner"))).otherwise(F.array(F.lit(0)))
    deleted = close.withColumn("place", F.explode(places)).withColumn(
        "variant",
        F.when(F.col("place") == 0, F.col("inner")).otherwise(
            F.concat(F.substring("inner", F.lit(1), F.col("place") - 1), F.substring("inner", F.col("place") + 1, F.lit(WINDOW)))
        ),
    )
    deleted = written(deleted, "variants")
    earliest = deleted.groupBy("key", "variant", "place").agg(F.min(F.struct("first", "inner", "id")).alias("earliest"))
    earliest = written(earliest, "earliest")
    # Both longer: equal when they lose the character at the same place.
    same = deleted.filter("longer").join(earliest, ["key", "variant", "place"])
    # One longer: it becomes the shorter one.
    whole = earliest.filter("place = 0").select("key", "variant", "earliest")
    shrunk = deleted.filter("longer").join(whole, ["key", "variant"])
    gone = earliest.filter("place > 0").groupBy("key", "variant").agg(F.min("earliest").alias("earliest"))
    grown = deleted.filter("NOT longer").join(gone, ["key", "variant"])
    columns = ["id", "first", "inner", "earliest"]
    found = same.select(columns).unionByName(shrunk.select(columns)).unionByName(grown.select(columns))
    found = found.filter("earliest.id <> id AND earliest.first < first")
    found = found.filter(F.levenshtein("inner", "earliest.inner", 1) >= 0).select("id.*").distinct()
    found = written(found, "near")
    discard(alike, windows, deleted, earliest)
    return found


def repeats(docs: DataFrame) -> DataFrame:
    """Places of removed lines of each document: doc_id, version (hash of the text), gone; stored."""
    lines = written(_lines(docs), "lines")
    at = _order(F.col("doc_id"), F.col("place"))
    firsts = written(lines.groupBy("h", "c").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("copies")), "firsts")
    near = near_repeats(docs, lines, firsts)
    told = firsts.join(broadcast_if_few(near.withColumn("near", F.lit(True))), ["h", "c"], "left")
    told = told.filter("near OR copies > 1").withColumn("id", F.struct("h", "c"))
    total = firsts.agg(F.sum("copies")).first()[0] or 0
    heavy = heavy_by_count(told, "id", "copies", total)
    rows = lines.select("doc_id", "version", "place", F.struct("h", "c").alias("id"))
    met = salted_join(rows, told.select("id", "first", "near"), "id", heavy)
    gone = met.filter(F.col("near") | (at != F.col("first"))).select("doc_id", "version", "place").distinct()
    gone = written(gone.groupBy("doc_id", "version").agg(F.collect_list("place").alias("gone")), "gone")
    discard(lines, firsts, near, heavy)
    return gone


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the text without repeated lines, ``n_lines`` and ``n_removed``."""
    gone = repeats(docs.select("doc_id", "text")).select(
        F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("gone").alias("_gone")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (_text_hash() == F.col("_version"))
    rows = docs.join(gone, same, "left").withColumn("_lines", split_lines(F.col("text")))
    last = F.size("_lines") - 1
    kept = F.array_except(F.sequence(F.lit(0), last), F.coalesce("_gone", F.array().cast("array<int>")))
    left = F.array_join(F.transform(kept, lambda place: F.col("_lines")[place]), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)
    # Through a generator, so that a later filter on the text does not build it once more per line.
    rows = rows.withColumn("_text", F.explode(F.array(text)))
    return rows.select(
        *(F.col("_text").alias("text") if name == "text" else F.col(name) for name in docs.columns if name not in ("n_lines", "n_removed")),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


#: Lines, and those that go, for a table ``documents`` with distinct ids; ends in the remaining texts.
SQL_PARTS = f"""
split AS MATERIALIZED (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS body
    FROM documents WHERE text IS NOT NULL),
firsts AS MATERIALIZED (
    SELECT body, length(body) AS n, min((doc_id, line)) AS first FROM split
    WHERE length(body) >= {LEAST_CHARS} GROUP BY body),
keys AS MATERIALIZED (
    SELECT body, first, n + d AS l, half,
           CASE half WHEN 0 THEN right(body, ((n + d) // 2)::BIGINT) ELSE left(body, (n + d - (n + d) // 2)::BIGINT) END AS part
    FROM firsts, unnest([0, 1]) AS e(d), unnest([0, 1]) AS h(half)),
near AS MATERIALIZED (
    SELECT DISTINCT a.body FROM keys a JOIN keys b USING (l, half, part)
    WHERE b.first < a.first AND abs(length(a.body) - length(b.body)) <= 1 AND levenshtein(a.body, b.body) <= 1),
judged AS MATERIALIZED (
    SELECT doc_id, line, body,
           f.body IS NOT NULL AND (near.body IS NOT NULL OR (doc_id, line) <> f.first) AS gone
    FROM split LEFT JOIN firsts f USING (body) LEFT JOIN near USING (body)),
cleaned AS MATERIALIZED (
    SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY line) FILTER (NOT gone), '') AS text,
           count(*) AS n_lines, count_if(gone)::BIGINT AS n_removed
    FROM judged GROUP BY doc_id)
"""

SQL = f"""
WITH {SQL_PARTS}
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, md5(c.text) AS text_md5
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""
