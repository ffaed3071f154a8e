"""Phrases of two to four words that occur together far more often than apart.

Texts, with A-Z as a-z, are split at ``.,;:!?`` and the characters 0A to 0D into pieces and these at
spaces and tabs into words. Everything is counted per language. Frequent words get numbers by
falling frequency. Pairs of numbers are counted in square tiles: a tile that many occurrences of a
stretch of text fall into is an array of its own, addressed by the two numbers and counted by
``bincount``; occurrences in all other tiles are kept as sorted codes with counts. Frequent pairs
are numbered anew, by their frequency, and a pair with the word after it is a pair of numbers again:
so come phrases of three words, and of four. A phrase can be frequent only if both phrases that
are one word shorter are, so nothing else is counted.

The numbered words and phrases are bounded tables: the most frequent ``WORDS`` and ``PHRASES`` of
all languages. Frequent ones beyond are looked up in a filter of fixed size that misses none; what
holds such a phrase is counted under its text instead of its code, and the sums tell what is frequent.
Tasks send on one row per code and stretch; sums have partial sums before the shuffle. The end is
joins on phrases, with heavy ones cut into parts, and a distributed order.

A phrase counts where its words follow each other within a piece, overlaps included. It has a score
for each cut into two parts: occurrences of the phrase, times ``SCALE``, over those of both parts,
rounded down; the lowest score counts, then the shorter first part. A phrase inside a longer frequent
one goes if that one has ``COVERED`` per cent of its occurrences or more.

A null text counts as empty, a null language as ``und``. Empty tables, and tables without frequent
phrases, give no rows. Repeated rows and rows that share a doc_id count each. Texts of any length are
read whole; a text is one stretch at least. Ties go to the phrase that is smaller in bytes. Extra
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.sized import broadcast_if_few
from tidewheel.llm.workers import importable
from tidewheel.operators.skew import heavy_keys, salted_join, with_position
from tidewheel.session import written

# Parameters of the report.
LEAST, LONGEST, FIRST, COVERED, SCALE = 30, 4, 2000, 80, 2_000_000
# Parameters of the counting: numbered words and phrases, the side of a tile, and bits of the filter.
WORDS, PHRASES, TILE, FILTER_BITS = 1 << 18, 1 << 20, 256, 26
# Bytes of text that are counted at a time, and rows and tiles that a task holds back.
STRETCH, HELD, TILES = 1 << 22, 1 << 21, 128
# A tile is an array if at least one in so many of its cells would be hit.
DENSE = 8

# A byte that no text in UTF-8 has; A-Z and the characters between pieces.
BREAK = b"\xff"
SPLIT = b".,;:!?\x0a\x0b\x0c\x0d"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
TABLE = bytes.maketrans(UPPER + SPLIT, LOWER + BREAK * len(SPLIT))

COUNTS = "code long, lang string, phrase binary, n long"


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of the texts, with a BREAK between pieces and between texts."""
    return BREAK.join(texts).translate(TABLE).replace(BREAK, b" " + BREAK + b" ").split()


def _stretches(batches):
    """Languages and tokens of some texts of each, about STRETCH bytes at a time."""
    texts, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py()
            texts.setdefault(lang, []).append(text)
            size += len(text)
            if size >= STRETCH:
                yield from ((lang, tokens(some)) for lang, some in texts.items())
                texts, size = {}, 0
    yield from ((lang, tokens(some)) for lang, some in texts.items())


def _rows(codes=None, counts=(), lang=None, phrases=None) -> pa.RecordBatch:
    n = len(counts)
    columns = [
        pa.nulls(n, pa.int64()) if codes is None else pa.array(codes, pa.int64()),
        pa.nulls(n, pa.string()) if phrases is None else pa.array([lang] * n, pa.string()),
        pa.nulls(n, pa.binary()) if phrases is None else pa.array(phrases, pa.binary()),
        pa.array(counts, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["code", "lang", "phrase", "n"])


class Texts:
    """Counts of phrases by their text."""

    def __init__(self):
        self.counts: dict[str, Counter] = {}

    def add(self, lang: str, phrases: list[bytes]) -> None:
        self.counts.setdefault(lang, Counter()).update(phrases)

    def full(self) -> bool:
        return sum(map(len, self.counts.values())) >= HELD // 4

    def rows(self):
        for lang, counts in self.counts.items():
            if counts:
                yield _rows(counts=list(counts.values()), lang=lang, phrases=list(counts))
        self.counts = {}


class Tiles:
    """Counts of pairs of numbers: arrays for tiles with many occurrences, sorted codes for the rest."""

    def __init__(self):
        self.arrays: dict[int, np.ndarray] = {}
        self.sorted: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        tile = (left // TILE) << 32 | (right // TILE)
        names, hits = np.unique(tile, return_counts=True)
        many = names[hits * DENSE >= TILE * TILE]
        apart = np.isin(tile, many)
        cell = left[apart] % TILE * TILE + right[apart] % TILE
        which = np.searchsorted(many, tile[apart])
        for number, name in enumerate(many.tolist()):
            counts = np.bincount(cell[which == number], minlength=TILE * TILE)
            self.arrays[name] = self.arrays[name] + counts if name in self.arrays else counts
        codes = np.sort(left[~apart] << 32 | right[~apart])
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        self.sorted.append((codes[starts], np.diff(starts, append=len(codes))))
        self.held += len(starts)

    def full(self) -> bool:
        return self.held >= HELD or len(self.arrays) > TILES

    def rows(self):
        parts = list(self.sorted)
        for name, counts in self.arrays.items():
            cell = np.flatnonzero(counts)
            left, right = (name >> 32) * TILE + cell // TILE, (name & 0xFFFFFFFF) * TILE + cell % TILE
            parts.append((left << 32 | right, counts[cell]))
        if parts:
            codes, counts = (np.concatenate(part) for part in zip(*parts, strict=True))
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            if len(starts):
                yield _rows(codes[starts], np.add.reduceat(counts, starts))
        self.arrays, self.sorted, self.held = {}, [], 0


class Numbered:
    """Frequent phrases of one length: the numbered ones, and a filter for the others, if there are any.

    The numbers of a language begin at a tile's edge and rise as frequency falls. ``left`` and ``right``
    are the numbers of the parts of a phrase, by its own number.
    """

    def __init__(self, frequent: DataFrame, most: int):
        ranked = with_position(frequent, [F.desc("f"), F.asc("lang"), F.asc("phrase")], "_at")
        head = F.col("_at") < most if "code" not in frequent.columns else (F.col("_at") < most) & F.col("code").isNotNull()
        columns = ["lang", "_at", "phrase" if "code" not in frequent.columns else "code"]
        # At most ``most`` rows.
        table = ranked.filter(head).select(*columns).toArrow().sort_by([("lang", "ascending"), ("_at", "ascending")])
        langs = table.column("lang").to_pylist()
        ids, at = np.zeros(len(langs), np.int64), 0
        for k, lang in enumerate(langs):
            if k and lang != langs[k - 1]:
                at = -(-at // TILE) * TILE
            ids[k], at = at, at + 1
        if "code" in frequent.columns:
            codes = table.column("code").to_numpy()
            order = np.argsort(codes)
            self.codes, self.ids = codes[order], ids[order]
            self.left, self.right = (np.zeros(at, np.int64) for _ in range(2))
            self.left[ids], self.right[ids] = codes >> 32, codes & 0xFFFFFFFF
        else:
            self.words: dict[str, dict[bytes, int]] = {}
            self.names: dict[int, tuple[str, bytes]] = {}
            for lang, number, word in zip(langs, ids.tolist(), table.column("phrase").to_pylist(), strict=True):
                self.words.setdefault(lang, {})[word.encode()] = number
                self.names[number] = lang, word.encode()
        self.bits = _filter(ranked.filter(~head))

    def others(self, lang: str, phrases: list[bytes]) -> np.ndarray:
        """Whether a phrase without a number may be frequent all the same."""
        prefix = zlib.crc32(lang.encode() + b"\t")
        slots = np.fromiter((zlib.crc32(phrase, prefix) for phrase in phrases), np.int64, len(phrases)) & ((1 << FILTER_BITS) - 1)
        return self.bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 == 1


def _filter(others: DataFrame) -> np.ndarray | None:
    """A bit for the hash of each phrase; 2 ** FILTER_BITS bits, or None without phrases."""
    slot = F.crc32(F.concat("lang", F.lit("\t"), "phrase")).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    per_row = 15  # bits of a place in one of Spark's bitmaps, a fixed value
    place = F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << per_row) - 1)))
    maps = others.groupBy(F.shiftright(slot, per_row).alias("part")).agg(place.alias("bits")).collect()
    if not maps:
        return None
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in maps:
        start = row["part"] << (per_row - 3)
        bits[start : start + (1 << (per_row - 3))] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def _words(batches):
    counts = Texts()
    for lang, found in _stretches(batches):
        counts.add(lang, found)
        pieces = counts.counts[lang].pop(BREAK, 0) if BREAK in counts.counts[lang] else 0
        # All words of the language, under a text that is no word.
        yield _rows(counts=[sum(1 for _ in found) - pieces], lang=lang, phrases=[b""])
        if counts.full():
            yield from counts.rows()
    yield from counts.rows()


# What is not a number: a phrase that is not frequent, and one that is in the filter of the others.
RARE, OTHER = -1, -2


def _numbers(model: list[Numbered], lang: str, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words, and of the phrases as long as the model's longest, by the first word."""
    first = model[0]
    get = first.words.get(lang, {}).get
    words = np.fromiter((get(word, RARE) for word in found), np.int64, len(found))
    if first.bits is not None:
        without = np.flatnonzero(words == RARE)
        without = without[[found[i] != BREAK for i in without.tolist()]] if len(without) else without
        words[without[first.others(lang, [found[i] for i in without.tolist()])]] = OTHER
    phrases = words
    for length, known in enumerate(model[1:], 2):
        # Both phrases that are one word shorter must be frequent.
        n = max(len(found) - length + 1, 0)
        before, word = phrases[:n], words[length - 1 :]
        may = (before != RARE) & (phrases[1 : n + 1] != RARE)
        phrases = np.full(n, RARE, np.int64)
        coded = np.flatnonzero(may & (before >= 0) & (word >= 0))
        if len(coded) and len(known.codes):
            codes = before[coded] << 32 | word[coded]
            at = np.minimum(np.searchsorted(known.codes, codes), len(known.codes) - 1)
            phrases[coded] = np.where(known.codes[at] == codes, known.ids[at], RARE)
        if known.bits is not None:
            without = np.flatnonzero(may & (phrases == RARE))
            texts = [b" ".join(found[i : i + length]) for i in without.tolist()]
            phrases[without[known.others(lang, texts)]] = OTHER
    return words, phrases


def _longer(model: list[Numbered]):
    """Counts phrases that are one word longer than the model's longest."""
    length = len(model) + 1

    def count(batches):
        tiles, texts = Tiles(), Texts()
        for lang, found in _stretches(batches):
            words, phrases = _numbers(model, lang, found)
            n = max(len(found) - length + 1, 0)
            before, word = phrases[:n], words[length - 1 :]
            may = (before != RARE) & (phrases[1 : n + 1] != RARE)
            coded = may & (before >= 0) & (word >= 0)
            tiles.add(before[coded], word[coded])
            texts.add(lang, [b" ".join(found[i : i + length]) for i in np.flatnonzero(may & ~coded).tolist()])
            for counts in (tiles, texts):
                if counts.full():
                    yield from counts.rows()
        yield from tiles.rows()
        yield from texts.rows()

    return count


def _named(model: list[Numbered]):
    """Writes out the phrases that codes stand for."""

    def text(number: int, length: int) -> tuple[str, bytes]:
        if length == 1:
            return model[0].names[number]
        lang, start = text(int(model[length - 1].left[number]), length - 1)
        return lang, start + b" " + model[0].names[int(model[length - 1].right[number])][1]

    def name(batches):
        for batch in batches:
            langs, phrases = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            for k, code in enumerate(batch.column("code").to_pylist()):
                if code is not None:
                    langs[k], start = text(code >> 32, len(model))
                    phrases[k] = start + b" " + model[0].names[code & 0xFFFFFFFF][1]
            columns = [batch.column("code"), pa.array(langs, pa.string()), pa.array(phrases, pa.binary()), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, ["code", "lang", "phrase", "n"])

    return name


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, words: int = WORDS, phrases: int = PHRASES) -> tuple[DataFrame, DataFrame]:
    """All phrases with ``least`` occurrences (lang, phrase, size, f), and the words of each language (lang, n)."""
    spark: SparkSession = docs.sparkSession
    importable(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = texts.mapInArrow(_words, COUNTS).groupBy("lang", F.col("phrase").cast("string").alias("phrase"))
    known = written(found.agg(F.sum("n").alias("f")).filter((F.col("f") >= least) | (F.col("phrase") == "")), "phrase-words")
    totals = known.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    level = known.filter(F.col("phrase") != "").filter(F.col("f") >= least)
    levels, model = [level.withColumn("size", F.lit(1))], []
    for size in range(2, longest + 1):
        model.append(Numbered(level, words if size == 2 else phrases))
        shared = spark.sparkContext.broadcast(model)
        counts = texts.mapInArrow(lambda batches, shared=shared: _longer(shared.value)(batches), COUNTS)
        sums = counts.groupBy("code", "lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        named = sums.mapInArrow(lambda batches, shared=shared: _named(shared.value)(batches), COUNTS)
        level = written(named.select("lang", F.col("phrase").cast("string").alias("phrase"), F.col("n").alias("f"), "code"), "phrase-level")
        levels.append(level.drop("code").withColumn("size", F.lit(size)))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every.select("lang", "phrase", "size", "f"), totals


def _key(phrase: Column) -> Column:
    # No phrase holds a tab.
    return F.concat("lang", F.lit("\t"), phrase)


def scored(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r and score of the ``candidates`` among ``known``, both as ``frequent`` gives them."""
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    ends = F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "),
    )
    parts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", F.posexplode(ends).alias("side", "text"))
    parts = written(parts.select("lang", "phrase", "a", "k", "side", _key(F.col("text")).alias("part")), "phrase-parts")
    given = known.select(_key(F.col("phrase")).alias("part"), "f")
    met = salted_join(parts, given, "part", heavy_keys(parts, "part"))
    sides = [F.max(F.when(F.col("side") == side, F.col("f"))).alias(name) for side, name in enumerate("lr")]
    cut = met.groupBy("lang", "phrase", "a", "k").agg(*sides)
    exact = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20, 0)) + r)")
    lowest = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def uncovered(known: DataFrame) -> DataFrame:
    """The phrases of two words or more that no longer one covers."""
    words = F.split("phrase", " ")
    longer = known.filter("size > 2").withColumn("_size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("_start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_size") + 1)))
    within = longer.select("lang", F.array_join(F.slice(words, F.col("_start"), F.col("_size")), " ").alias("phrase"), "f")
    around = within.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    candidates = known.filter("size > 1").join(around, ["lang", "phrase"], "left")
    left = F.col("around").isNull() | (100 * F.col("around") < COVERED * F.col("f"))
    return candidates.filter(left).drop("around")


def mined(docs: DataFrame, first: int = FIRST, least: int = LEAST, words: int = WORDS, phrases: int = PHRASES) -> DataFrame:
    """The ``first`` phrases of every language: lang, rank, phrase, a, l, r, n and score."""
    known, totals = frequent(docs, least, words=words, phrases=phrases)
    left = written(scored(uncovered(known), known), "phrase-left")
    placed = with_position(left, [F.asc("lang"), F.desc("score"), F.desc("a"), F.asc("phrase")], "_at")
    starts = placed.groupBy("lang").agg(F.min("_at").alias("_start")).join(totals, "lang")
    ranked = placed.join(broadcast_if_few(starts), "lang").withColumn("rank", F.col("_at") - F.col("_start") + 1)
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The rows of ``mined`` on documents.
SQL = f"""
WITH pieces AS MATERIALIZED (
    SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^\\x20\\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\\x0A-\\x0D]')) AS part FROM documents)),
totals AS MATERIALIZED (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
    SELECT lang, size, array_to_string(words[first:first + size - 1], ' ') AS phrase
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS first
          FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(words) >= size)),
known AS MATERIALIZED (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
    SELECT lang, phrase, f, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM known WHERE size > 1),
cut_scores AS (
    SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
           ({SCALE} * c.f::HUGEINT) // (x.f::HUGEINT + y.f) AS score
    FROM cuts c
    JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
    JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:], ' ')),
lowest AS (
    SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
    SELECT lang, array_to_string(words[first:first + size - 1], ' ') AS phrase, f
    FROM (SELECT lang, words, f, size, unnest(range(1, len(words) - size + 2)) AS first
          FROM (SELECT lang, f, string_split(phrase, ' ') AS words, unnest(range(2, size)) AS size FROM known WHERE size > 2))),
around AS (SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY lang, phrase)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase)::BIGINT AS rank,
       w.phrase, a, l, r, n, score::BIGINT AS score
FROM lowest w JOIN totals t ON t.lang = w.lang
LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
WHERE o.f IS NULL OR 100 * o.f < {COVERED} * a
QUALIFY rank <= {FIRST}
"""
