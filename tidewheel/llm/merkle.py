"""A Merkle manifest of a table: a digest per row, a tree per group, one root, and a proof per row.

H is the sha256 of its inputs in a row; digests enter as lowercase hex. A leaf is H of the fields
of a row, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value. In every group
the leaves stand in order; while a group has several nodes, every eight in a row (the last ones may
be fewer, even one) become one node. What is left of a group is its subroot, also if that is a
leaf. The subroots, in the order of their groups, make the root in the same way.

Each level is a self-join: a node asks for the nodes in the other slots of its run, whose places it
computes from its own by shifting the slot, and gets them by an equijoin on tree and place. The
nodes in slot zero then emit the parents. On the way down every node gets the siblings of its
parent's path by a join on tree and parent's place, so the keys are even whatever the sizes of the
groups, and no run has more than eight rows. Levels are stored, so a lost executor costs one level.

Rows are ordered by key, nulls first, then by leaf; rows that agree in both are interchangeable, as
their digests are the same. Null groups are one group, and come first. Null and empty texts, and
texts of any length, are fields like others. Extra columns are not read. An empty table has no rows
and no root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.sized import broadcast_if_few
from tidewheel.operators.skew import with_position
from tidewheel.session import written

# Nodes of a run, and bytes of a digest.
FAN, DIGEST = 8, 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """sha256 as bytes."""
    return F.unhex(F.sha2(text, 256))


def shown(digests: Column) -> Column:
    """Digests, one or several in a row, as they enter a hash."""
    return F.lower(F.hex(digests))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row, as bytes."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return digest(F.concat(*parts))


def _placed(leaves: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``leaves`` (lang, digest, ...) with ``tree``, the place ``at`` in it and its size ``n``.

    A tree is named by the place of its first leaf among all leaves, so names are in the order of groups.
    """
    # Rows that agree in everything are told apart, so that many of them are spread over ranges.
    told = written(leaves.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")
    everywhere = with_position(told, [F.asc_nulls_first("lang"), *order, F.asc("digest"), F.asc("_row")], "_at")
    groups = everywhere.groupBy(F.col("lang").alias("_lang")).agg(F.min("_at").alias("tree"), F.count(F.lit(1)).alias("n"))
    joined = everywhere.join(broadcast_if_few(groups), F.col("lang").eqNullSafe(F.col("_lang")))
    placed = joined.select(*leaves.columns, "tree", (F.col("_at") - F.col("tree")).alias("at"), "n")
    return written(placed, "merkle-placed")


def _run_members(nodes: DataFrame) -> DataFrame:
    """tree, at, n and ``members``: the digests of the whole run of a node, in order, as bytes."""
    slot, first = F.col("at") % FAN, F.col("at") - F.col("at") % FAN
    shifts = F.explode(F.sequence(F.lit(0), F.lit(FAN - 1)))
    asked = nodes.select("tree", "at", "n", shifts.alias("_shift"))
    asked = asked.select("tree", "at", "n", (first + (slot + F.col("_shift")) % FAN).alias("_other")).filter("_other < n")
    given = nodes.select("tree", F.col("at").alias("_other"), "digest")
    run = F.sort_array(F.collect_list(F.struct("_other", "digest")))
    met = asked.join(given, ["tree", "_other"]).groupBy("tree", "at").agg(F.max("n").alias("n"), run.alias("_run"))
    members = F.aggregate("_run", F.expr("x''"), lambda done, node: F.concat(done, node["digest"]))
    return met.select("tree", "at", "n", members.alias("members"))


def _siblings() -> Column:
    """The members of a run but the own one."""
    own = (F.col("at") % FAN).cast("int") * DIGEST
    return F.concat(F.col("members").substr(F.lit(1), own), F.col("members").substr(own + DIGEST + 1, F.lit(FAN * DIGEST)))


def _grown(nodes: DataFrame, rows: DataFrame | None = None) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees (tree, at, siblings), and the roots (tree, level, digest).

    ``nodes`` has tree, at, n and digest. The lowest level also gets the columns of ``rows`` (tree, at, ...).
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.filter("n = 1").select("tree", F.lit(0).alias("level"), "digest")
    while most > 1:
        level = _run_members(nodes.filter("n > 1")).withColumn("siblings", _siblings())
        if rows is not None and not levels:
            level = level.join(rows, ["tree", "at"])
        level = written(level, "merkle-level")
        levels.append(level)
        # Slot zero emits the parent.
        nodes = level.filter(F.col("at") % FAN == 0).select(
            "tree",
            F.floor(F.col("at") / FAN).alias("at"),
            F.ceil(F.col("n") / FAN).alias("n"),
            digest(shown(F.col("members"))).alias("digest"),
        )
        most = -(-most // FAN)
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", F.lit(len(levels)).alias("level"), "digest"))
    return levels, written(roots, "merkle-roots")


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Each node of the lowest level, with what ``tops`` says of its tree and its path to the root.

    ``tops`` has tree, the level of its root, ``path`` from there on, and other columns.
    """
    told = [name for name in tops.columns if name not in ("tree", "level", "path")]

    def of(level: int) -> DataFrame:
        return tops.filter(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("at"), "path", *told)

    path = of(len(levels))
    for level in reversed(range(len(levels))):
        up = path.withColumnRenamed("at", "_parent")
        nodes = levels[level].withColumn("_parent", F.floor(F.col("at") / FAN)).drop("members", "n")
        step = F.struct((F.col("at") % FAN).cast("int").alias("slot"), "siblings")
        down = nodes.join(up, ["tree", "_parent"]).withColumn("path", F.concat(F.array(step), F.col("path")))
        # A single leaf stands on the lowest level as well: ``manifest`` adds it with its own columns.
        path = down.drop("_parent", "siblings") if level == 0 else down.drop("_parent", "siblings").unionByName(of(level))
    return path


def manifest(leaves: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``leaves`` (lang, digest, ...) with ``subroot``, ``root`` and ``path``, the steps from the leaf to the root.

    A step has the ``slot`` of the node in its run and the ``siblings``, digests in a row. ``order``
    orders the leaves of a group.
    """
    kept = list(leaves.columns)
    placed = _placed(leaves, order)
    levels, subroots = _grown(placed.select("tree", "at", "n", "digest"), placed.drop("n"))
    among = with_position(subroots.select("tree", "digest"), [F.asc("tree")], "at")
    among = written(among.withColumnRenamed("tree", "group"), "merkle-groups")
    groups = among.select(F.lit(0).cast("long").alias("tree"), "at", F.lit(among.count()).cast("long").alias("n"), "digest")
    upper, root = _grown(groups, among.select(F.lit(0).cast("long").alias("tree"), "at", "group"))
    nothing = F.array().cast("array<struct<slot:int,siblings:binary>>")
    over = root.select("tree", "level", F.col("digest").alias("root"), nothing.alias("path"))
    if upper:
        known = _paths(upper, over).select(F.col("group").alias("tree"), "root", "path")
    else:
        known = among.select(F.col("group").alias("tree")).crossJoin(F.broadcast(over.select("root", "path")))  # one row
    tops = written(subroots.withColumnRenamed("digest", "subroot").join(known, "tree"), "merkle-tops")
    alone = placed.filter("n = 1").join(tops.select("tree", "subroot", "root", "path"), "tree")
    columns = [*kept, "subroot", "root", "path"]
    alone = alone.select(*columns)
    return _paths(levels, tops).select(*columns).unionByName(alone) if levels else alone


def proof(path: Column) -> Column:
    """H of all siblings on a path, as hex."""
    every = F.aggregate(path, F.expr("x''"), lambda done, step: F.concat(done, step["siblings"]))
    return F.sha2(shown(every), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to, as bytes."""

    def climb(node: Column, step: Column) -> Column:
        before = step["slot"] * DIGEST
        left = step["siblings"].substr(F.lit(1), before)
        right = step["siblings"].substr(before + 1, F.lit(FAN * DIGEST))
        return digest(shown(F.concat(left, node, right)))

    return F.aggregate(path, start, climb)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def checked(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` by language, and whether each row still proves to be in it after tampering.

    Tampered are the rows where 3 divides the crc32 of the doc_id as text: A-Z of their texts became
    a-z. Rows without a doc_id are not tampered.
    """
    fields = {name: F.col(name) for name in FIELDS}
    changed = {**fields, "text": lower_ascii(F.col("text"))}
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    told = docs.select("doc_id", "lang", leaf(list(fields.values())).alias("digest"), F.when(hit, leaf(list(changed.values()))).alias("found"))
    rows = manifest(told, [F.asc_nulls_first("doc_id")])
    ends = rows.withColumn("end", folded(F.coalesce("found", "digest"), F.col("path")))
    return ends.select(
        "doc_id",
        shown(F.col("digest")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        shown(F.col("root")).alias("root"),
        proof(F.col("path")).alias("proof_sha256"),
        shown(F.col("end")).alias("folded_root"),
        (F.col("end") == F.col("root")).alias("verified"),
    )


#: The rows of ``checked`` on documents.
SQL = """
WITH RECURSIVE told AS MATERIALIZED (
    SELECT doc_id, lang, text,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                   lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 3 = 0, false) AS hit
    FROM documents),
leaves AS MATERIALIZED (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(text) || ':' || CASE WHEN hit THEN
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS found
    FROM told),
placed AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS n
    FROM leaves),
nodes(tree, level, place, n, digest) AS (
    SELECT tree, 0, place, n, leaf FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY tree, level, place // 8, n),
lower_nodes AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (SELECT tree, level AS height, digest AS subroot FROM lower_nodes WHERE n = 1),
tops(level, place, n, digest) AS (
    SELECT 0, tree, (SELECT count(*) FROM subroots), subroot FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place // 8, n),
upper_nodes AS MATERIALIZED (SELECT * FROM tops),
steps AS MATERIALIZED (
    SELECT a.tree, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
           coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
    FROM lower_nodes a JOIN lower_nodes b ON a.tree = b.tree AND a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.n > 1 GROUP BY a.tree, a.level, a.place),
top_steps AS MATERIALIZED (
    SELECT a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
           coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
    FROM upper_nodes a JOIN upper_nodes b ON a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.n > 1 GROUP BY a.level, a.place),
climb(doc_id, tree, first, step, place, node, proof) AS (
    SELECT doc_id, tree, place, 0, place, found, '' FROM placed
    UNION ALL
    SELECT c.doc_id, c.tree, c.first, c.step + 1,
           CASE WHEN c.step + 1 = s.height THEN c.tree ELSE c.place // 8 END,
           sha256(coalesce(l.before, t.before) || c.node || coalesce(l.after, t.after)),
           c.proof || coalesce(l.before, t.before) || coalesce(l.after, t.after)
    FROM climb c JOIN subroots s ON c.tree = s.tree
    LEFT JOIN steps l ON c.step < s.height AND l.tree = c.tree AND l.level = c.step AND l.place = c.place
    LEFT JOIN top_steps t ON c.step >= s.height AND t.level = c.step - s.height
        AND t.place = CASE WHEN s.height = c.step THEN c.tree ELSE c.place END
    WHERE l.tree IS NOT NULL OR t.level IS NOT NULL),
ends AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY tree, first ORDER BY step DESC) = 1)
SELECT p.doc_id, p.leaf, s.subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
       e.node AS folded_root, e.node = r.digest AS verified
FROM placed p JOIN ends e ON e.tree = p.tree AND e.first = p.place
JOIN subroots s ON s.tree = p.tree CROSS JOIN (SELECT digest FROM upper_nodes WHERE n = 1) r
"""
