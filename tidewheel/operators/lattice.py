"""Totals over several groupings at once, each from a finer one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.session import written

#: How totals of finer groups become one of a coarser group.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}

Measures = Mapping[str, tuple[str, Column]]


def cube(df: DataFrame, dims: Sequence[str], measures: Measures) -> DataFrame:
    """``grouping_sets`` for all subsets of ``dims``."""
    return grouping_sets(df, dims, [s for size in range(len(dims), -1, -1) for s in combinations(dims, size)], measures)


def rollup(df: DataFrame, dims: Sequence[str], measures: Measures) -> DataFrame:
    """``grouping_sets`` for ``dims``, without the last one, without the last two, and so on."""
    return grouping_sets(df, dims, [tuple(dims[:size]) for size in range(len(dims), -1, -1)], measures)


def grouping_sets(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], measures: Measures) -> DataFrame:
    """One row per group of each set: the dims, null where the set has them not, ``grouping_id`` and the measures.

    ``grouping_id`` has a bit for each dim, the first one highest, that is set where the dim is left
    out, so that a null of the data and a dim left out differ. ``measures`` name a kind (count, sum, min,
    max) and a column. Only the finest grouping reads the rows, with partial totals in each task; every
    set is then made from the totals of the smallest stored set above it, so that rows are not
    repeated for each set. A heavy group is few rows after the first step. Sums of exact types are
    exact. A set without dims has one row, also for an empty table.
    """
    unknown = {name for s in sets for name in s} - set(dims)
    if unknown:
        raise ValueError(f"not among the dims: {sorted(unknown)}")
    wanted = [tuple(name for name in dims if name in s) for s in dict.fromkeys(tuple(s) for s in sets)]
    firsts = [getattr(F, kind)(column).alias(name) for name, (kind, column) in measures.items()]
    merges = [MERGES[kind](name).alias(name) for name, (kind, _) in measures.items()]
    finest = tuple(name for name in dims if any(name in s for s in wanted))
    kinds = {f.name: f.dataType for f in df.schema}
    made = {finest: written(df.groupBy(*finest).agg(*firsts), "lattice")}
    sizes = {finest: made[finest].count()}
    for s in sorted(set(wanted) - {finest}, key=len, reverse=True):
        above = min((t for t in made if set(s) < set(t)), key=lambda t: (sizes[t], dims.index(t[0])))
        made[s] = made[above].groupBy(*s).agg(*merges)
        # Only what something is made of is worth a table.
        if any(set(t) < set(s) for t in wanted):
            made[s] = written(made[s], "lattice")
            sizes[s] = made[s].count()
        else:
            sizes[s] = sizes[above]
    counted = [name for name, (kind, _) in measures.items() if kind == "count"]
    whole = None
    for s in wanted:
        level = made[s]
        number = sum(1 << (len(dims) - 1 - k) for k, name in enumerate(dims) if name not in s)
        columns = [F.col(name) if name in s else F.lit(None).cast(kinds[name]).alias(name) for name in dims]
        totals = [F.coalesce(name, F.lit(0)).alias(name) if name in counted else name for name in measures]
        level = level.select(*columns, F.lit(number).alias("grouping_id"), *totals)
        whole = level if whole is None else whole.unionByName(level)
    return whole
