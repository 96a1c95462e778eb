"""Several grouped answers from one scan.

Questions that each aggregate the same table by their own keys and conditions would each scan it. Here
their aggregates are fused: one ``GROUPING SETS`` pass over the table computes, for every set of keys in use, the sums and counts that
any question needs (each with its own condition inside the aggregate), and the staged result, one row per group, answers all of them.
A set of keys that is part of another one is not a grouping set of its own: its figures are sums over
the finer groups. Sums and counts are combined per task before the shuffle, so a hot group costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from ..session import materialize


@dataclass(frozen=True)
class Measure:
    """What to compute per group: ``kind`` is mean, sum or rows; ``where`` limits it to some of the request's rows."""

    kind: str
    value: Column | None = None
    where: Column | None = None


def mean_of(value: Column | str, where: Column | None = None) -> Measure:
    return Measure("mean", F.col(value) if isinstance(value, str) else value, where)


def sum_of(value: Column | str, where: Column | None = None) -> Measure:
    return Measure("sum", F.col(value) if isinstance(value, str) else value, where)


def rows_where(where: Column | None = None) -> Measure:
    return Measure("rows", None, where)


@dataclass(frozen=True)
class Request:
    """One grouped answer: ``measures`` per group of ``keys`` (none: one row) over the rows that meet ``where``."""

    keys: Sequence[str]
    measures: Mapping[str, Measure]
    where: Column | None = None
    drop_null_keys: bool = False


def _both(a: Column | None, b: Column | None) -> Column | None:
    return b if a is None else a if b is None else a & b


def grouping_sets(requests: Mapping[str, Request]) -> list[tuple[str, ...]]:
    """The sets of keys that have to be grouped: those in no larger one (a request without keys alone groups by nothing)."""
    used = sorted({tuple(sorted(r.keys)) for r in requests.values()}, key=lambda k: (-len(k), k))
    return [k for i, k in enumerate(used) if not any(set(k) <= set(o) for o in used[:i])]


def shared_groups(df: DataFrame, requests: Mapping[str, Request]) -> dict[str, DataFrame]:
    """The answer of every request: its keys and measures, one row per group that has a row meeting its condition.

    A request without keys has exactly one row (means and sums of no rows are NULL, counts 0). ``df`` is scanned once, now; the
    answers read the staged groups. A mean is its sum over its count of non-NULL values.
    """
    sets = grouping_sets(requests)
    fused, parts = fused_groups(df, requests, sets)
    groups = materialize(fused)
    return {name: _read_off(groups, r, *parts[name], sets) for name, r in requests.items()}


def fused_groups(df: DataFrame, requests: Mapping[str, Request], sets: Sequence[tuple[str, ...]]):
    """(one aggregate over ``df`` with a row per group of every set, per request its measures' stored columns and the
    column that counts its rows)."""
    stored: dict[str, tuple[str, Column]] = {}      # each expression once

    def atom(kind: str, c: Column) -> str:
        return stored.setdefault(f"{kind} {c}", (f"_m{len(stored)}", c))[0]

    def columns(m: Measure, where: Column | None) -> list[str]:
        on = _both(where, m.where)
        if m.kind == "rows":
            return [atom("rows", F.count_if(on if on is not None else F.lit(True)))]
        v = m.value if on is None else F.when(on, m.value)
        return [atom("sum", F.sum(v)), atom("count", F.count(v))]

    parts = {name: ({alias: columns(m, r.where) for alias, m in r.measures.items()}, columns(rows_where(), r.where)[0])
             for name, r in requests.items()}
    keys = sorted({k for s in sets for k in s})
    aggs = [c.alias(a) for a, c in stored.values()]
    if not keys:
        return df.agg(F.lit(0).cast("long").alias("_set"), *aggs), parts
    return df.groupingSets([list(s) for s in sets], *keys).agg(F.grouping_id().alias("_set"), *aggs), parts


def _read_off(groups: DataFrame, r: Request, parts: Mapping[str, list[str]], present: str, sets: Sequence[tuple[str, ...]]) -> DataFrame:
    keys = sorted({k for s in sets for k in s})
    source = next(s for s in sets if set(r.keys) <= set(s))
    # the bits of grouping_id() follow the order of the columns, the first one highest
    rows = groups.where(F.col("_set") == sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in source))
    if r.drop_null_keys:
        for k in r.keys:
            rows = rows.where(F.col(k).isNotNull())
    if set(r.keys) != set(source):
        needed = sorted({a for p in parts.values() for a in p} | {present})
        rows = rows.groupBy(*r.keys).agg(*[F.sum(a).alias(a) for a in needed])
    if r.keys:
        rows = rows.where(F.col(present) > 0)
    out = []
    for alias, m in r.measures.items():
        a = [F.col(c) for c in parts[alias]]
        out.append((ratio(*a) if m.kind == "mean" else a[0] if m.kind == "sum" else F.coalesce(a[0], F.lit(0).cast("long"))).alias(alias))
    return rows.select(*r.keys, *out)
