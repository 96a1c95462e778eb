"""Mergeable summaries: quantiles, distinct counts, heavy hitters and histograms from one pass.

Each summary is made per part of the data (a file, a day, a task), has a size that does not grow with the rows, and merges: the
summary of a union comes from the summaries of its parts, so new data cost one scan of themselves. The quantile and distinct sketches
are Spark's own aggregates, and come with a stated error; the exact operators (``ntile.exact_quantiles``, ``measures.distinct_counts``) stay
beside them. Heavy hitters and histograms are exact: counters and bins only decide what to count.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import number_of
from ..session import materialize
from .joins import checked_broadcast
from .measures import top_groups

# executors need only the public libraries, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUANTILE_K = 800
DISTINCT_LG_K = 14
COUNTERS = 4_096
FINE_BINS = 4_096


# ---------------------------------------------------------------------------
# Quantiles
# ---------------------------------------------------------------------------

def rank_error(k: int = QUANTILE_K) -> float:
    """How far the rank of a sketched quantile may be off, as a share of the rows: twice the error that the
    sketch's authors state for 99 of 100 cases."""
    return 2 * 2.296 / k ** 0.9723


def quantile_sketches(df: DataFrame, columns: Sequence[str], parts: Sequence[str] = (), k: int = QUANTILE_K) -> DataFrame:
    """(parts..., column, sketch): a quantile sketch of every column per part, in one pass; missing values and NaN are left out."""
    wide = df.groupBy(*parts).agg(*[F.kll_sketch_agg_double(number_of(df, c), F.lit(k)).alias(f"__s{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return wide.select(*parts, F.inline(rows))


def merge_quantiles(sketches: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """(by..., sketch) of the union of the parts."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, quantiles: Sequence[float], k: int = QUANTILE_K) -> DataFrame:
    """(all but the sketch, n, q, value, rank_error): the quantiles of each sketch; NULL for a sketch of no values."""
    others = [c for c in sketches.columns if c != "sketch"]
    n = F.kll_sketch_get_n_double("sketch")
    each = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias("value"))
                     for q in quantiles])
    return sketches.select(*others, n.alias("n"), F.inline(each)).withColumn("rank_error", F.lit(rank_error(k)))


# ---------------------------------------------------------------------------
# Distinct counts
# ---------------------------------------------------------------------------

def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """The relative error of a sketched distinct count: four of the sketch's standard errors."""
    return 4 * 0.833 / math.sqrt(1 << lg_k)


def _text(c: str) -> Column:
    return F.col(f"`{c}`").cast("string")


def distinct_sketches(df: DataFrame, columns: Sequence[str], parts: Sequence[str] = (), lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """(parts..., column, sketch, has_null): a sketch of the distinct values of every column per part, in one pass
    without repeating rows per column."""
    aggs = [e for i, c in enumerate(columns) for e in (
        F.hll_sketch_agg(_text(c), F.lit(lg_k)).alias(f"__s{i}"), F.max(F.col(f"`{c}`").isNull()).alias(f"__n{i}"))]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__s{i}").alias("sketch"), F.col(f"__n{i}").alias("has_null"))
                     for i, c in enumerate(columns)])
    return df.groupBy(*parts).agg(*aggs).select(*parts, F.inline(rows))


def merge_distinct(sketches: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """(by..., sketch, has_null) of the union of the parts."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"), F.max("has_null").alias("has_null"))


def sketched_distinct(sketches: DataFrame, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """(all but the sketch, n_distinct, relative_error), NULL counted as a value, as ``distinct_counts`` does."""
    others = [c for c in sketches.columns if c not in ("sketch", "has_null")]
    n = F.hll_sketch_estimate("sketch") + F.coalesce(F.col("has_null").cast("long"), F.lit(0))
    return sketches.select(*others, n.alias("n_distinct"), F.lit(distinct_error(lg_k)).alias("relative_error"))


def sketched_row_report(df: DataFrame, kept: Column, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_before, distinct_after, distinct_lost): estimates of the distinct non-NULL values of all rows, of the ``kept``
    rows, and of those that no kept row has (a difference of sketches), in one pass."""
    kept = F.coalesce(kept, F.lit(False))
    wide = df.select(kept.alias("__kept"), *[_text(c).alias(f"__c{i}") for i, c in enumerate(columns)]).agg(*[e for i in range(len(columns)) for e in (
        F.theta_sketch_agg(f"__c{i}").alias(f"b{i}"), F.theta_sketch_agg(F.when(F.col("__kept"), F.col(f"__c{i}"))).alias(f"a{i}"))])
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.theta_sketch_estimate(f"b{i}").alias("distinct_before"), F.theta_sketch_estimate(f"a{i}").alias("distinct_after"),
        F.theta_sketch_estimate(F.theta_difference(f"b{i}", f"a{i}")).alias("distinct_lost")) for i, c in enumerate(columns)])))


# ---------------------------------------------------------------------------
# Heavy hitters
# ---------------------------------------------------------------------------

def key_counters(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """(key, low, off): per task at most ``counters`` keys with a lower bound of their rows, and one row (key NULL) whose
    ``off`` says by how much any key of the task may be counted short. NULL keys are left out."""
    def run(batches: Iterator[pa.RecordBatch]):
        held: dict = {}
        off = 0
        for batch in batches:
            for entry in batch.column(0).drop_null().value_counts():
                value = entry["values"].as_py()
                held[value] = held.get(value, 0) + entry["counts"].as_py()
            if len(held) > counters:                # what the first key past the last counter has is taken from all
                cut = sorted(held.values(), reverse=True)[counters]
                off += cut
                held = {v: n - cut for v, n in held.items() if n > cut}
        n = len(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*held, None], kind), pa.array([*held.values(), 0], pa.int64()), pa.array([0] * n + [off], pa.int64())],
            names=["key", "low", "off"])

    from pyspark.sql.pandas.types import to_arrow_type
    field = df.schema[key]
    kind = to_arrow_type(field.dataType)
    return df.select(F.col(f"`{key}`").alias("key")).mapInArrow(run, f"key {field.dataType.simpleString()}, low long, off long")


def top_groups_bounded(df: DataFrame, key: str, aggs: Mapping[str, Column], by: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """``top_groups`` for a ``by`` that counts the rows of a group, without a shuffle of all groups.

    Every task keeps ``counters`` keys; keys whose count may reach rank ``k`` are then counted exactly in a second pass, which only
    shuffles them. The answer is that of ``top_groups``: where the counters cannot separate rank k from the keys that no task
    kept (flat counts), the full aggregate is taken. So the shuffled rows are bounded by tasks x counters, unless the counts are flat.
    """
    held = materialize(key_counters(df, key, counters))
    off = held.agg(F.sum("off")).first()[0] or 0
    low = held.where("key is not null").groupBy("key").agg(F.sum("low").alias("low"))
    ranked = low.orderBy(F.desc("low")).limit(k).agg(F.min("low").alias("l"), F.count(F.lit(1)).alias("n")).first()
    if off and (ranked["n"] < k or ranked["l"] <= 0):
        return top_groups(df, key, aggs, by, k)
    wanted = checked_broadcast(materialize(low.where(F.col("low") + off >= (ranked["l"] or 0)).select(F.col("key").alias("__key"))))
    rows = df.join(wanted, df[key] == F.col("__key"), "left_semi")
    best = materialize(top_groups(rows, key, aggs, by, k))
    least = best.agg(F.min(by)).first()[0]
    # a key that no task kept has at most ``off`` rows
    if off and (least is None or least <= off):
        return top_groups(df, key, aggs, by, k)
    return best.orderBy(F.col(by).desc(), F.col(key).asc())


# ---------------------------------------------------------------------------
# Histograms
# ---------------------------------------------------------------------------

class _Bins:
    """Counts by bins of width 2^e over a stream of numbers; the width doubles while more than ``most`` bins are in use."""

    def __init__(self, most: int):
        self.most, self.e = most, None
        self.bins, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _widen(self, e: int) -> None:
        if e > self.e:
            self.bins >>= min(e - self.e, 63)
            self.e = e
            self._merge(self.bins, self.counts)

    def _merge(self, bins: np.ndarray, counts: np.ndarray) -> None:
        self.bins, where = np.unique(bins, return_inverse=True)
        self.counts = np.bincount(where, counts, len(self.bins)).astype(np.int64)

    def add(self, x: np.ndarray) -> None:
        if not len(x):
            return
        # whole numbers of widths fit in 63 bits
        size = math.frexp(float(np.abs(x).max()))[1] - 53
        if self.e is None:
            self.e = max(size, -1074)
        self._widen(size)
        bins = np.floor(np.ldexp(x, -self.e)).astype(np.int64)
        bins[(x < 0) & (bins == 0)] = -1            # too small beside the width for a double
        bins, counts = np.unique(bins, return_counts=True)
        self._merge(np.concatenate([self.bins, bins]), np.concatenate([self.counts, counts]))
        while len(self.bins) > self.most:
            self._widen(self.e + 1)


def histogram_parts(df: DataFrame, columns: Sequence[str], fine_bins: int = FINE_BINS) -> DataFrame:
    """(column, e, bin, count): per task the counts of bins [bin, bin + 1) * 2^e, ``fine_bins`` of them at most, in one pass. Missing values and NaN are left
    out; infinite ones have bin -1 or 1 and no e."""
    def run(batches: Iterator[pa.RecordBatch]):
        held = [_Bins(fine_bins) for _ in columns]
        infinite = np.zeros((len(columns), 2), np.int64)
        for batch in batches:
            for i, h in enumerate(held):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                infinite[i] += [(x == -np.inf).sum(), (x == np.inf).sum()]
                h.add(x[np.isfinite(x)])
        for c, h, (low, high) in zip(columns, held, infinite.tolist()):
            n = len(h.bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * (n + 2)), pa.array([h.e] * n + [None, None], pa.int32()), pa.array([*h.bins.tolist(), -1, 1], pa.int64()),
                 pa.array([*h.counts.tolist(), low, high], pa.int64())], names=["column", "e", "bin", "count"])

    rows = df.select(*[number_of(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    return rows.mapInArrow(run, "column string, e int, bin long, count long").where("count > 0")


def merge_histograms(parts: DataFrame, bins: int = 64) -> DataFrame:
    """(column, lower, upper, count): the parts' bins at the least common width that needs at most ``bins`` bins (at most ``FINE_BINS``) from a column's
    least to its largest value. Empty bins are left out; infinite values have equal edges."""
    parts = materialize(parts)
    finite = parts.where("e is not null")
    width = finite.groupBy("column").agg(F.max("e").alias("w"))
    level = (finite.join(width, "column").select("column", "w", F.expr("shiftright(bin, least(w - e, 63))").alias("b"))
             .groupBy("column", "w").agg(F.min("b").alias("lo"), F.max("b").alias("hi")))
    # the least number of further halvings after which the bins in use span few enough
    more = F.array_min(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda d: F.call_function("shiftright", F.col("hi"), d)
                                - F.call_function("shiftright", F.col("lo"), d) < bins))
    level = level.select("column", (F.col("w") + more).alias("w"))
    one = F.lit(2.0)
    counted = (finite.join(level, "column").select("column", "w", F.expr("shiftright(bin, least(w - e, 63))").alias("b"), "count")
               .groupBy("column", "w", "b").agg(F.sum("count").alias("count"))
               .select("column", (F.col("b") * F.pow(one, F.col("w"))).alias("lower"), ((F.col("b") + 1) * F.pow(one, F.col("w"))).alias("upper"), "count"))
    edge = F.col("bin") * F.lit(float("inf"))
    endless = parts.where("e is null").groupBy("column", "bin").agg(F.sum("count").alias("count")).select(
        "column", edge.alias("lower"), edge.alias("upper"), "count")
    return counted.unionByName(endless)
