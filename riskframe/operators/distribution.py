"""Distribution summaries computed on all rows: describe, histogram, box summary.

The charts of a distribution are drawn from small tables: a handful of
statistics, bin counts or box figures per column. Those tables are computed
here by aggregation over every row instead of from a sample pulled to the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import number_of
from .ntile import exact_quantiles

# Default bin count and box-whisker reach (times the IQR).
HISTOGRAM_BINS = 30
WHISKER_REACH = 1.5


def _value(df: DataFrame, c: str):
    return number_of(df, c)                # dirty text and NaN are treated as missing


def _long(wide: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per column from a one-row wide aggregate named ``{field}{i}``."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              *[F.col(f"{f}{i}").alias(f) for f in fields])
                     for i, c in enumerate(columns)])
    return wide.select(F.inline(rows))


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min, max of each column in one pass,
    typed (not strings): (column, count, mean, stddev, min, max)."""
    aggs = []
    for i, c in enumerate(columns):
        x = _value(df, c)
        aggs += [F.count(x).alias(f"count{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"stddev{i}"), F.min(x).alias(f"min{i}"),
                 F.max(x).alias(f"max{i}")]
    return _long(df.agg(*aggs), columns, ["count", "mean", "stddev", "min", "max"])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of each column over [min, max] of its finite values, last bin closed,
    empty bins included: (column, bin, lower, upper, count). Infinite values, if any, are counted in
    a row of their own per sign: bin -1 for -Infinity, bin ``bins`` for Infinity (both edges infinite).

    Pass 1 finds min and max of all columns (one row). Pass 2 bins every
    value and counts per (column, bin): partial aggregation before the
    shuffle, at most ``len(columns) * bins`` groups.
    """
    spark = df.sparkSession
    inf = float("inf")

    def finite(c):
        x = _value(df, c)
        return F.when((x < inf) & (x > -inf), x)

    ext = df.agg(*[F.min(finite(c)).alias(f"mn{i}") for i, c in enumerate(columns)],
                 *[F.max(finite(c)).alias(f"mx{i}") for i, c in enumerate(columns)]).collect()[0]
    binned, lows, widths = {}, {}, {}
    for i, c in enumerate(columns):
        mn, mx = ext[f"mn{i}"], ext[f"mx{i}"]
        if mn is None:
            continue
        # halves first: the difference of two large finite values may overflow
        width = (mx / 2 - mn / 2) / bins * 2
        lows[c], widths[c] = mn, width
        x = _value(df, c)
        b = F.lit(0) if width == 0 else F.least(
            F.lit(bins - 1), F.floor((x - F.lit(mn)) / F.lit(width)).cast("int"))
        binned[c] = F.when(x == inf, F.lit(bins)).when(x == -inf, F.lit(-1)).when(x.isNotNull(), b)
    present = list(binned)
    if not present:
        return spark.createDataFrame([], "column string, bin int, lower double, upper double, count bigint")
    counts = (df.select(*[binned[c].alias(c) for c in present])
              .unpivot([], present, "column", "bin")
              .filter(F.col("bin").isNotNull())
              .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")))
    # grid of every (column, bin): len(columns) * bins rows, built from literals
    grid = spark.createDataFrame([(c,) for c in present], "column string").select(
        "column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    lo = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(float(lows[c])))])
    wd = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(float(widths[c])))])
    # at most len(columns) * (bins + 2) rows on either side
    infinite = F.when(F.col("bin") < 0, F.lit(-inf)).when(F.col("bin") >= bins, F.lit(inf))
    return (grid.join(F.broadcast(counts), ["column", "bin"], "full")
            .select("column", "bin",
                    F.coalesce(infinite, lo[F.col("column")] + F.col("bin") * wd[F.col("column")]).alias("lower"),
                    F.coalesce(infinite, lo[F.col("column")] + (F.col("bin") + 1) * wd[F.col("column")]).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def box_summary(df: DataFrame, columns: Sequence[str], reach: float = WHISKER_REACH) -> DataFrame:
    """Box-plot figures of each column: exact quartiles (linear interpolation),
    whiskers at the furthest values within ``reach`` IQR of the box, and the
    outlier count. (column, count, min, q1, median, q3, max, lower_whisker,
    upper_whisker, n_outliers)."""
    qs = exact_quantiles(df, [_value(df, c) for c in columns], [0.25, 0.5, 0.75])
    aggs, fields = [], ["count", "min", "q1", "median", "q3", "max",
                        "lower_whisker", "upper_whisker", "n_outliers"]
    for i, (c, (q1, med, q3)) in enumerate(zip(columns, qs)):
        x = _value(df, c)
        if q1 is None:
            lo_f = hi_f = None
        else:
            iqr = q3 - q1
            lo_f, hi_f = q1 - reach * iqr, q3 + reach * iqr
        lit = (lambda v: F.lit(v).cast("double"))
        inside = (x >= lit(lo_f)) & (x <= lit(hi_f))
        aggs += [F.count(x).alias(f"count{i}"), F.min(x).alias(f"min{i}"),
                 lit(q1).alias(f"q1{i}"), lit(med).alias(f"median{i}"), lit(q3).alias(f"q3{i}"),
                 F.max(x).alias(f"max{i}"),
                 F.min(F.when(inside, x)).alias(f"lower_whisker{i}"),
                 F.max(F.when(inside, x)).alias(f"upper_whisker{i}"),
                 F.count_if(x.isNotNull() & ~inside).alias(f"n_outliers{i}")]
    return _long(df.agg(*aggs), columns, fields)


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The numeric columns among ``columns`` (default: all), in order."""
    from pyspark.sql import types as T
    names = list(columns) if columns is not None else df.columns
    return [c for c in names if isinstance(df.schema[c].dataType, T.NumericType)]


def histogram_first(df: DataFrame, n: int, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Histograms of the numeric columns among the first ``n`` columns."""
    return histogram(df, numeric_columns(df, df.columns[:n]), bins)


def box_summary_at(df: DataFrame, index: int, reach: float = WHISKER_REACH) -> DataFrame:
    """Box summary of the column at position ``index``."""
    return box_summary(df, [df.columns[index]], reach)
