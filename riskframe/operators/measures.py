"""Measures: conditional means/counts/shares and per-group profiles.

Every operator is one filter + one aggregate. Spark computes the aggregate in
two phases (partial per input split, final after the shuffle), so only one
small row per group and split crosses the network and a hot group costs no
more than a cold one. Scalar answers are one-row DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, col, percent


def _aggs(aggs: Mapping[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in aggs.items()]


def conditional_mean(df: DataFrame, predicate: Column, value: ColumnOrName,
                     alias: str = "avg_value") -> DataFrame:
    """Mean of ``value`` over rows matching ``predicate``; one row (NULL if none)."""
    return df.filter(predicate).agg(F.avg(col(value)).alias(alias))


def conditional_count(df: DataFrame, predicate: Column, alias: str = "count") -> DataFrame:
    """Number of rows matching ``predicate``; one row."""
    return df.filter(predicate).agg(F.count(F.lit(1)).alias(alias))


def conditional_share(df: DataFrame, base: Column, hit: Column,
                      alias: str = "rate_pct") -> DataFrame:
    """Percent of ``base`` rows that also satisfy ``hit``; one pass, NULL if base is empty."""
    return (df.filter(base)
            .agg(F.count(F.lit(1)).alias("_n"), F.count_if(hit).alias("_hit"))
            .select(percent("_hit", "_n").alias(alias)))


def group_profile(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
                  order_by: Sequence[ColumnOrName] | None = None) -> DataFrame:
    """Per-group aggregates; NULL keys form a group of their own."""
    out = df.groupBy(*keys).agg(*_aggs(aggs))
    return out.orderBy(*order_by) if order_by else out


def top_groups(df: DataFrame, key: str, aggs: Mapping[str, Column], by: str, k: int,
               drop_null_keys: bool = True, descending: bool = True) -> DataFrame:
    """The ``k`` groups with the largest (or smallest) ``by``; ties broken by key.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition
    keeps its own top ``k`` and only those rows are merged.
    """
    src = df.filter(F.col(key).isNotNull()) if drop_null_keys else df
    grouped = src.groupBy(key).agg(*_aggs(aggs))
    primary = F.col(by).desc() if descending else F.col(by).asc()
    return grouped.orderBy(primary, F.col(key).asc_nulls_first()).limit(k)


def rate_by_group(df: DataFrame, key: str, base: Column, hit: Column, min_n: int = 10,
                  k: int = 10, total_alias: str = "total", hit_alias: str = "hit_count",
                  rate_alias: str = "rate_pct") -> DataFrame:
    """Share of ``hit`` among ``base`` rows per group, groups with at least
    ``min_n`` rows, top ``k`` by share (ties by key)."""
    grouped = (df.filter(base).groupBy(key)
               .agg(F.count(F.lit(1)).alias(total_alias), F.count_if(hit).alias(hit_alias))
               .withColumn(rate_alias, percent(hit_alias, total_alias))
               .filter(F.col(total_alias) >= F.lit(min_n)))
    return grouped.orderBy(F.col(rate_alias).desc(), F.col(key).asc_nulls_first()).limit(k)


def compare_groups(df: DataFrame, key: str, values: Sequence[str], aggs: Mapping[str, Column],
                   hit: Column, total_alias: str = "total", hit_alias: str = "hit_count",
                   rate_alias: str = "rate_pct") -> DataFrame:
    """Side-by-side profile of the listed groups with the share of ``hit`` rows."""
    return (df.filter(F.col(key).isin(list(values))).groupBy(key)
            .agg(*_aggs(aggs), F.count(F.lit(1)).alias(total_alias),
                 F.count_if(hit).alias(hit_alias))
            .withColumn(rate_alias, percent(hit_alias, total_alias))
            .orderBy(key))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` (NULL is one value)."""
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct-value count per column in one pass, NULL counted as a value
    (the meaning of ``select(c).distinct().count()``); long table (column, n_distinct).

    Each ``count(DISTINCT c)`` is exact; Spark plans them together with one
    Expand, so the input is read once.
    """
    exprs = []
    for c in columns:
        has_null = F.max(F.col(c).isNull().cast("int"))
        exprs.append((F.countDistinct(F.col(c)) + F.coalesce(has_null, F.lit(0))).alias(c))
    wide = df.agg(*exprs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("n_distinct"))
        for c in columns])).alias("s")).select("s.column", "s.n_distinct")
