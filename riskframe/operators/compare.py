"""Group-versus-whole comparisons.

The source table is scanned and aggregated once. The per-group aggregate is
written to the shared checkpoint folder (it has one row per group), and the
"overall" and "subgroup" figures are derived from it by summing the
per-group sums and non-NULL counts. This gives the same mean as averaging
the rows again, without a second scan of the source and without a join of
two full aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, col, percent, ratio
from ..session import materialize


def compare_to_overall(df: DataFrame, key: str, value: ColumnOrName, hit: Column,
                       k: int | None = 5, total_alias: str = "total",
                       hit_alias: str = "hit_count", rate_alias: str = "rate_pct",
                       avg_alias: str = "avg_value", ratio_alias: str = "vs_overall_ratio",
                       extra_aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Per group of ``key`` (NULL keys excluded): row count, ``hit`` count and
    percent, mean of ``value`` and its ratio to the mean over all rows;
    top ``k`` groups by percent (ties by key), or all groups if ``k`` is None."""
    v = col(value)
    groups = (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias(total_alias), F.count_if(hit).alias(hit_alias),
                   F.avg(v).alias(avg_alias), F.sum(v).alias("_sum"), F.count(v).alias("_cnt"),
                   *[c.alias(n) for n, c in (extra_aggs or {}).items()]))
    groups = materialize(groups)      # one scan of the source feeds both uses below
    return overall_from_groups(groups, key, k, total_alias, hit_alias, rate_alias, avg_alias, ratio_alias, list(extra_aggs or {}))


def overall_from_groups(groups: DataFrame, key: str, k: int | None = 5, total_alias: str = "total", hit_alias: str = "hit_count",
                        rate_alias: str = "rate_pct", avg_alias: str = "avg_value", ratio_alias: str = "vs_overall_ratio",
                        extra: Sequence[str] = ()) -> DataFrame:
    """``compare_to_overall`` from its per-group table, which is already computed: key, total, hits, mean, and the
    sum ``_sum`` and count ``_cnt`` that the mean is made of."""
    # overall mean = sum of group sums / sum of group counts, read off the
    # small checkpointed table and attached as a literal
    overall = groups.agg(ratio(F.sum("_sum"), F.sum("_cnt")).alias("o")).collect()[0]["o"]
    out = (groups
           .withColumn(rate_alias, percent(hit_alias, total_alias))
           .withColumn(ratio_alias, ratio(avg_alias, F.lit(overall).cast("double")))
           .select(key, total_alias, hit_alias, rate_alias, avg_alias, ratio_alias,
                   *extra))
    ordered = out.orderBy(F.col(rate_alias).desc(), F.col(key).asc())
    return ordered.limit(k) if k is not None else ordered


def compare_to_subgroup(df: DataFrame, fine: Sequence[str], coarse: Sequence[str],
                        measure: ColumnOrName, hit: Column,
                        aggs: Mapping[str, Column] | None = None,
                        count_alias: str = "count", measure_alias: str = "avg_measure",
                        rate_alias: str = "rate_pct", diff_alias: str = "measure_vs_coarse",
                        drop_null_keys: bool = True) -> DataFrame:
    """Per group of ``fine`` keys: count, extra aggregates, mean of ``measure``,
    percent of ``hit`` rows, and the mean minus the mean of the enclosing
    ``coarse`` group (``coarse`` is a subset of ``fine``)."""
    if not set(coarse) <= set(fine):
        raise ValueError("coarse keys must be a subset of fine keys")
    m = col(measure)
    src = df
    if drop_null_keys:
        for kname in fine:
            src = src.filter(F.col(kname).isNotNull())
    fine_t = (src.groupBy(*fine)
              .agg(F.count(F.lit(1)).alias(count_alias),
                   *[c.alias(n) for n, c in (aggs or {}).items()],
                   F.avg(m).alias(measure_alias), F.count_if(hit).alias("_hit"),
                   F.sum(m).alias("_sum"), F.count(m).alias("_cnt")))
    fine_t = materialize(fine_t)      # one scan of the source feeds both uses below
    return subgroup_from_groups(fine_t, fine, coarse, list(aggs or {}), count_alias, measure_alias, rate_alias, diff_alias)


def subgroup_from_groups(fine_t: DataFrame, fine: Sequence[str], coarse: Sequence[str], extra: Sequence[str] = (),
                         count_alias: str = "count", measure_alias: str = "avg_measure", rate_alias: str = "rate_pct",
                         diff_alias: str = "measure_vs_coarse") -> DataFrame:
    """``compare_to_subgroup`` from its per-group table, which is already computed: keys, count, further aggregates, mean, the
    hits ``_hit``, and the sum ``_sum`` and count ``_cnt`` that the mean is made of."""
    coarse_t = (fine_t.groupBy(*coarse)
                .agg(ratio(F.sum("_sum"), F.sum("_cnt")).alias("_coarse"))
                .select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(coarse)], "_coarse"))
    # Both sides are aggregates of the same scan (the exchange is reused); the
    # coarse side has at most as many rows as the fine side. Keys match
    # NULL-safely, as in the grouping itself.
    cond = None
    for i, c in enumerate(coarse):
        eq = fine_t[c].eqNullSafe(F.col(f"__c{i}"))
        cond = eq if cond is None else cond & eq
    joined = fine_t.join(coarse_t, cond, "inner")
    return (joined
            .withColumn(rate_alias, percent("_hit", count_alias))
            .withColumn(diff_alias, F.col(measure_alias) - F.col("_coarse"))
            .select(*fine, count_alias, *extra, measure_alias, rate_alias, diff_alias)
            .orderBy(*fine))
