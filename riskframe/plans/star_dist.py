"""Distribution-summary bindings (describe, histogram, box summary)."""

from __future__ import annotations

from ..operators import distribution
from .star import _r, query, table

LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
HIST_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
BOX_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]

ORACLE_DIST: dict[str, str] = {}


@query
def agg_describe(spark, sf_dir):
    return _r(distribution.describe_table(table(spark, sf_dir, "lineitem"), LINE_NUMERIC))


ORACLE_DIST["agg_describe"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max "
    f"FROM lineitem" for c in LINE_NUMERIC)


@query
def dst_histogram(spark, sf_dir):
    return _r(distribution.histogram(table(spark, sf_dir, "lineitem"), HIST_COLUMNS, 30))


def _hist_sql(c: str, bins: int = 30, tab: str = "lineitem") -> str:
    return f"""
SELECT '{c}' AS "column", CAST(g.bin AS INTEGER) AS bin,
       round(s.mn + g.bin * s.w, 6) AS lower, round(s.mn + (g.bin + 1) * s.w, 6) AS upper,
       CAST(coalesce(h.n, 0) AS BIGINT) AS count
FROM (SELECT min({c}) AS mn, (max({c}) - min({c})) / {bins} AS w FROM {tab}) s
CROSS JOIN (SELECT range AS bin FROM range({bins})) g
LEFT JOIN (SELECT b, count(*) AS n FROM (
             SELECT CASE WHEN s2.w = 0 THEN 0
                         ELSE least({bins - 1}, CAST(floor(({c} - s2.mn) / s2.w) AS INTEGER)) END AS b
             FROM {tab}, (SELECT min({c}) AS mn, (max({c}) - min({c})) / {bins} AS w FROM {tab}) s2
             WHERE {c} IS NOT NULL) GROUP BY b) h ON h.b = g.bin
"""


ORACLE_DIST["dst_histogram"] = " UNION ALL ".join(_hist_sql(c) for c in HIST_COLUMNS)


FIRST_N = 8   # lineitem's first 8 columns are all numeric


@query
def dst_histogram_first_columns(spark, sf_dir):
    return _r(distribution.histogram_first(table(spark, sf_dir, "lineitem"), FIRST_N, 30))


_FIRST = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
          "l_extendedprice", "l_discount", "l_tax"]
ORACLE_DIST["dst_histogram_first_columns"] = " UNION ALL ".join(_hist_sql(c) for c in _FIRST)


@query
def dst_box_at_index(spark, sf_dir):
    return _r(distribution.box_summary_at(table(spark, sf_dir, "orders"), 3))   # o_totalprice


@query
def dst_box_summary(spark, sf_dir):
    return _r(distribution.box_summary(table(spark, sf_dir, "lineitem"), BOX_COLUMNS))


def _box_sql(c: str, tab: str = "lineitem") -> str:
    return f"""
SELECT '{c}' AS "column", count({c}) AS count, round(min({c}), 6) AS min, round(q.q1, 6) AS q1,
       round(q.med, 6) AS median, round(q.q3, 6) AS q3, round(max({c}), 6) AS max,
       round(min({c}) FILTER (WHERE {c} >= q.q1 - 1.5 * (q.q3 - q.q1) AND {c} <= q.q3 + 1.5 * (q.q3 - q.q1)), 6)
           AS lower_whisker,
       round(max({c}) FILTER (WHERE {c} >= q.q1 - 1.5 * (q.q3 - q.q1) AND {c} <= q.q3 + 1.5 * (q.q3 - q.q1)), 6)
           AS upper_whisker,
       count_if({c} IS NOT NULL AND NOT ({c} >= q.q1 - 1.5 * (q.q3 - q.q1) AND {c} <= q.q3 + 1.5 * (q.q3 - q.q1)))
           AS n_outliers
FROM {tab}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
                       quantile_cont({c}, 0.75) AS q3 FROM {tab}) q
GROUP BY q.q1, q.med, q.q3
"""


ORACLE_DIST["dst_box_summary"] = " UNION ALL ".join(_box_sql(c) for c in BOX_COLUMNS)

ORACLE_DIST["dst_box_at_index"] = _box_sql("o_totalprice", "orders")
