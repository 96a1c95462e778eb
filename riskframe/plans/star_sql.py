"""DuckDB SQL computing the same result as each binding in ``star``.

Tables are the driver's views (region nation customer supplier part orders
lineitem events ...). Column names equal the Spark aliases; computed doubles
are rounded exactly as in ``star._r``; counts are cast to BIGINT and n-tiles
to INTEGER, the Spark types.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _share(cond: str) -> str:
    return f"CAST(count_if({cond}) AS DOUBLE) / count(*) * 100.0"


ORACLE["q01_conditional_mean"] = """
SELECT round(avg(c_acctbal), 6) AS avg_acctbal
FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000.0
"""

ORACLE["q02_conditional_count"] = """
SELECT count(*) AS count FROM lineitem WHERE l_quantity > 45.0 AND l_returnflag = 'R'
"""

ORACLE["q03_conditional_share"] = f"""
SELECT round({_share("l_returnflag = 'R'")}, 6) AS rate_pct
FROM lineitem WHERE l_discount < 0.03
"""

ORACLE["q04_group_profile"] = """
SELECT n_name, round(avg(c_acctbal), 6) AS avg_acctbal, round(sum(o_totalprice), 2) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
"""

ORACLE["q05_top_groups"] = """
SELECT p_brand, round(avg(p_retailprice), 6) AS avg_price, count(*) AS num_parts
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
ORDER BY num_parts DESC, p_brand LIMIT 10
"""

ORACLE["q06_diff_from_group_mean"] = """
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal,
       round(avg(c_acctbal) OVER (PARTITION BY c_nationkey), 6) AS avg_nation_acctbal,
       round(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey), 6) AS acctbal_difference
FROM customer
"""

ORACLE["q07_rate_by_group"] = f"""
SELECT p_brand, count(*) AS total_loans,
       CAST(count_if(l_returnflag = 'R') AS BIGINT) AS charged_off_count,
       round({_share("l_returnflag = 'R'")}, 6) AS default_rate_pct
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag IN ('R', 'A')
GROUP BY p_brand HAVING count(*) >= 10
ORDER BY {_share("l_returnflag = 'R'")} DESC, p_brand LIMIT 10
"""

_AGE = "CAST(datediff('month', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) / 12.0"

ORACLE["q08_age_quantile_profile"] = f"""
WITH t AS (SELECT o_orderkey, o_totalprice, {_AGE} AS age_years FROM orders),
q AS (SELECT *, ntile(4) OVER (ORDER BY age_years, o_orderkey) AS quartile
      FROM t WHERE age_years >= 0)
SELECT CAST(quartile AS INTEGER) AS quartile, round(min(age_years), 6) AS min_years,
       round(max(age_years), 6) AS max_years, round(avg(o_totalprice), 6) AS avg_totalprice,
       count(*) AS order_count
FROM q GROUP BY quartile
"""

ORACLE["q09_compare_groups"] = f"""
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS avg_totalprice,
       round(avg(o_custkey), 6) AS avg_custkey, count(*) AS total_orders,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS finished_count,
       round({_share("o_orderstatus = 'F'")}, 6) AS finished_rate_pct
FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY o_orderpriority
"""


def _vs_overall(tab: str, key: str, value: str, hit: str, names: tuple[str, ...],
                limit: int | None) -> str:
    total, hits, rate, avg, ratio = names
    tail = f"ORDER BY CAST({hits} AS DOUBLE) / {total} DESC, {key} LIMIT {limit}" if limit else ""
    return f"""
WITH g AS (SELECT {key}, count(*) AS {total}, CAST(count_if({hit}) AS BIGINT) AS {hits},
                  avg({value}) AS {avg}
           FROM {tab} WHERE {key} IS NOT NULL GROUP BY {key}),
o AS (SELECT avg({value}) AS overall FROM {tab} WHERE {key} IS NOT NULL)
SELECT {key}, {total}, {hits}, round(CAST({hits} AS DOUBLE) / {total} * 100.0, 6) AS {rate},
       round({avg}, 6) AS {avg}, round({avg} / overall, 6) AS {ratio}
FROM g, o {tail}
"""


ORACLE["q10_compare_to_overall"] = _vs_overall(
    "events", "event_type", "value", "value > 20.0",
    ("total_events", "high_value_events", "high_value_rate_pct", "avg_value", "vs_overall_ratio"),
    5)

ORACLE["q11_quantile_success"] = f"""
WITH q AS (SELECT *, ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS price_quartile
           FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT CAST(price_quartile AS INTEGER) AS price_quartile, round(min(o_totalprice), 6) AS min_price,
       round(max(o_totalprice), 6) AS max_price, round(avg(o_totalprice), 6) AS avg_price,
       count(*) AS total_orders, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS finished_count,
       round({_share("o_orderstatus = 'F'")}, 6) AS finished_rate_pct
FROM q GROUP BY price_quartile
"""


def _vs_subgroup(tab: str, fine: tuple[str, str], coarse: str, measure: str, hit: str,
                 extra: tuple[str, str], names: tuple[str, ...]) -> str:
    a, b = fine
    count, measure_avg, rate, diff = names
    extra_name, extra_expr = extra
    return f"""
WITH src AS (SELECT * FROM {tab} WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
f AS (SELECT {a}, {b}, count(*) AS {count}, avg({extra_expr}) AS {extra_name},
             avg({measure}) AS {measure_avg}, count_if({hit}) AS hits
      FROM src GROUP BY {a}, {b}),
c AS (SELECT {coarse} AS ck, avg({measure}) AS coarse_avg FROM src GROUP BY {coarse})
SELECT {a}, {b}, {count}, round({extra_name}, 6) AS {extra_name},
       round({measure_avg}, 6) AS {measure_avg},
       round(CAST(hits AS DOUBLE) / {count} * 100.0, 6) AS {rate},
       round({measure_avg} - coarse_avg, 6) AS {diff}
FROM f JOIN c ON f.{coarse} = c.ck
"""


ORACLE["q12_compare_to_subgroup"] = _vs_subgroup(
    "lineitem", ("l_returnflag", "l_linestatus"), "l_linestatus", "l_discount",
    "l_quantity > 25.0", ("avg_price", "l_extendedprice"),
    ("line_count", "avg_discount", "big_qty_rate_pct", "discount_vs_status_avg"))

ORACLE["join_vs_overall"] = _vs_overall(
    "orders", "o_orderpriority", "o_totalprice", "o_orderstatus = 'F'",
    ("total_orders", "finished_count", "finished_rate_pct", "avg_totalprice", "vs_overall_ratio"),
    None)

ORACLE["join_vs_subgroup"] = _vs_subgroup(
    "part", ("p_type", "p_brand"), "p_type", "p_retailprice", "p_size > 25",
    ("avg_size", "p_size"), ("part_count", "avg_price", "large_rate_pct", "price_vs_type_avg"))

ORACLE["win_diff_from_group_mean"] = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, round(l_extendedprice, 6) AS l_extendedprice,
       round(avg(l_extendedprice) OVER w, 6) AS avg_group_price,
       round(l_extendedprice - avg(l_extendedprice) OVER w, 6) AS price_difference
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_linestatus)
"""

ORACLE["win_ntile_exact"] = """
SELECT o_orderkey, o_totalprice,
       CAST(ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS quartile
FROM orders
"""

ORACLE["win_ntile_ties"] = """
SELECT o_orderkey, o_orderdate,
       CAST(ntile(7) OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS septile
FROM orders
"""

ORACLE["agg_distinct"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM (SELECT DISTINCT {c} FROM lineitem)) AS n_distinct"
    for c in ("l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"))

ORACLE["agg_distinct_values"] = "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem"
