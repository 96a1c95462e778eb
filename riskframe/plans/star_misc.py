"""Projection, predicate, scalar-function, sort and sampling bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as cols
from ..functions.exprs import age_years, parse_month
from ..operators import measures, sampling
from .star import _r, query, table

# A multiplicative hash both engines compute identically in 64-bit integers
# (the key is reduced mod 2^31 first, so the product cannot overflow), used
# as the uniform column of the sampling bindings so SQL can check them.
# The library default is xxhash64 of the key (riskframe.functions.exprs.unit_hash).
_MULT, _MOD = 2654435761, 4294967296
UNIFORM_SQL = f"(CAST(((o_orderkey % 2147483648) * {_MULT}) % {_MOD} AS DOUBLE) / {float(_MOD)})"


def _uniform(key="o_orderkey"):
    k = F.pmod(F.col(key).cast("long"), F.lit(2147483648))
    return F.pmod(k * F.lit(_MULT), F.lit(_MOD)).cast("double") / F.lit(float(_MOD))


ORACLE_MISC: dict[str, str] = {}


@query
def prj_safe_cast(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    src = e.select(
        "event_id",
        F.when(F.col("event_type") == "click", F.concat(F.col("value").cast("string"), F.lit("%")))
         .otherwise(F.col("value").cast("string")).alias("value_num"),
        F.regexp_extract("props", "[0-9]+", 0).alias("k_num"),
        F.col("props").alias("props_num"))
    return _r(cols.safe_cast(src, ["value_num", "k_num", "props_num"], "double", strip_chars="%"))


ORACLE_MISC["prj_safe_cast"] = """
SELECT event_id,
       round(TRY_CAST(replace(CASE WHEN event_type = 'click' THEN CAST(value AS VARCHAR) || '%'
                                   ELSE CAST(value AS VARCHAR) END, '%', '') AS DOUBLE), 6) AS value_num,
       round(TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE), 6) AS k_num,
       round(TRY_CAST(replace(props, '%', '') AS DOUBLE), 6) AS props_num
FROM events
"""


@query
def prj_drop_columns(spark, sf_dir):
    return _r(cols.drop_columns(table(spark, sf_dir, "part"), ["p_name", "p_not_there"]))


ORACLE_MISC["prj_drop_columns"] = """
SELECT p_partkey, p_brand, p_type, p_size, round(p_retailprice, 6) AS p_retailprice FROM part
"""


@query
def prj_sanitize_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" order key "), F.col("o_totalprice").alias("total.price"),
        F.col("o_orderpriority").alias("order-priority"), F.col("o_custkey").alias("cust+key"))
    return _r(cols.sanitize_names(o))


ORACLE_MISC["prj_sanitize_names"] = """
SELECT o_orderkey AS order_key, round(o_totalprice, 6) AS totalprice,
       o_orderpriority AS order_priority, o_custkey AS cust_plus_key FROM orders
"""


@query
def prj_unpivot_metrics(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    wide = measures.group_profile(o, ["o_orderpriority"], {
        "avg_totalprice": F.avg("o_totalprice"),
        "avg_custkey": F.avg("o_custkey"),
        "finished_share": F.avg((F.col("o_orderstatus") == "F").cast("double"))})
    long = wide.unpivot(["o_orderpriority"], ["avg_totalprice", "avg_custkey", "finished_share"],
                        "metric", "value")
    return _r(long)


ORACLE_MISC["prj_unpivot_metrics"] = """
WITH w AS (SELECT o_orderpriority, avg(o_totalprice) AS avg_totalprice, avg(o_custkey) AS avg_custkey,
                  avg(CAST(o_orderstatus = 'F' AS DOUBLE)) AS finished_share
           FROM orders GROUP BY o_orderpriority)
SELECT o_orderpriority, 'avg_totalprice' AS metric, round(avg_totalprice, 6) AS value FROM w
UNION ALL SELECT o_orderpriority, 'avg_custkey', round(avg_custkey, 6) FROM w
UNION ALL SELECT o_orderpriority, 'finished_share', round(finished_share, 6) FROM w
"""


@query
def flt_predicates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pred = (((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 10.0)
             & (F.col("l_discount") < 0.08) & (F.col("l_tax") >= 0.01)
             & F.col("l_linestatus").isin("F", "O") & F.col("l_shipdate").isNotNull())
            | F.col("l_extendedprice").isNull())
    return _r(li.filter(pred).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"))


ORACLE_MISC["flt_predicates"] = """
SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity, round(l_tax, 6) AS l_tax
FROM lineitem
WHERE (l_returnflag = 'R' AND l_quantity > 10.0 AND l_discount < 0.08 AND l_tax >= 0.01
       AND l_linestatus IN ('F', 'O') AND l_shipdate IS NOT NULL) OR l_extendedprice IS NULL
"""


@query
def fn_scalar(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    month = parse_month(F.date_format("o_orderdate", "MMM-yyyy"), "MMM-yyyy")
    out = o.select(
        "o_orderkey",
        F.regexp_replace("o_orderpriority", "-", " ").alias("priority_text"),
        month.alias("order_month"),
        age_years(month, F.lit("1990-01-01").cast("date")).alias("age_years"),
        F.col("o_totalprice").cast("string").try_cast("double").alias("price_num"),
        F.col("o_custkey").cast("int").alias("cust_int"),
        ((F.col("o_totalprice") - 1000.0) * 2.0 / 3.0).alias("scaled_price"),
        F.col("o_orderpriority").isNull().alias("priority_missing"),
        F.col("o_orderstatus").isin("F", "O").alias("status_known"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
         .otherwise(0).alias("status_code"))
    return _r(out)


ORACLE_MISC["fn_scalar"] = """
SELECT o_orderkey, replace(o_orderpriority, '-', ' ') AS priority_text,
       CAST(strptime(strftime(o_orderdate, '%b-%Y'), '%b-%Y') AS DATE) AS order_month,
       round(CAST(datediff('month', DATE '1990-01-01',
                           CAST(strptime(strftime(o_orderdate, '%b-%Y'), '%b-%Y') AS DATE)) AS DOUBLE) / 12.0, 6)
           AS age_years,
       round(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE), 6) AS price_num,
       CAST(o_custkey AS INTEGER) AS cust_int,
       round((o_totalprice - 1000.0) * 2.0 / 3.0, 6) AS scaled_price,
       o_orderpriority IS NULL AS priority_missing,
       o_orderstatus IN ('F', 'O') AS status_known,
       CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS status_code
FROM orders
"""


@query
def srt_top_k(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return (o.select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(10))


ORACLE_MISC["srt_top_k"] = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
"""


@query
def srt_random_k(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.random_k(o, 10, keys=["o_orderkey"], by=_uniform())


ORACLE_MISC["srt_random_k"] = f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY {UNIFORM_SQL}, o_orderkey LIMIT 10
"""


@query
def smp_sample(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_rows(o, 0.1, by=_uniform())


ORACLE_MISC["smp_sample"] = f"SELECT o_orderkey, o_totalprice FROM orders WHERE {UNIFORM_SQL} < 0.1"


_WEIGHTS = [0.7, 0.15, 0.15]


@query
def smp_split_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    label = sampling.split_label(_WEIGHTS, by=_uniform())
    return o.groupBy(label.alias("split")).agg(F.count(F.lit(1)).alias("rows"))


ORACLE_MISC["smp_split_counts"] = "SELECT split, count(*) AS rows FROM (SELECT CASE " + " ".join(
    f"WHEN {UNIFORM_SQL} >= {lo!r} AND {UNIFORM_SQL} < {hi!r} THEN {i}"
    for i, (lo, hi) in enumerate(sampling.split_bounds(_WEIGHTS))) + " END AS split FROM orders) GROUP BY split"


@query
def smp_hash_sample(spark, sf_dir):
    """Library default: xxhash64 of the key (no SQL twin; rows-only)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_rows(o, 0.1, keys=["o_orderkey"], seed=42)
