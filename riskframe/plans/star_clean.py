"""Cleaning-operator bindings on a "dirty" line table derived from the star schema.

The star tables hold no NULLs, so missing values are planted by fixed rules
on whole tables (no row is dropped). Line numbers are uniform on 1..7 in
this data, so ``l_linenumber % 3 = 0`` gives a missing share of 2/7 (kept
under the 0.3 rule) and ``% 2 = 0`` gives 3/7 (dropped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean
from ..operators.joins import checked_broadcast
from ..session import stage_table
from .cleaning import CleaningSpec, clean_table
from .star import _r, query, table

DIRTY_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_discount END AS l_discount,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       l_tax,
       CASE WHEN l_linenumber = 2 THEN NULL WHEN l_returnflag = 'R' THEN 'Y'
            WHEN l_returnflag = 'A' THEN 'N' ELSE 'U' END AS return_flag,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linestatus END AS l_linestatus,
       CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 6 THEN 'NaN'
            ELSE concat(' ', CAST(l_linenumber * 12 AS VARCHAR), ' months') END AS term,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN '...'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_orderstatus,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
            ELSE o_totalprice END AS o_totalprice,
       o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def dirty_lines(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = checked_broadcast(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate"))
    ln = F.col("l_linenumber")
    null = F.lit(None)
    return (li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(ln % 3 == 0, null).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(ln % 2 == 0, null).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(ln == 7, null).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_tax",
        F.when(ln == 2, null).when(F.col("l_returnflag") == "R", "Y")
         .when(F.col("l_returnflag") == "A", "N").otherwise("U").alias("return_flag"),
        F.when(ln == 1, null).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
        F.when(ln == 5, null).when(ln == 6, "NaN")
         .otherwise(F.concat(F.lit(" "), (ln * 12).cast("string"), F.lit(" months"))).alias("term"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "...")
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", null)
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderstatus",
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), null)
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate"))


LINE_SPEC = CleaningSpec(
    initial_drop=["l_orderkey", "l_partkey"],
    mean_fill=["l_extendedprice"],
    required=["o_totalprice"],
    term_column="term",
    one_hot_column="l_linestatus",
    object_drop=["o_orderstatus", "o_orderdate"],
    text_columns=["o_orderpriority"],
    flag_columns=["return_flag"],
    redundant_drop=["l_suppkey"],
)


def staged_lines(spark, sf_dir) -> DataFrame:
    """``dirty_lines`` staged: a fit and its use read it twice, and the join is computed once."""
    return stage_table(dirty_lines(spark, sf_dir), "dirty_lines")


@query
def cln_null_profile(spark, sf_dir):
    return _r(clean.null_profile(dirty_lines(spark, sf_dir)))


@query
def cln_drop_sparse(spark, sf_dir):
    return _r(clean.drop_sparse_columns(staged_lines(spark, sf_dir)))


@query
def cln_fill_mean(spark, sf_dir):
    d = staged_lines(spark, sf_dir)
    out = clean.fill_mean(d, ["l_quantity", "l_extendedprice"])
    return _r(out.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))


@query
def cln_fill_mean_by_type(spark, sf_dir):
    d = staged_lines(spark, sf_dir)
    out = clean.fill_mean(d)
    return _r(out.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                         "l_extendedprice", "l_tax", "o_totalprice"))


@query
def cln_drop_null_rows(spark, sf_dir):
    d = dirty_lines(spark, sf_dir)
    out = clean.drop_null_rows(d, ["o_totalprice", "l_extendedprice"])
    return _r(out.select("l_orderkey", "l_linenumber", "o_totalprice", "l_extendedprice"))


@query
def cln_distinct_report(spark, sf_dir):
    d = dirty_lines(spark, sf_dir)
    return clean.null_row_report(d, ["o_totalprice"], ["o_totalprice", "l_linestatus", "term"])


@query
def cln_strip_to_int(spark, sf_dir):
    d = dirty_lines(spark, sf_dir)
    return clean.strip_to_int(d, "term").select("l_orderkey", "l_linenumber", "term")


@query
def cln_one_hot(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    c = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, F.lit(None))
                     .otherwise(F.col("c_mktsegment")))
    return clean.one_hot(c.select("c_custkey", "c_mktsegment"), "c_mktsegment")


@query
def cln_fill_text(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    p = p.withColumn("p_type", F.when(F.col("p_size") % 7 == 0, F.lit("..."))
                     .when(F.col("p_size") % 11 == 0, F.lit(None)).otherwise(F.col("p_type")))
    return clean.fill_text(p.select("p_partkey", "p_type"), ["p_type"])


@query
def cln_encode_flag(spark, sf_dir):
    d = dirty_lines(spark, sf_dir)
    return clean.encode_flag(d, ["return_flag"]).select("l_orderkey", "l_linenumber", "return_flag")


@query
def cln_full_clean(spark, sf_dir):
    out, _ = clean_table(staged_lines(spark, sf_dir), LINE_SPEC)
    return _r(out)


# --------------------------------------------------------------------------
# Oracle SQL (DuckDB) for the bindings above
# --------------------------------------------------------------------------

def _with(body: str) -> str:
    return f"WITH d AS ({DIRTY_SQL})" + ("" if body.lstrip().startswith(",") else "\n") + body


_DIRTY_TYPES = {
    "l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int",
    "l_quantity": "double", "l_discount": "double", "l_extendedprice": "double",
    "l_tax": "double", "return_flag": "text", "l_linestatus": "text", "term": "text",
    "o_orderpriority": "text", "o_orderstatus": "text", "o_totalprice": "double",
    "o_orderdate": "ts",
}


def _missing_sql(c: str, kind: str) -> str:
    if kind == "double":
        return f"({c} IS NULL OR isnan({c}))"
    if kind == "text":
        return f"({c} IS NULL OR {c} IN ('NaN'))"
    return f"{c} IS NULL"


def _round_cols(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if _DIRTY_TYPES.get(c) == "double" else c
                     for c in cols)


ORACLE_CLEAN: dict[str, str] = {}

ORACLE_CLEAN["cln_null_profile"] = _with(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({_missing_sql(c, k)}) AS BIGINT) AS missing, "
    f"count(*) AS total, round(CAST(count_if({_missing_sql(c, k)}) AS DOUBLE) / count(*), 6) "
    f"AS missing_share FROM d" for c, k in _DIRTY_TYPES.items()))

ORACLE_CLEAN["cln_drop_sparse"] = _with(
    f"SELECT {_round_cols([c for c in _DIRTY_TYPES if c != 'l_discount'])} FROM d")

ORACLE_CLEAN["cln_fill_mean"] = _with("""
, m AS (SELECT avg(l_quantity) AS mq, avg(l_extendedprice) AS mp FROM d)
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, mq), 6) AS l_quantity,
       round(coalesce(l_extendedprice, mp), 6) AS l_extendedprice FROM d, m
""".replace("\n, m AS", ", m AS", 1))

ORACLE_CLEAN["cln_fill_mean_by_type"] = _with("""
, m AS (SELECT avg(l_quantity) AS a1, avg(l_discount) AS a2, avg(l_extendedprice) AS a3,
               avg(l_tax) AS a4, avg(o_totalprice) AS a5 FROM d)
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, a1), 6) AS l_quantity,
       round(coalesce(l_discount, a2), 6) AS l_discount,
       round(coalesce(l_extendedprice, a3), 6) AS l_extendedprice,
       round(coalesce(l_tax, a4), 6) AS l_tax, round(coalesce(o_totalprice, a5), 6) AS o_totalprice
FROM d, m
""".replace("\n, m AS", ", m AS", 1))

ORACLE_CLEAN["cln_drop_null_rows"] = _with("""
SELECT l_orderkey, l_linenumber, round(o_totalprice, 6) AS o_totalprice,
       round(l_extendedprice, 6) AS l_extendedprice
FROM d WHERE o_totalprice IS NOT NULL AND l_extendedprice IS NOT NULL
""")

ORACLE_CLEAN["cln_distinct_report"] = _with(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM (SELECT DISTINCT {c} FROM d)) AS distinct_before, "
    f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM d WHERE o_totalprice IS NOT NULL)) AS distinct_after"
    for c in ("o_totalprice", "l_linestatus", "term")))

_TERM = "coalesce(TRY_CAST(trim(replace(term, ' months', '')) AS INTEGER), 36)"

ORACLE_CLEAN["cln_strip_to_int"] = _with(f"SELECT l_orderkey, l_linenumber, {_TERM} AS term FROM d")

_SEGMENTS = ("ANY", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

ORACLE_CLEAN["cln_one_hot"] = (
    "WITH c AS (SELECT c_custkey, coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL "
    "ELSE c_mktsegment END, 'ANY') AS seg FROM customer) SELECT c_custkey, "
    + ", ".join(f"CAST(seg = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in _SEGMENTS)
    + " FROM c")

ORACLE_CLEAN["cln_fill_text"] = """
SELECT p_partkey, CASE WHEN coalesce(t, 'any') IN ('...') THEN 'any' ELSE coalesce(t, 'any') END AS p_type
FROM (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '...' WHEN p_size % 11 = 0 THEN NULL
                             ELSE p_type END AS t FROM part)
"""

ORACLE_CLEAN["cln_encode_flag"] = _with(
    "SELECT l_orderkey, l_linenumber, CASE WHEN return_flag = 'Y' THEN 1 ELSE 0 END AS return_flag FROM d")

ORACLE_CLEAN["cln_full_clean"] = _with(f"""
, m1 AS (SELECT avg(l_extendedprice) AS m_price FROM d),
d2 AS (SELECT l_linenumber, l_quantity, coalesce(l_extendedprice, m_price) AS l_extendedprice,
              l_tax, return_flag, l_linestatus, term, o_orderpriority, o_totalprice
       FROM d, m1 WHERE o_totalprice IS NOT NULL),
m2 AS (SELECT avg(l_quantity) AS mq, avg(l_extendedprice) AS mp, avg(l_tax) AS mt,
              avg(o_totalprice) AS mo FROM d2)
SELECT l_linenumber, round(coalesce(l_quantity, mq), 6) AS l_quantity,
       round(coalesce(l_extendedprice, mp), 6) AS l_extendedprice,
       round(coalesce(l_tax, mt), 6) AS l_tax,
       CASE WHEN return_flag = 'Y' THEN 1 ELSE 0 END AS return_flag,
       {_TERM} AS term,
       CASE WHEN coalesce(o_orderpriority, 'any') IN ('...') THEN 'any'
            ELSE coalesce(o_orderpriority, 'any') END AS o_orderpriority,
       round(coalesce(o_totalprice, mo), 6) AS o_totalprice,
       CAST(coalesce(l_linestatus, 'ANY') = 'ANY' AS INTEGER) AS l_linestatus_ANY,
       CAST(coalesce(l_linestatus, 'ANY') = 'F' AS INTEGER) AS l_linestatus_F,
       CAST(coalesce(l_linestatus, 'ANY') = 'O' AS INTEGER) AS l_linestatus_O
FROM d2, m2
""".replace("\n, m1 AS", ", m1 AS", 1))
