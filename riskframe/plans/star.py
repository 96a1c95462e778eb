"""Bindings of every operator to the driver's star-schema tables.

Each binding takes ``(spark, sf_dir)``, reads whole tables from
``{sf_dir}/{name}.parquet`` and returns a DataFrame. The DuckDB SQL computing
the same result is in ``star_sql`` for this module and in the ``ORACLE_*``
maps of the other ``star_*`` modules (gathered by ``bindings``). Computed doubles are rounded
on both sides (6 places; money sums 2 places) so that the two engines hash
equal despite different summation orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..functions.exprs import age_years
from ..operators import compare, measures, ntile, windows
from ..operators.joins import checked_broadcast

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    """The whole table ``name`` of a scale-factor folder (str or path)."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _r(df: DataFrame, money: tuple[str, ...] = ()) -> DataFrame:
    """Round computed doubles: 6 places, money sums 2 places."""
    out = round_doubles(df, 6)
    return out.withColumns({m: F.round(F.col(m), 2) for m in money}) if money else out


# --------------------------------------------------------------------------
# §2.11 business questions, bound to the star schema
# --------------------------------------------------------------------------

@query
def q01_conditional_mean(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pred = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 1000.0)
    return _r(measures.conditional_mean(c, pred, "c_acctbal", alias="avg_acctbal"))


@query
def q02_conditional_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pred = (F.col("l_quantity") > 45.0) & (F.col("l_returnflag") == "R")
    return measures.conditional_count(li, pred, alias="count")


@query
def q03_conditional_share(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return _r(measures.conditional_share(li, F.col("l_discount") < 0.03,
                                         F.col("l_returnflag") == "R", alias="rate_pct"))


@query
def q04_group_profile(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    # customer grows with the data: broadcast only while its checked size is small
    c = checked_broadcast(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    # nation is a fixed-size dimension; its size is still checked before broadcasting.
    n = checked_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    fact = (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    out = measures.group_profile(
        fact, ["n_name"],
        {"avg_acctbal": F.avg("c_acctbal"), "total_price": F.sum("o_totalprice")},
        order_by=[F.col("total_price").desc()])
    return _r(out, money=("total_price",))


@query
def q05_top_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    out = measures.top_groups(p, "p_brand", {"avg_price": F.avg("p_retailprice"),
                                              "num_parts": F.count(F.lit(1))},
                              by="num_parts", k=10)
    return _r(out)


@query
def q06_diff_from_group_mean(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    out = windows.diff_from_group_mean(
        c, "c_nationkey", "c_acctbal", mean_alias="avg_nation_acctbal",
        diff_alias="acctbal_difference", columns=["c_custkey", "c_nationkey", "c_acctbal"])
    return _r(out)


@query
def q07_rate_by_group(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    p = checked_broadcast(table(spark, sf_dir, "part").select("p_partkey", "p_brand"))
    fact = li.join(p, li.l_partkey == p.p_partkey)
    out = measures.rate_by_group(
        fact, "p_brand", base=F.col("l_returnflag").isin("R", "A"),
        hit=F.col("l_returnflag") == "R", min_n=10, k=10,
        total_alias="total_loans", hit_alias="charged_off_count", rate_alias="default_rate_pct")
    return _r(out)


def _order_age(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    age = age_years(F.trunc(F.to_date("o_orderdate"), "MM"), F.lit("1990-01-01").cast("date"))
    return o.withColumn("age_years", age).filter(F.col("age_years") >= 0)


@query
def q08_age_quantile_profile(spark, sf_dir):
    o = _order_age(spark, sf_dir)
    out = ntile.quantile_profile(
        o, "age_years", 4, ["o_orderkey"],
        {"min_years": F.min("age_years"), "max_years": F.max("age_years"),
         "avg_totalprice": F.avg("o_totalprice"), "order_count": F.count(F.lit(1))},
        tile_alias="quartile")
    return _r(out)


@query
def q09_compare_groups(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    out = measures.compare_groups(
        o, "o_orderpriority", ["1-URGENT", "5-LOW"],
        {"avg_totalprice": F.avg("o_totalprice"), "avg_custkey": F.avg("o_custkey")},
        hit=F.col("o_orderstatus") == "F", total_alias="total_orders",
        hit_alias="finished_count", rate_alias="finished_rate_pct")
    return _r(out)


@query
def q10_compare_to_overall(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    out = compare.compare_to_overall(
        e, "event_type", "value", F.col("value") > 20.0, k=5,
        total_alias="total_events", hit_alias="high_value_events",
        rate_alias="high_value_rate_pct", avg_alias="avg_value", ratio_alias="vs_overall_ratio")
    return _r(out)


@query
def q11_quantile_success(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
    out = ntile.quantile_profile(
        o, "o_totalprice", 4, ["o_orderkey"],
        {"min_price": F.min("o_totalprice"), "max_price": F.max("o_totalprice"),
         "avg_price": F.avg("o_totalprice"), "total_orders": F.count(F.lit(1)),
         "finished_count": F.count_if(F.col("o_orderstatus") == "F")},
        tile_alias="price_quartile")
    out = out.withColumn("finished_rate_pct",
                         F.try_divide(F.col("finished_count").cast("double"),
                                      F.col("total_orders")) * 100.0)
    return _r(out)


@query
def q12_compare_to_subgroup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = compare.compare_to_subgroup(
        li, ["l_returnflag", "l_linestatus"], ["l_linestatus"], "l_discount",
        hit=F.col("l_quantity") > 25.0, aggs={"avg_price": F.avg("l_extendedprice")},
        count_alias="line_count", measure_alias="avg_discount", rate_alias="big_qty_rate_pct",
        diff_alias="discount_vs_status_avg")
    return _r(out)


# --------------------------------------------------------------------------
# §2.4 joins, §2.6 windows, §2.5 distinct
# --------------------------------------------------------------------------

@query
def join_vs_overall(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    out = compare.compare_to_overall(
        o, "o_orderpriority", "o_totalprice", F.col("o_orderstatus") == "F", k=None,
        total_alias="total_orders", hit_alias="finished_count", rate_alias="finished_rate_pct",
        avg_alias="avg_totalprice", ratio_alias="vs_overall_ratio")
    return _r(out)


@query
def join_vs_subgroup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    out = compare.compare_to_subgroup(
        p, ["p_type", "p_brand"], ["p_type"], "p_retailprice", hit=F.col("p_size") > 25,
        aggs={"avg_size": F.avg("p_size")}, count_alias="part_count",
        measure_alias="avg_price", rate_alias="large_rate_pct", diff_alias="price_vs_type_avg")
    return _r(out)


@query
def win_diff_from_group_mean(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = windows.diff_from_group_mean(
        li, ["l_returnflag", "l_linestatus"], "l_extendedprice", mean_alias="avg_group_price",
        diff_alias="price_difference",
        columns=["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice"])
    return _r(out)


@query
def win_ntile_exact(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ntile.ntile_exact(o, "o_totalprice", 4, ["o_orderkey"], alias="quartile")


@query
def win_ntile_ties(spark, sf_dir):
    # o_orderdate repeats (a few thousand days): boundaries fall inside tie runs
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ntile.ntile_exact(o, "o_orderdate", 7, ["o_orderkey"], alias="septile")


@query
def agg_distinct(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return measures.distinct_counts(li, ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"])


@query
def agg_distinct_values(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return measures.distinct_values(li, ["l_returnflag", "l_linestatus"])
