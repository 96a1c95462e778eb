"""Exact n-tile and quantiles against Spark's own window ntile / percentile."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.operators import ntile


def _window_ntile(df, order, n, tie):
    w = Window.orderBy(F.col(order).asc_nulls_first(), F.col(tie))
    return {r[tie]: r["t"] for r in df.withColumn("t", F.ntile(n).over(w)).collect()}


def _ours(df, order, n, tie, **kw):
    out = ntile.ntile_exact(df, order, n, [tie], alias="t", **kw)
    return {r[tie]: r["t"] for r in out.collect()}


def _make(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, x double")


CASES = {
    "uniform": [random.Random(1).random() * 100 for _ in range(997)],
    "few_distinct": [float(random.Random(2).randint(0, 5)) for _ in range(1000)],
    "heavy_third": [5.0 if i % 3 == 0 else float(i) for i in range(900)],
    "heavy_90pct": [7.0 if i % 10 else float(i) for i in range(1000)],
    "nulls_and_nan": [None if i % 7 == 0 else (math.nan if i % 11 == 0 else float(i % 50))
                      for i in range(700)],
    "constant": [3.0] * 300,
    "all_null": [None] * 50,
    "fewer_than_n": [1.0, 2.0],
    "equal_to_n": [4.0, 3.0, 2.0, 1.0],
}


@pytest.mark.parametrize("name", list(CASES))
@pytest.mark.parametrize("n", [4, 7])
def test_ntile_matches_window(spark, name, n):
    df = _make(spark, CASES[name]).repartition(5)
    # tiny accuracy and collect limit force several refinement rounds
    got = _ours(df, "x", n, "id", accuracy=50, collect_limit=8)
    assert got == _window_ntile(df, "x", n, "id")


def test_ntile_default_settings(spark):
    df = _make(spark, CASES["few_distinct"])
    assert _ours(df, "x", 4, "id") == _window_ntile(df, "x", 4, "id")


def test_ntile_empty(spark):
    df = spark.createDataFrame([], "id long, x double")
    out = ntile.ntile_exact(df, "x", 4, ["id"], alias="t")
    assert out.count() == 0 and "t" in out.columns


def test_ntile_dates_and_ints(spark):
    rows = [(i, i % 13, f"2020-01-{1 + i % 28:02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k int, d string").withColumn("d", F.to_date("d"))
    assert _ours(df, "k", 4, "id", accuracy=40, collect_limit=4) == _window_ntile(df, "k", 4, "id")
    assert _ours(df, "d", 5, "id", accuracy=40, collect_limit=4) == _window_ntile(df, "d", 5, "id")


def test_ntile_partitioning_independent(spark):
    df = _make(spark, CASES["heavy_third"])
    a = _ours(df.repartition(1), "x", 4, "id", accuracy=50, collect_limit=8)
    b = _ours(df.repartition(16), "x", 4, "id", accuracy=50, collect_limit=8)
    assert a == b


def test_tile_boundaries():
    assert ntile.tile_boundaries(10, 4) == [3, 6, 8]
    assert ntile.tile_boundaries(2, 4) == [1]
    assert ntile.tile_boundaries(0, 4) == []


def test_exact_quantiles_match_percentile(spark):
    vals = [random.Random(3).gauss(0, 10) for _ in range(1001)] + [None, math.nan]
    df = _make(spark, vals)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = ntile.exact_quantiles(df, "x", probs, accuracy=50, collect_limit=8)
    clean = df.filter(F.col("x").isNotNull() & ~F.isnan("x"))
    want = clean.agg(F.percentile("x", probs).alias("p")).collect()[0]["p"]
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_quantile_profile_counts(spark):
    df = _make(spark, CASES["heavy_third"])
    prof = ntile.quantile_profile(df, "x", 4, ["id"], {"n": F.count(F.lit(1))}).collect()
    assert [r["n"] for r in prof] == [225, 225, 225, 225]


def test_ntile_timestamp_ntz_across_dst_fold(spark):
    # wall-clock times inside a "fall back" hour must keep their order
    rows = [(i, f"2021-11-07 01:{i % 60:02d}:{i % 7:02d}") for i in range(240)]
    df = spark.createDataFrame(rows, "id long, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = _ours(df, "t", 4, "id", accuracy=40, collect_limit=4)
        assert got == _window_ntile(df, "t", 4, "id")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_VALUE = st.one_of(st.none(), st.just(math.nan), st.integers(-3, 3).map(float),
                   st.floats(-1e6, 1e6, allow_nan=False))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(_VALUE, min_size=1, max_size=300), n=st.integers(1, 9))
def test_ntile_random_inputs(spark, values, n):
    df = _make(spark, values).repartition(3)
    assert _ours(df, "x", n, "id", accuracy=30, collect_limit=4) == _window_ntile(df, "x", n, "id")
