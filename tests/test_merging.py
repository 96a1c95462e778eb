"""Mergeable summaries, facts per file, regression from moments, and fits side by side."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from riskframe.ml import moments, suite
from riskframe.operators import measures, sketches
from riskframe.plans import incremental
from riskframe.plans.cleaning import CleaningSpec, fit_cleaning
from tests.test_plans import plan


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(1)
    rows = [(i % 7, rng.choice([None, float("nan"), rng.gauss(5, 30), float(rng.randrange(9))]), f"t{rng.randrange(3000)}" if i % 5 else None)
            for i in range(6_000)]
    return spark.createDataFrame(rows, "part int, v double, t string").repartition(6).cache()


def test_quantile_sketches_merge(numbers):
    parts = sketches.quantile_sketches(numbers, ["v"], ["part"])
    assert parts.count() == 7
    got = sketches.sketched_quantiles(sketches.merge_quantiles(parts), [0.0, 0.1, 0.5, 0.9, 1.0]).collect()
    v = np.sort([r["v"] for r in numbers.where("v is not null and not isnan(v)").collect()])
    for r in got:
        below, upto = np.searchsorted(v, r["value"], "left") / len(v), np.searchsorted(v, r["value"], "right") / len(v)
        assert r["n"] == len(v) and below - r["rank_error"] <= r["q"] <= upto + r["rank_error"] < 1.1
    none = sketches.sketched_quantiles(sketches.quantile_sketches(numbers.limit(0), ["v"]), [0.5]).first()
    assert none["n"] == 0 and none["value"] is None


def test_distinct_sketches_merge_without_expand(numbers):
    columns = ["part", "t", "v"]
    parts = sketches.distinct_sketches(numbers, columns, ["part"])
    assert "Expand" not in plan(parts) and "Expand" in plan(measures.distinct_counts(numbers, columns))
    exact = {r["column"]: r["n_distinct"] for r in measures.distinct_counts(numbers, columns).collect()}
    for r in sketches.sketched_distinct(sketches.merge_distinct(parts)).collect():
        assert abs(r["n_distinct"] - exact[r["column"]]) <= r["relative_error"] * exact[r["column"]] + 0.5
    report = {r["column"]: r for r in sketches.sketched_row_report(numbers, F.col("part") < 2, ["part", "t"]).collect()}
    assert tuple(report["part"]) == ("part", 7, 2, 5)
    assert abs(report["t"]["distinct_before"] - report["t"]["distinct_after"] - report["t"]["distinct_lost"]) <= 60


@pytest.mark.parametrize("skewed", [True, False])
@pytest.mark.parametrize("counters", [8, 64, 10_000])
def test_bounded_top_groups(spark, skewed, counters):
    rng = random.Random(counters)
    keys = [int(rng.paretovariate(0.7)) % 5_000 if skewed else rng.randrange(400) for _ in range(8_000)]
    df = spark.createDataFrame([(k if k != 3 else None, k % 11) for k in keys], "k int, v int").repartition(5)
    aggs = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    want = [tuple(r) for r in measures.top_groups(df, "k", aggs, "n", 4).collect()]
    assert [tuple(r) for r in sketches.top_groups_bounded(df, "k", aggs, "n", 4, counters).collect()] == want
    held = sketches.key_counters(df, "k", counters)
    assert held.count() <= 5 * (counters + 1)
    true = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    off = held.agg(F.sum("off")).first()[0]
    for r in held.where("key is not null").groupBy("key").agg(F.sum("low").alias("low")).collect():
        assert r["low"] <= true[r["key"]] <= r["low"] + off
    assert sketches.top_groups_bounded(df.limit(0), "k", aggs, "n", 4, counters).count() == 0


@pytest.mark.parametrize("fine", [64, 4_096])
def test_histograms_merge(spark, fine):
    rng = random.Random(fine)
    values = [rng.choice([rng.gauss(0, 1), rng.uniform(-1e6, 1e6), 1e300, -1e-300, 0.0, 7.0]) for _ in range(500)]
    small = [rng.uniform(10, 11) for _ in range(500)]
    rows = [(a, b, 2.5, None) for a, b in zip(values, small)] + [(float("inf"), float("nan"), 2.5, None), (None, float("-inf"), 2.5, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    parts = sketches.histogram_parts(df, ["a", "b", "c", "d"], fine)
    assert plan(parts).count("Scan ExistingRDD") <= 2
    got = sketches.merge_histograms(parts, 32).collect()
    for c, x in (("a", values), ("b", small), ("c", [2.5] * 502)):
        bins = sorted((r["lower"], r["upper"], r["count"]) for r in got if r["column"] == c and r["lower"] != r["upper"])
        width = {u - lo for lo, u, _ in bins}
        assert len(width) == 1 and math.frexp(width.pop())[0] == 0.5 and len(bins) <= 32
        assert all(n == sum(lo <= v < u for v in x) for lo, u, n in bins) and sum(n for *_, n in bins) == len(x)
    ends = {(r["column"], r["lower"], r["count"]) for r in got if r["lower"] == r["upper"]}
    assert ends == {("a", float("inf"), 1), ("b", float("-inf"), 1)} and not any(r["column"] == "d" for r in got)


SPEC = CleaningSpec(required=["need"], mean_fill=["whole"], one_hot_column="kind", sparse_threshold=0.3)


def loans_like(spark, n, seed):
    rng = random.Random(seed)
    some = lambda v, p: None if rng.random() < p else v
    rows = [(some(rng.randrange(100), 0.1), some(rng.gauss(1e6, 1), 0.2), some(float(rng.randrange(9)), 0.15), some(rng.choice("xyz"), 0.1),
             some(1.0, 0.6), float("nan") if rng.random() < 0.1 else rng.random()) for _ in range(n)]
    return spark.createDataFrame(rows, "whole int, big double, need double, kind string, sparse double, holes double")


def test_facts_of_files_merge_to_those_of_the_union(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    for batch in range(3):
        loans_like(spark, 300, batch).coalesce(2).write.mode("append").parquet(f"{tmp_dir}/data")
        df = spark.read.parquet(f"{tmp_dir}/data")
        before = set(r["part"] for r in incremental.stored(spark, store).select("part").distinct().collect())
        new = incremental.refresh(spark, store, df.inputFiles(), SPEC)
        assert set(new) == set(df.inputFiles()) - before and new
        assert incremental.refresh(spark, store, df.inputFiles(), SPEC) == []
        rows = incremental.stored(spark, store)
        for r in incremental.merge_facts(rows).collect():
            c = r["column"]
            x = df.select(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("x")) if c != "kind" else df.select(F.lit(None).cast("double").alias("x"))
            e = x.agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("v"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
            assert (r["total"], r["n"], r["min"], r["max"]) == (300 * (batch + 1), e["n"], e["lo"], e["hi"])
            if e["n"]:
                assert r["mean"] == pytest.approx(e["mean"], rel=1e-9) and r["m2"] / r["n"] == pytest.approx(e["v"], rel=1e-9)
        got, want = incremental.facts_from(rows, SPEC, df), fit_cleaning(df, SPEC)
        assert (got.dropped_sparse, got.one_hot_categories) == (want.dropped_sparse, want.one_hot_categories) == (["sparse"], ["ANY", "x", "y", "z"])
        assert got.named_means == pytest.approx(want.named_means) and got.float_means == pytest.approx(want.float_means)
    with pytest.raises(ValueError):
        incremental.facts_from(rows, CleaningSpec(required=["sparse"], sparse_threshold=0.3), df)


def test_moments_equal_mllib(spark):
    rng = random.Random(4)
    rows = [(rng.gauss(0, 1), rng.gauss(1e4, 50), float(rng.randrange(3)), 1.0, rng.gauss(0, 1) if i % 9 else None) for i in range(800)]
    df = spark.createDataFrame(rows, "a double, b double, c double, one double, e double").withColumn(
        "y", 3 * F.col("a") - F.col("b") / 7 + F.col("c") + F.coalesce("e", F.lit(0.0)))
    names = ["a", "b", "c", "e"]
    m = moments.moments(df, [*names, "one", "y"])
    assert m.n == 711
    full = df.dropna()
    for some in (["a"], ["a", "b"], names):
        fit = moments.fit_linear(m, "y", some)
        lib = LinearRegression(labelCol="y").fit(VectorAssembler(inputCols=some, outputCol="features").transform(full))
        assert np.allclose(fit.coefficients, lib.coefficients.toArray(), rtol=1e-6) and fit.intercept == pytest.approx(lib.intercept, rel=1e-6, abs=1e-6)
        assert fit.r2 == pytest.approx(lib.summary.r2, abs=1e-6)
        gap = full.select((fit.predict(full) - F.col("y")).alias("g")).agg(F.sqrt(F.avg(F.col("g") * F.col("g")))).first()[0]
        assert gap == pytest.approx(fit.rmse, rel=1e-5, abs=1e-6)
    flat = moments.fit_linear(m, "y", ["a", "one"])
    assert flat.coefficients[1] == 0 and flat.coefficients[0] == pytest.approx(moments.fit_linear(m, "y", ["a"]).coefficients[0])
    with pytest.raises(ValueError):
        moments.fit_linear(moments.moments(df.limit(0), ["a", "y"]), "y")


def test_models_side_by_side(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select(
        "features", (F.col("a") > 0).cast("double").alias("label_class"), (F.col("a") * 2 + F.col("b")).alias("label_reg"))
    splits = dict(zip(suite.SPLITS, df.randomSplit([0.6, 0.2, 0.2], 1)))
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    fit = suite.train_and_evaluate

    def watched(*args):
        jobs.append(("start", args[1]))
        out = fit(*args)
        jobs.append(("end", args[1]))
        return out
    suite.train_and_evaluate = watched
    try:
        some = dict(tasks="classification", models=["lr", "rf"])
        one, a = suite.train_suite(spark, splits, **some)
        assert [k for k, _ in jobs] == ["start", "end", "start", "end"]
        jobs.clear()
        both, b = suite.train_suite(spark, splits, **some, side_by_side=2)
        assert [k for k, _ in jobs][:2] == ["start", "start"]      # they overlap
    finally:
        suite.train_and_evaluate = fit
    assert [r.key for r in a] == [r.key for r in b] == ["lr", "rf"] and not tracker.getActiveJobsIds()
    assert [tuple(r) for r in one.drop("duration_s").collect()] == [tuple(r) for r in both.drop("duration_s").collect()]
    broken = {k: v.withColumnRenamed("label_class", "gone") for k, v in splits.items()}
    with pytest.raises(Exception, match="label_class"):
        suite.train_suite(spark, broken, **some, side_by_side=2)
