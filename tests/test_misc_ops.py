"""Sampling, comparisons, columns and metrics."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from riskframe.functions import columns as cols
from riskframe.ml.metrics import classification_metrics, regression_metrics
from riskframe.operators import compare, sampling, windows


def test_sampling_is_layout_independent(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {r.k for r in sampling.sample_rows(df.repartition(1), 0.1, ["k"]).collect()}
    b = {r.k for r in sampling.sample_rows(df.repartition(16), 0.1, ["k"]).collect()}
    assert a == b and 350 < len(a) < 650
    parts = [set(r.k for r in s.collect()) for s in sampling.split_rows(df, [0.7, 0.15, 0.15], ["k"])]
    assert sum(len(p) for p in parts) == 5000 and len(set().union(*parts)) == 5000
    rk1 = [r.k for r in sampling.random_k(df.repartition(3), 10, ["k"]).collect()]
    rk2 = [r.k for r in sampling.random_k(df.repartition(9), 10, ["k"]).collect()]
    assert rk1 == rk2 and len(rk1) == 10


def test_compare_to_subgroup_equals_join_form(spark):
    rows = [(f"v{i % 3}", f"g{i % 4}", float(i % 11) if i % 13 else None, i % 5 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "v string, g string, m double, h boolean")
    out = compare.compare_to_subgroup(df, ["v", "g"], ["g"], "m", F.col("h"))
    coarse = {r.g: r.a for r in df.groupBy("g").agg(F.avg("m").alias("a")).collect()}
    fine = {(r.v, r.g): r.a for r in df.groupBy("v", "g").agg(F.avg("m").alias("a")).collect()}
    for r in out.collect():
        assert r["measure_vs_coarse"] == pytest.approx(fine[(r.v, r.g)] - coarse[r.g], abs=1e-12)


def test_diff_from_group_mean_null_key_and_both_join_paths(spark):
    rows = [(None if i % 5 == 0 else f"s{i % 3}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, x double")
    small = windows.diff_from_group_mean(df, "s", "x")
    large = windows.diff_from_group_mean(df, "s", "x", max_broadcast_rows=1)   # shuffle-join path
    want = {}
    for s in {r[0] for r in rows}:
        xs = [x for k, x in rows if k == s]
        want[s] = sum(xs) / len(xs)
    for out in (small, large):
        got = out.collect()
        assert len(got) == 60
        for r in got:
            assert r["group_mean"] == pytest.approx(want[r["s"]])


def test_sanitize_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        cols.sanitize_names(df)


def test_safe_cast_missing_column_error(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError, match="b, c"):
        cols.safe_cast(df, ["a", "b", "c"])


def test_metrics_match_mllib(spark):
    rows = [(float(i % 2), float((i // 3) % 2), float(i), float(i) + (i % 7) - 3) for i in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double, y double, p double")
    mine = {r.metric: r.value for r in classification_metrics(df, "label", "prediction").collect()}
    for name in ("accuracy", "f1", "weightedPrecision", "weightedRecall"):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert mine[name] == pytest.approx(ev.evaluate(df), rel=1e-12)
    reg = {r.metric: r.value for r in regression_metrics(df, "y", "p").collect()}
    for name in ("rmse", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert reg[name] == pytest.approx(ev.evaluate(df), rel=1e-9)


def test_missing_regression_target_raises(spark):
    from riskframe.ml.features import FeatureSpec, add_labels
    df = spark.createDataFrame([(1.0, "Fully Paid")], "x double, status string")
    spec = FeatureSpec(numeric=["x"], status_column="status", negative_status="Fully Paid",
                       reg_target="fico_range_low")
    with pytest.raises(ValueError, match="fico_range_low"):
        add_labels(df, spec)


def test_gated_cast_equals_try_cast(spark):
    from riskframe.functions.exprs import try_number
    vals = ["12", " 12 ", "+1", "1.5", "1e3", "1.5d", "NaN", "-Infinity", "0x1p3", "0x10", "",
            "abc", "9999999999", ".5", "5.", "1,0", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    for t in ("int", "bigint", "double"):
        for r in df.select(F.col("v").try_cast(t).alias("a"), try_number("v", t).alias("b")).collect():
            assert (r.a == r.b) or (r.a != r.a and r.b != r.b)


def test_all_missing_feature_gets_zero_only(spark):
    from riskframe.ml.features import FeatureSpec, fit_preparation
    df = spark.createDataFrame([(1.0, None, 1.0), (3.0, None, 0.0), (None, None, 1.0)],
                               "a double, b double, label_class double")
    prep = fit_preparation(df, FeatureSpec(numeric=["a", "b"]), scale=False)
    assert prep.zero_filled == ["b"]
    rows = prep.transform(df).collect()
    assert [list(r["features"]) for r in rows] == [[1.0, 0.0], [3.0, 0.0], [2.0, 0.0]]
