"""Bounds, dirty input and contracts of the operators: measured broadcasts, no category cap, n-tile ties, infinities."""

import pytest
from pyspark.sql import functions as F

from riskframe.ml import features as feat
from riskframe.ml import suite
from riskframe.operators import clean, distribution, joins, ntile
from riskframe.plans.cleaning import CleaningSpec, clean_table
from riskframe.presets import loans
from riskframe.session import materialize, remove_staged, scratch_path, stage_table
from riskframe.sources import files
from tests.loan_rows import loan, loan_table
from tests.test_plans import plan


def test_broadcast_check_measures_bytes(spark):
    wide = spark.range(200).withColumn("t", F.repeat(F.lit("x"), 5000))
    assert joins.fits_broadcast(wide, max_bytes=2_000_000)
    assert not joins.fits_broadcast(wide, max_bytes=500_000)          # 1 MB of text
    assert "broadcast" not in joins.checked_broadcast(wide, max_bytes=500_000)._jdf.queryExecution().logical().toString().lower()
    assert not joins.fits_broadcast(spark.range(50), max_rows=49)


def test_broadcast_check_moves_no_rows(spark):
    df = spark.range(0, 100_000, 1, 8).withColumn("t", F.col("id").cast("string"))
    p = plan(df.agg(F.count(F.lit(1)), F.sum(joins.row_bytes(df))))
    assert "GlobalLimit" not in p and "partial_count" in p


def test_many_categories(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("c"), F.lit(1.0).alias("x"))
    assert len(clean.one_hot(df, "c").columns) == 1501
    _, facts = clean_table(df, CleaningSpec(one_hot_column="c"))
    assert len(facts.one_hot_categories) == 1500
    with pytest.raises(ValueError):
        clean.categories(df, "c", max_categories=1000)


def test_null_row_report_equals_two_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1.0, None), (3, 2.0, "a"), (4, None, None)], "k int, x double, t string")
    one = sorted(map(tuple, clean.null_row_report(df, ["x"], ["x", "t"]).collect()))
    two = sorted(map(tuple, clean.distinct_report(df, clean.drop_null_rows(df, ["x"]), ["x", "t"]).collect()))
    assert one == two


def test_ntile_refuses_ambiguous_ties(spark):
    rows = spark.createDataFrame([(float(i // 6), i // 3) for i in range(12)], "x double, k long")
    with pytest.raises(ValueError, match="tie_break"):
        ntile.ntile_exact(rows, "x", 5, ["k"]).collect()


@pytest.mark.parametrize("n", [3, 4, 7])
def test_ntile_null_ties_come_first(spark, n):
    from pyspark.sql import Window
    rows = [(float(i % 4), None if i == 8 else i, None if i % 5 == 0 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, k long, y double")
    got = {(r["k"], r["y"]): r["t"] for r in ntile.ntile_exact(df, "x", n, ["y", "k"], alias="t", collect_limit=20).collect()}
    w = Window.orderBy("x", "y", "k")
    want = {(r["k"], r["y"]): r["t"] for r in df.withColumn("t", F.ntile(n).over(w)).collect()}
    assert got == want


def test_quantile_gather_does_not_grow_with_columns(spark, monkeypatch):
    sent = []
    real = ntile._collect_small

    def counted(df, targets):
        sent.append(sum(t.within for t in targets))
        return real(df, targets)

    monkeypatch.setattr(ntile, "_collect_small", counted)
    df = spark.range(5000).select(*[((F.col("id") * (7 + i)) % 4999).cast("double").alias(f"c{i}") for i in range(30)])
    few = ntile.exact_quantiles(df, ["c0", "c1", "c2"], [0.25, 0.5, 0.75], collect_limit=600)
    small, sent[:] = sum(sent), []
    many = ntile.exact_quantiles(df, df.columns, [0.25, 0.5, 0.75], collect_limit=600)
    assert many[:3] == few and small <= 600 and sum(sent) <= 600


def test_repeated_and_missing_loan_ids(spark):
    rows = [loan(i, id=None if i % 3 == 0 else "7", open_acc=str(i % 2)) for i in range(48)]
    df = loans.prepare_loans(loan_table(spark, rows))
    assert [r["total_loans"] for r in loans.q11(df).collect()] == [8, 8, 8, 8]
    assert sum(r["loan_count"] for r in loans.q08(df).collect()) == 48


def test_dirty_text_does_not_raise(spark):
    df = spark.createDataFrame([("1.5",), ("bad",), (None,), ("NaN",), ("2.5",)], "x string")
    r = distribution.describe_table(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"]) == (2, 2.0, 1.5, 2.5)
    assert clean.column_means(df, ["x"]) == {"x": 2.0}
    assert sorted(x["x"] for x in clean.fill_mean(df, ["x"]).collect()) == [1.5, 2.0, 2.0, 2.0, 2.5]


def test_histogram_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(inf,), (inf,), (-inf,)], "x double")
    got = {r["bin"]: (r["lower"], r["upper"], r["count"]) for r in distribution.histogram(df, ["x"], bins=3).collect()}
    assert got == {-1: (-inf, -inf, 1), 0: (0.0, 3.0, 3), 1: (3.0, 6.0, 3), 2: (6.0, 9.0, 4), 3: (inf, inf, 2)}


def test_percent_text_reaches_the_features(spark):
    df = spark.createDataFrame([("Fully Paid", "13.99%", "700"), ("Charged Off", "7", "650")],
                               "loan_status string, int_rate string, fico_range_low string")
    assert [r["int_rate"] for r in loans.ml_table(df).collect()] == [13.99, 7.0]


def test_placeholders_by_column(spark):
    df = spark.createDataFrame([("...", "...")], "purpose string, title string")
    assert tuple(clean.fill_text(df, ["purpose", "title"], placeholders={"title": ("...",)}).first()) == ("...", "any")


def test_all_missing_feature_without_a_failed_fit(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    assert sorted(map(tuple, feat.impute_mean(df, ["a", "b"]).collect())) == [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0)]


def test_feature_importance_mismatch_raises(spark):
    class Model:
        class coefficients:
            @staticmethod
            def toArray():
                import numpy as np
                return np.array([1.0, -2.0])

    with pytest.raises(ValueError, match="2 features"):
        suite.feature_importance(spark, Model(), ["a"])
    assert [r["feature"] for r in suite.feature_importance(spark, Model(), ["a", "b"]).collect()] == ["b", "a"]


def test_single_csv_has_no_row_bound(spark):
    path = scratch_path(spark, "single")
    files.write_single_csv(spark.range(20_000).repartition(7), path)
    assert spark.read.option("header", "true").csv(path).count() == 20_000


def test_staged_tables_can_be_removed(spark):
    df = stage_table(spark.range(10), "gone")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert stage_table(spark.range(0), "none", partition_by=None).count() == 0
    assert remove_staged(spark, path.replace("file:///", "file:/"))
    with pytest.raises(ValueError):
        remove_staged(spark, "/root/testdata")
    assert materialize(spark.range(3)).count() == 3


def test_loan_summaries(spark):
    df = loans.prepare_loans(loan_table(spark, [loan(i) for i in range(40)]))
    got = loans.loan_summaries(df.withColumn("installment", F.lit(5.0)))
    assert {r["column"] for r in got["boxes"].collect()} == {"loan_amnt", "int_rate", "installment"}
    assert got["histograms"].count() == 90 and got["box_first"].count() == 1
