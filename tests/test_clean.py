"""Cleaning operators and the cleaning chain on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.plans.cleaning import CleaningSpec, clean_table
from riskframe.presets import loans
from tests.loan_rows import loan, loan_table


def test_sparse_threshold_is_strict(spark):
    # 10 rows: a has 3 missing (0.30, kept), b has 4 (0.40, dropped), c has 'NaN' text
    rows = [(None if i < 3 else 1.0, None if i < 4 else "x", "NaN" if i < 4 else "y", i)
            for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b string, c string, d int")
    assert sorted(clean.sparse_columns(df)) == ["b", "c"]
    prof = {r["column"]: r["missing"] for r in clean.null_profile(df).collect()}
    assert prof == {"a": 3, "b": 4, "c": 4, "d": 0}


def test_missing_on_int_column_does_not_raise(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert clean.null_profile(df).collect()[0]["missing"] == 1


def test_fill_mean_nan_int_and_all_null(spark):
    df = spark.createDataFrame([(1.0, 2, None), (math.nan, 3, None), (None, None, None)],
                               "x double, k int, z double")
    out = clean.fill_mean(df, ["x", "k", "z"]).collect()
    assert [r["x"] for r in out] == [1.0, 1.0, 1.0]          # NaN ignored in mean, and filled
    assert [r["k"] for r in out] == [2.0, 3.0, 2.5]          # int filled as double, not truncated
    assert [r["z"] for r in out] == [None, None, None]       # all-NULL column left alone


def test_strip_to_int_and_flags_and_text(spark):
    df = spark.createDataFrame([(" 36 months", "Y", None), (" 60 months", "N", "..."),
                                (None, None, "car"), ("bad", "y", "x")], "term string, f string, t string")
    out = clean.encode_flag(clean.fill_text(clean.strip_to_int(df, "term"), ["t"]), ["f"]).collect()
    assert [r["term"] for r in out] == [36, 60, 36, 36]
    assert [r["f"] for r in out] == [1, 0, 0, 0]
    assert [r["t"] for r in out] == ["any", "any", "car", "x"]


def test_one_hot_sorted_with_fill(spark):
    df = spark.createDataFrame([("RENT",), (None,), ("OWN",), ("RENT",)], "h string")
    out = clean.one_hot(df, "h")
    assert out.columns == ["h_ANY", "h_OWN", "h_RENT"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 1), (1, 0, 0), (0, 1, 0), (0, 0, 1)]


def test_one_hot_category_bound(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("h"))
    with pytest.raises(ValueError):
        clean.one_hot(df, "h", max_categories=10)


def test_distinct_report_counts_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (2.0,)], "x double")
    rep = clean.distinct_report(df, clean.drop_null_rows(df, ["x"]), ["x"]).collect()[0]
    assert (rep["distinct_before"], rep["distinct_after"]) == (3, 2)


def test_clean_chain_order(spark):
    # means of the named column use all rows; the other means use rows kept
    df = spark.createDataFrame(
        [(None, 1.0, 10.0, " 36 months", "OWN", "...", "Y"),
         (4.0, None, 20.0, None, None, None, None),
         (8.0, 3.0, None, " 60 months", "RENT", "car", "N")],
        "amt double, req double, other double, term string, home string, title string, flag string")
    spec = CleaningSpec(mean_fill=["amt"], required=["req"], term_column="term",
                        one_hot_column="home", text_columns=["title"], flag_columns=["flag"],
                        sparse_threshold=0.5)
    out, facts = clean_table(df, spec)
    rows = out.collect()
    assert facts.named_means["amt"] == pytest.approx(6.0)
    assert [r["amt"] for r in rows] == [6.0, 8.0]
    assert facts.float_means["other"] == pytest.approx(10.0)
    assert [r["other"] for r in rows] == [10.0, 10.0]
    assert [r["term"] for r in rows] == [36, 60]
    assert facts.one_hot_categories == ["OWN", "RENT"]
    assert [r["title"] for r in rows] == ["any", "car"]
    assert [r["flag"] for r in rows] == [1, 0]


def test_clean_loans_preset_runs(spark):
    rows = [loan(i) for i in range(30)]
    raw = loan_table(spark, rows)
    typed = raw.withColumns({c: F.col(c).try_cast("double") for c in loans.ML_NUMERIC[:3]})
    out, facts = loans.clean_loans(typed)
    assert "id" not in out.columns and "addr_state" not in out.columns
    assert any(c.startswith("home_ownership_") for c in out.columns)
    assert out.count() == 30
