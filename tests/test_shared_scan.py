"""Fused aggregates: the same answers as one scan per question, from one scan."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import shared
from riskframe.presets import loans
from tests.loan_rows import loan_table, standard_rows
from tests.test_plans import plan


def table(spark, rows=400, seed=3):
    rng = random.Random(seed)
    some = [(rng.choice(["a", "b", None, "c"]), rng.choice(["x", "y", None]), rng.choice([None, 1.0, 2.5, -3.0]), rng.randrange(5)) for _ in range(rows)]
    return spark.createDataFrame(some, "g string, h string, v double, n int")


def test_equals_separate_aggregates(spark):
    df = table(spark)
    got = shared.shared_groups(df, {
        "all": shared.Request([], {"m": shared.mean_of("v", F.col("n") > 2), "k": shared.rows_where(F.col("v") > 0)}, F.col("g") == "a"),
        "none": shared.Request([], {"m": shared.mean_of("v"), "s": shared.sum_of("v"), "k": shared.rows_where()}, F.col("n") > 99),
        "by_g": shared.Request(["g"], {"s": shared.sum_of("v"), "k": shared.rows_where(F.col("n") == 0)}, F.col("h") == "x"),
        "by_gh": shared.Request(["g", "h"], {"m": shared.mean_of("v")}, drop_null_keys=True),
        "by_h": shared.Request(["h"], {"m": shared.mean_of(F.col("v") * 2)}),
        "by_n": shared.Request(["n"], {"k": shared.rows_where()}, F.col("n") < 2)})

    def same(name, want):
        assert got[name].columns == want.columns
        left, right = (sorted(map(str, x.select([F.round(c, 9) if t == "double" else F.col(c) for c, t in x.dtypes]).collect())) for x in (got[name], want))
        assert left == right

    a = df.where("g = 'a'")
    same("all", a.agg(F.avg(F.when(F.col("n") > 2, F.col("v"))).alias("m"), F.count_if(F.col("v") > 0).alias("k")))
    same("none", df.where("n > 99").agg(F.avg("v").alias("m"), F.sum("v").alias("s"), F.count(F.lit(1)).alias("k")))
    same("by_g", df.where("h = 'x'").groupBy("g").agg(F.sum("v").alias("s"), F.count_if(F.col("n") == 0).alias("k")))
    same("by_gh", df.where("g is not null and h is not null").groupBy("g", "h").agg(F.avg("v").alias("m")))
    same("by_h", df.groupBy("h").agg(F.avg(F.col("v") * 2).alias("m")))
    same("by_n", df.where("n < 2").groupBy("n").agg(F.count(F.lit(1)).alias("k")))


def test_no_rows_and_no_keys(spark):
    df = table(spark, 5).limit(0)
    got = shared.shared_groups(df, {"all": shared.Request([], {"k": shared.rows_where(), "m": shared.mean_of("v")}),
                                    "by": shared.Request(["g"], {"k": shared.rows_where()})})
    assert [tuple(r) for r in got["all"].collect()] == [(0, None)] and got["by"].count() == 0
    alone = shared.shared_groups(df, {"all": shared.Request([], {"k": shared.rows_where()})})
    assert [tuple(r) for r in alone["all"].collect()] == [(0,)]


def test_grouping_sets_leave_out_coarser_ones():
    r = {n: shared.Request(k, {}) for n, k in {"a": [], "b": ["x"], "c": ["y", "x"], "d": ["z"]}.items()}
    assert shared.grouping_sets(r) == [("x", "y"), ("z",)]


def test_nine_questions_scan_once(spark, tmp_dir):
    loan_table(spark, standard_rows()).write.parquet(f"{tmp_dir}/loans")
    df = loans.prepare_loans(spark.read.parquet(f"{tmp_dir}/loans"))
    requests = loans._shared_requests()
    assert {"q01", "q02", "q03", "q04", "q05", "q07", "q09", "q10", "q12"} <= set(requests)
    fused, _ = shared.fused_groups(df, requests, shared.grouping_sets(requests))
    assert plan(fused).count("Scan parquet") == 2       # the tree and its details name the one scan
    answers = loans.shared_answers(df)
    for n in requests:
        assert ("Scan parquet" in plan(answers[n])) == (n == "q06")


@pytest.mark.parametrize("name", [f"q{i:02}" for i in range(1, 13)])
def test_shared_answers_equal_the_questions(spark, name):
    df = loans.prepare_loans(loan_table(spark, standard_rows()))
    want, got = loans.QUESTIONS.answer(name, df), loans.shared_answers(df, [name])[name]
    assert got.columns == want.columns

    def rows(x):
        return sorted(str(r) for r in x.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in x.dtypes]).collect())
    assert rows(got) == rows(want)
