"""The three loan jobs end to end on hand-made rows: questions, cleaning, ML."""

import pytest
from pyspark.sql import functions as F

from riskframe.ml import features as feat
from riskframe.ml import suite
from riskframe.operators.sampling import split_rows
from riskframe.presets import loans
from riskframe.session import materialize, scratch_path, sizing_conf, stage_table
from riskframe.sources import files
from tests.loan_rows import loan, loan_table, standard_rows


@pytest.fixture(scope="module")
def csv_path(spark):
    rows = standard_rows(150)
    rows[3]["desc"] = 'multi\nline, "quoted" text'
    for i, r in enumerate(rows):
        # missing shares stay under the 30 % sparse rule (one row in four)
        r.update({"term": [" 36 months", " 60 months", " 36 months", None][i % 4],
                  "hardship_flag": ["N", "Y", "N", None][i % 4], "debt_settlement_flag": "N",
                  "installment": str(100 + i), "revol_util": str(i % 90), "total_acc": str(5 + i % 30),
                  "fico_range_high": str(604 + 10 * (i % 10)), "title": ["...", "Car", "Home", None][i % 4],
                  "funded_amnt": str(1000 * (i % 9 + 1)), "funded_amnt_inv": str(1000 * (i % 9 + 1))})
    path = scratch_path(spark, "loans_csv")
    files.write_table(loan_table(spark, rows).repartition(3), path, fmt="csv")
    return path


def test_questions_from_csv(spark, csv_path):
    raw = loans.read_loans(spark, csv_path)
    assert raw.columns == loans.LOAN_COLUMNS and raw.count() == 150
    assert raw.filter(F.col("id") == "1003").collect()[0]["desc"] == 'multi\nline, "quoted" text'
    answers = loans.QUESTIONS.run(loans.prepare_loans(raw))
    assert set(answers) == {f"q{i:02d}" for i in range(1, 13)}
    for name, df in answers.items():
        assert df.count() >= 1, name


def test_relabel_by_position(spark, csv_path):
    raw = loans.read_loans(spark, csv_path, relabel=True)
    stats = {r["column"]: r for r in loans.numeric_stats(raw).collect()}      # text as read
    assert set(stats) == set(loans.STATS_COLUMNS)
    assert stats["loan_amnt"]["count"] == 150


def test_cleaning_then_ml(spark, csv_path):
    typed = files.read_typed(spark, csv_path, infer=True)
    cleaned, facts = loans.clean_loans(typed)
    assert "home_ownership" not in cleaned.columns
    assert {"home_ownership_MORTGAGE", "home_ownership_OWN", "home_ownership_RENT"} <= set(cleaned.columns)
    assert cleaned.select("term").distinct().count() <= 2
    assert cleaned.filter(F.col("title") == "...").count() == 0
    rows = feat.add_labels(feat.select_rows(cleaned, loans.LOAN_ML), loans.LOAN_ML)
    train, val, test = split_rows(rows, [0.7, 0.15, 0.15], keys=["loan_amnt", "installment"])
    prep = feat.fit_preparation(train, loans.LOAN_ML)
    assert prep.feature_names[:2] == ["int_rate", "loan_amnt"]
    splits = {"train": prep.transform(train), "validation": prep.transform(val), "test": prep.transform(test)}
    res = suite.train_and_evaluate(suite.CLASSIFICATION, "lr", splits)
    assert {m for _, m, _ in res.metrics} == {"accuracy", "f1", "weightedPrecision", "weightedRecall"}
    imp = suite.feature_importance(spark, res.model, prep.feature_names).collect()
    assert 0 < len(imp) <= 10


def test_session_helpers(spark):
    conf = sizing_conf(100 * 10**12, 8000)
    n = int(conf["spark.sql.shuffle.partitions"])
    assert 100 * 10**12 / n <= 512 * 1024 * 1024
    assert sizing_conf(100 * 10**12, 8000, max_shuffle_partitions=1000)["spark.sql.shuffle.partitions"] == "1000"
    df = spark.range(100)
    assert materialize(df).count() == 100
    assert stage_table(df, "t").count() == 100
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_three_jobs(spark, csv_path):
    out = scratch_path(spark, "cleaned")
    facts = loans.cleaning_job(spark, csv_path, out)
    assert facts.one_hot_categories
    answers = loans.questions_job(spark, csv_path, ["q01", "q07"])
    assert set(answers) == {"q01", "q07"}
    for df in answers.values():                 # the text was read once, at ingest
        assert "csv" not in df._jdf.queryExecution().toString().lower()
    metrics, importance, models = loans.ml_job(spark, spark.read.parquet(out), tasks="classification", models="lr",
                                               fit_on="all", save_to=scratch_path(spark, "models"))
    assert list(models) == list(importance)
    with pytest.raises(ValueError, match="unknown model"):
        loans.ml_job(spark, spark.read.parquet(out), models="nope")
    with pytest.raises(ValueError, match="no finished loans"):
        loans.ml_job(spark, spark.read.parquet(out).limit(0))
    got = {(r["split"], r["metric"]) for r in metrics.collect()}
    assert ("test", "accuracy") in got and len(got) == 12
    assert list(importance) == ["classification/Logistic Regression"]
