"""Steps of the wide and iterative jobs that keep them in proportion to their input."""

import random
import threading

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.ml import suite
from riskframe.ml.features import FEATURES, LABEL_CLASS, LABEL_REG
from riskframe.ml.metrics import classification_metrics
from riskframe.plans import star_ml
from riskframe.session import wide_rows
from riskframe.sources.files import infer_types

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_wide_rows_restores_the_setting(spark):
    before = spark.conf.get(LIMIT)
    with pytest.raises(KeyError):
        with wide_rows(spark):
            assert spark.conf.get(LIMIT) == "8000"
            raise KeyError
    assert spark.conf.get(LIMIT) == before


def test_types_by_one_figure_a_column(spark, monkeypatch):
    """One aggregated value per column, and the types of texts that a quick pattern settles or not."""
    rows = [("12", "9999999999", "1.5", "nan", "2020-01-31", "true", "Individual", "10+ years", None, "2020-01-31 10:00:00", "7"),
            ("-3", "1", "2", "Inf", "2021-12-01", "FALSE", "N", "5%", None, "2020-01-31T10:00:00.5", "2147483648"),
            (None, None, "1.0E7", ".5", None, None, "", "1", None, None, "99999999999999999999")]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(11)))
    seen, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: seen.append(len(e)) or agg(self, *e))
    assert infer_types(df) == {"c0": "int", "c1": "bigint", "c2": "double", "c3": "double", "c4": "date", "c5": "boolean",
                               "c9": "timestamp", "c10": "double"}
    assert seen == [11]


def test_forests_keep_each_rows_node(spark):
    """The forests look up a row's node instead of walking every tree from its root, and are the same forests."""
    rng = random.Random(5)
    rows = [(Vectors.dense([rng.random() for _ in range(4)]), float(rng.random() < 0.4), rng.random() * 9) for _ in range(300)]
    df = spark.createDataFrame(rows, [FEATURES, LABEL_CLASS, LABEL_REG])
    for task in (suite.CLASSIFICATION, suite.REGRESSION):
        forest = suite.model_catalog(task)["rf"][1]
        assert forest.getCacheNodeIds()
        small = forest.copy({forest.numTrees: 4, forest.maxDepth: 4})
        plain = small.copy({small.cacheNodeIds: False})
        assert small.fit(df).toDebugString.split("\n", 1)[1] == plain.fit(df).toDebugString.split("\n", 1)[1]


def test_fits_read_as_many_rows_on_every_core(spark, monkeypatch):
    """The joined rows come in one partition more than there are cores, of unequal sizes; the fits read equal ones, with every row."""
    cores = spark.sparkContext.defaultParallelism
    key = F.col("o_orderkey")
    rows = spark.range(0, 4000 * (cores + 1), 1, cores + 1).withColumnRenamed("id", "o_orderkey").filter(
        (key < 4000 * cores) | (key % 4000 < 30)).select(
        key, F.lit("F").alias("o_orderstatus"), (key * 1.5).alias("o_totalprice"),
        *[(key % 7).cast("double").alias(c) for c in star_ml.NUMERIC])
    monkeypatch.setattr(star_ml, "order_table", lambda *_: rows)
    staged = star_ml.labelled_rows(spark, "", staged=True)
    sizes = [r["count"] for r in staged.groupBy(F.spark_partition_id()).count().collect()]
    assert staged.rdd.getNumPartitions() == len(sizes) == cores
    assert max(sizes) - min(sizes) <= cores + 1
    assert sorted(r["o_orderkey"] for r in staged.select("o_orderkey").collect()) == [
        k for k in range(4000 * (cores + 1)) if k < 4000 * cores or k % 4000 < 30]


def test_kept_predictions_are_those_of_the_metrics(spark):
    """Kept predictions are stored, so further figures do not score the rows again, and give the metrics of an ordinary run."""
    rng = random.Random(6)
    rows = [(Vectors.dense([rng.random() for _ in range(3)]), float(rng.random() < 0.4), rng.random() * 9) for _ in range(200)]
    df = spark.createDataFrame(rows, [FEATURES, LABEL_CLASS, LABEL_REG])
    for task, label in ((suite.CLASSIFICATION, LABEL_CLASS), (suite.REGRESSION, LABEL_REG)):
        plain = suite.train_and_evaluate(task, "lr", {"train": df, "test": df.limit(50)})
        kept = suite.train_and_evaluate(task, "lr", {"train": df, "test": df.limit(50)}, keep_scored=True)
        assert plain.scored == {} and list(kept.scored) == ["train", "test"]
        assert kept.metrics == [(s, m, pytest.approx(v)) for s, m, v in plain.metrics]
        for split, n in (("train", 200), ("test", 50)):
            scored = kept.scored[split]
            assert scored.is_cached and scored.columns == [label, "prediction"] and scored.count() == n
            scored.unpersist()


def test_predictions_are_made_once_for_the_metrics(spark):
    """Classification metrics ask for each row's prediction once, and count classes never predicted, never seen, or missing."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def predict(p):
        made.add(1)
        return p

    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (1.0, 3.0), (None, 1.0), (1.0, None), (None, None)]
    df = spark.createDataFrame(rows, "label_class double, p double").withColumn("prediction", predict("p"))
    got = {r["metric"]: r["value"] for r in classification_metrics(df).collect()}
    assert made.value == len(rows)
    # class 0: precision 1/2, recall 1/2, 2 rows; class 1: 2/4, 2/4, 4 rows; class 2 and the missing one: 0
    assert got == {"accuracy": pytest.approx(3 / 9), "weightedRecall": pytest.approx(3 / 9),
                   "weightedPrecision": pytest.approx((2 * 0.5 + 4 * 0.5) / 9), "f1": pytest.approx((2 * 0.5 + 4 * 0.5) / 9)}


def test_models_with_many_rows_a_core_are_fitted_one_at_a_time(spark, monkeypatch):
    """Side by side only while the training rows a core are few; the results are the same."""
    rng = random.Random(7)
    rows = [(Vectors.dense([rng.random() for _ in range(3)]), float(rng.random() < 0.4), rng.random() * 9) for _ in range(200)]
    df = spark.createDataFrame(rows, [FEATURES, LABEL_CLASS, LABEL_REG])
    fitted, fit = [], suite.train_and_evaluate
    monkeypatch.setattr(suite, "train_and_evaluate", lambda *a, **k: fitted.append(threading.current_thread()) or fit(*a, **k))

    def run():
        fitted.clear()
        table, _ = suite.train_suite(spark, {"train": df, "test": df.limit(50)}, models="lr", side_by_side=2)
        return sorted(map(tuple, table.drop("duration_s").collect())), threading.main_thread() in fitted

    few, in_line = run()
    assert not in_line and len(fitted) == 2
    monkeypatch.setattr(suite, "BESIDE_ROWS", 10, raising=False)
    many, in_line = run()
    assert in_line and len(fitted) == 2 and few == many
