"""MLlib bindings on an order-level table derived from the star schema.

Rows: every order joined with its customer and its line aggregates. The
finished outcome is the order status ('F' counts as paid, label 0.0); the
regression target is the order's total price. Customer balances are blanked
for one customer in ten so that imputation has work to do.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import features as feat
from ..ml import suite
from ..ml.metrics import classification_metrics, regression_metrics
from ..operators import clean
from ..operators.joins import checked_broadcast
from ..operators.sampling import split_rows
from ..session import scratch_path, stage_table
from ..sources.files import read_typed, write_table
from ..sources.models import load_model, save_model
from .star import _r, query, table
from .star_misc import UNIFORM_SQL
from .star_misc import _uniform as uniform

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
NUMERIC = ["c_acctbal", "order_year", "priority_rank", "n_lines", "sum_quantity", "avg_discount"]
SPEC = feat.FeatureSpec(numeric=NUMERIC, indicator_pattern="^segment_",
                        status_column="o_orderstatus", keep_status=("F", "O", "P"),
                        negative_status="F", reg_target="o_totalprice")
ORACLE_ML: dict[str, str] = {}


def order_table(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = checked_broadcast(table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment"))
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_quantity"),
                  F.avg("l_discount").alias("avg_discount")))
    t = (o.join(c, o.o_custkey == c.c_custkey)
         .join(lines, o.o_orderkey == lines.l_orderkey, "left")
         .select("o_orderkey", "o_orderstatus", "o_totalprice",
                 F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("c_acctbal"))
                  .alias("c_acctbal"),
                 F.year("o_orderdate").alias("order_year"),
                 F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_rank"),
                 "n_lines", "sum_quantity", "avg_discount",
                 F.col("c_mktsegment").alias("segment")))
    return clean.one_hot(t, "segment", fill=None, cats=SEGMENTS)


_ORDER_SQL = """
WITH lines AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_quantity,
                      avg(l_discount) AS avg_discount FROM lineitem GROUP BY l_orderkey),
t AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
             CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
             CAST(year(o_orderdate) AS DOUBLE) AS order_year,
             CAST(TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS DOUBLE) AS priority_rank,
             CAST(n_lines AS DOUBLE) AS n_lines, sum_quantity, avg_discount, c_mktsegment
      FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey
      WHERE o_orderstatus IN ('F', 'O', 'P'))
"""


def labelled_rows(spark, sf_dir, staged=False):
    rows = feat.add_labels(feat.select_rows(order_table(spark, sf_dir), SPEC), SPEC)
    # the fits below scan their input several times: compute the joins once, and give every core as many rows
    return stage_table(rows, "ml_rows", even=True) if staged else rows


@query
def ml_impute(spark, sf_dir):
    rows = stage_table(feat.select_rows(order_table(spark, sf_dir), SPEC), "ml_impute_rows")
    return _r(feat.impute_mean(rows, NUMERIC).select("o_orderkey", *NUMERIC))


ORACLE_ML["ml_impute"] = _ORDER_SQL + "SELECT o_orderkey, " + ", ".join(
    f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {c}" for c in NUMERIC) + " FROM t"


@query
def ml_labels(spark, sf_dir):
    return _r(labelled_rows(spark, sf_dir).select("o_orderkey", feat.LABEL_CLASS, feat.LABEL_REG))


ORACLE_ML["ml_labels"] = _ORDER_SQL + """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE 1.0 END AS label_class,
       round(o_totalprice, 6) AS label_reg
FROM t WHERE o_totalprice IS NOT NULL
"""

_VECTOR = NUMERIC + [f"segment_{s}" for s in SEGMENTS]


@query
def ml_standardize(spark, sf_dir):
    rows = labelled_rows(spark, sf_dir, staged=True)
    prep = feat.fit_preparation(rows, SPEC)          # fitted on all rows, so SQL can check it
    out = prep.transform(rows, keep=["o_orderkey"])
    arr = vector_to_array(F.col(feat.FEATURES))
    return _r(out.select("o_orderkey", *[arr[i].alias(f"z_{n}")
                                         for i, n in enumerate(prep.feature_names)]))


ORACLE_ML["ml_standardize"] = _ORDER_SQL + """
, imp AS (SELECT o_orderkey, """ + ", ".join(
    f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in NUMERIC) + ", " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS DOUBLE) AS segment_{s}" for s in SEGMENTS) + """
          FROM t WHERE o_totalprice IS NOT NULL)
SELECT o_orderkey, """ + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS z_{c}" for c in _VECTOR) + " FROM imp"


def _rule_predictions(spark, sf_dir):
    rows = labelled_rows(spark, sf_dir)
    return rows.select(
        feat.LABEL_CLASS, feat.LABEL_REG,
        F.when(F.col("priority_rank") <= 2, 1.0).otherwise(0.0).alias("cls_pred"),
        (F.coalesce(F.col("sum_quantity"), F.lit(0.0)) * 1500.0).alias("reg_pred"))


@query
def ml_classification_metrics(spark, sf_dir):
    p = _rule_predictions(spark, sf_dir)
    return _r(classification_metrics(p, feat.LABEL_CLASS, "cls_pred"))


ORACLE_ML["ml_classification_metrics"] = _ORDER_SQL + """
, p AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE 1.0 END AS y,
               CASE WHEN priority_rank <= 2 THEN 1.0 ELSE 0.0 END AS p
        FROM t WHERE o_totalprice IS NOT NULL),
conf AS (SELECT y, p, count(*) AS n FROM p GROUP BY y, p),
by_y AS (SELECT y, sum(n) AS n_y, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM conf GROUP BY y),
by_p AS (SELECT p AS c, sum(n) AS n_p FROM conf GROUP BY p),
cls AS (SELECT CAST(n_y AS DOUBLE) AS n_y, CAST(tp AS DOUBLE) AS tp,
               coalesce(CAST(tp AS DOUBLE) / n_p, 0.0) AS prec, CAST(tp AS DOUBLE) / n_y AS rec
        FROM by_y LEFT JOIN by_p ON y = c)
SELECT 'accuracy' AS metric, round(sum(tp) / sum(n_y), 6) AS value FROM cls
UNION ALL SELECT 'f1', round(sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2.0 * prec * rec / (prec + rec) END
                                 * n_y) / sum(n_y), 6) FROM cls
UNION ALL SELECT 'weightedPrecision', round(sum(prec * n_y) / sum(n_y), 6) FROM cls
UNION ALL SELECT 'weightedRecall', round(sum(rec * n_y) / sum(n_y), 6) FROM cls
"""


@query
def ml_regression_metrics(spark, sf_dir):
    p = _rule_predictions(spark, sf_dir)
    return _r(regression_metrics(p, feat.LABEL_REG, "reg_pred"))


ORACLE_ML["ml_regression_metrics"] = _ORDER_SQL + """
, p AS (SELECT o_totalprice AS y, coalesce(sum_quantity, 0.0) * 1500.0 AS p
        FROM t WHERE o_totalprice IS NOT NULL)
SELECT 'rmse' AS metric, round(sqrt(avg((y - p) * (y - p))), 6) AS value FROM p
UNION ALL SELECT 'r2', round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) FROM p
"""


def prepared_splits(spark, sf_dir, keep=()):
    rows = labelled_rows(spark, sf_dir, staged=True)
    # split by the arithmetic uniform column, so that SQL can count the same splits
    train, val, test = split_rows(rows, [0.7, 0.15, 0.15], by=uniform())
    prep = feat.fit_preparation(train, SPEC)
    return ({"train": prep.transform(train, keep), "validation": prep.transform(val, keep),
             "test": prep.transform(test, keep)}, prep)


_EVALUATORS = {
    suite.CLASSIFICATION: (MulticlassClassificationEvaluator, feat.LABEL_CLASS),
    suite.REGRESSION: (RegressionEvaluator, feat.LABEL_REG),
}


def _model_query(task, key):
    def run(spark, sf_dir):
        splits, _ = prepared_splits(spark, sf_dir)
        res = suite.train_and_evaluate(task, key, splits, keep_scored=True)
        evaluator, label = _EVALUATORS[task]
        rows = []
        for split, scored in res.scored.items():
            agree = all(math.isclose(v, evaluator(labelCol=label, metricName=m).evaluate(scored), rel_tol=1e-6, abs_tol=1e-6)
                        for s, m, v in res.metrics if s == split)
            rows.append((split, scored.count(), agree, all(math.isfinite(v) for s, _, v in res.metrics if s == split)))
            scored.unpersist()
        return spark.createDataFrame(rows, "split string, n_rows long, metrics_agree boolean, metrics_finite boolean")
    run.__name__ = f"ml_{'cls' if task == suite.CLASSIFICATION else 'reg'}_{key}"
    run.__doc__ = f"Train {task} model '{key}' on the 70% split; rows of all splits, and our metrics against MLlib's evaluators."
    ORACLE_ML[run.__name__] = _SPLIT_SQL
    return query(run)


_SPLIT_SQL = _ORDER_SQL + f"""
, s AS (SELECT {UNIFORM_SQL} AS u FROM t WHERE o_totalprice IS NOT NULL)
SELECT split, count(*) AS n_rows, TRUE AS metrics_agree, TRUE AS metrics_finite
FROM (SELECT CASE WHEN u < CAST(0.7 AS DOUBLE) THEN 'train' WHEN u < CAST(0.85 AS DOUBLE) THEN 'validation'
                  ELSE 'test' END AS split FROM s) GROUP BY split
"""

for _task in (suite.CLASSIFICATION, suite.REGRESSION):
    for _key in ("lr", "rf", "gbt"):
        _model_query(_task, _key)


@query
def ml_feature_importance(spark, sf_dir):
    splits, prep = prepared_splits(spark, sf_dir)
    res = suite.train_and_evaluate(suite.CLASSIFICATION, "rf", {"train": splits["train"]})
    top = suite.feature_importance(spark, res.model, prep.feature_names, top=10)
    path = scratch_path(spark, "ml_importance_csv")          # saved as a CSV table, read back
    write_table(top, path, fmt="csv")
    back = read_typed(spark, path, schema="feature STRING, importance DOUBLE")
    known = F.col("feature").isin(prep.feature_names)
    return back.agg(F.count(F.lit(1)).alias("n_features"), F.count_if(known).alias("n_known"),
                    F.countDistinct("feature").alias("n_distinct"), (F.sum("importance") <= 1 + 1e-9).alias("within_one"),
                    (F.min("importance") >= 0).alias("none_negative"))


ORACLE_ML["ml_feature_importance"] = """
SELECT 10 AS n_features, 10 AS n_known, 10 AS n_distinct, TRUE AS within_one, TRUE AS none_negative
"""


@query
def ml_model_roundtrip(spark, sf_dir):
    splits, _ = prepared_splits(spark, sf_dir, keep=["o_orderkey"])
    res = suite.train_and_evaluate(suite.CLASSIFICATION, "lr", {"train": splits["train"]})
    path = save_model(res.model, scratch_path(spark, "ml_model_lr"))
    loaded = load_model(LogisticRegressionModel, path)
    mine = res.model.transform(splits["test"]).withColumnRenamed("prediction", "mine").drop("rawPrediction", "probability")
    both = loaded.transform(mine)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("mine") != F.col("prediction")).alias("n_different"))


ORACLE_ML["ml_model_roundtrip"] = _ORDER_SQL + f"""
SELECT count(*) AS n_rows, 0 AS n_different FROM t
WHERE o_totalprice IS NOT NULL AND {UNIFORM_SQL} >= CAST(0.85 AS DOUBLE)
"""


def plausible(metrics):
    """A suite's metrics table with each value replaced by whether it is possible: shares in [0, 1], r2 at most 1."""
    v = F.col("value")
    ok = F.when(F.col("task") == suite.CLASSIFICATION, (v >= 0) & (v <= 1)).when(F.col("metric") == "r2", v <= 1).otherwise(v >= 0)
    return metrics.select("task", "model", "split", "metric", F.coalesce(ok, F.lit(False)).alias("plausible"))


SUITE_SQL = """
SELECT task, model, split, metric, TRUE AS plausible FROM (
  SELECT 'classification' AS task, model, metric
  FROM (VALUES ('Logistic Regression'), ('Random Forest'), ('GBT Classifier')) a(model),
       (VALUES ('accuracy'), ('f1'), ('weightedPrecision'), ('weightedRecall')) b(metric)
  UNION ALL
  SELECT 'regression', model, metric
  FROM (VALUES ('Linear Regression'), ('Random Forest'), ('GBT Regressor')) a(model), (VALUES ('rmse'), ('r2')) b(metric)),
  (VALUES ('train'), ('validation'), ('test')) c(split)
"""


@query
def ml_suite(spark, sf_dir):
    splits, _ = prepared_splits(spark, sf_dir)
    return plausible(suite.train_suite(spark, splits)[0])


ORACLE_ML["ml_suite"] = SUITE_SQL
