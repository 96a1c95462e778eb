"""Evaluation metrics as aggregations (the meaning of MLlib's evaluators).

Classification: one ``groupBy(label, prediction).count()``, the confusion
counts, gives accuracy and the label-weighted precision, recall and F1 that
``MulticlassClassificationEvaluator`` reports. Regression: one aggregate
gives RMSE and R². The prediction table is scanned once, not once per
metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _long(wide: DataFrame, names: list[str]) -> DataFrame:
    return wide.unpivot([], names, "metric", "value")


def classification_metrics(pred: DataFrame, label: str = "label_class",
                           prediction: str = "prediction") -> DataFrame:
    """(metric, value) for accuracy, f1, weightedPrecision, weightedRecall."""
    conf = (pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p"))
            .agg(F.count(F.lit(1)).alias("n")))
    # the predictions are made once: a class's predicted rows come from a window over the counts, not from a second aggregate joined to it
    right = F.col("y") == F.col("p")
    cls = (conf.withColumn("n_p", F.sum("n").over(Window.partitionBy("p"))).groupBy("y")
           .agg(F.sum("n").alias("n_y"), F.sum(F.when(right, F.col("n")).otherwise(F.lit(0))).alias("tp"), F.max(F.when(right, F.col("n_p"))).alias("n_p")))
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_p")), F.lit(0.0))
    recall = F.try_divide(F.col("tp").cast("double"), F.col("n_y"))
    cls = cls.select("n_y", "tp", precision.alias("prec"), recall.alias("rec"))
    f1 = F.when(F.col("prec") + F.col("rec") == 0, F.lit(0.0)).otherwise(
        2.0 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec")))
    total = F.sum("n_y").cast("double")
    wide = cls.agg((F.sum("tp") / total).alias("accuracy"),
                   (F.sum(f1 * F.col("n_y")) / total).alias("f1"),
                   (F.sum(F.col("prec") * F.col("n_y")) / total).alias("weightedPrecision"),
                   (F.sum(F.col("rec") * F.col("n_y")) / total).alias("weightedRecall"))
    return _long(wide, ["accuracy", "f1", "weightedPrecision", "weightedRecall"])


def regression_metrics(pred: DataFrame, label: str = "label_reg",
                       prediction: str = "prediction") -> DataFrame:
    """(metric, value) for rmse and r2 (1 - SSE / SST), one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e2 = (y - p) * (y - p)
    wide = pred.agg(F.sqrt(F.avg(e2)).alias("rmse"),
                    (F.lit(1.0) - F.try_divide(F.sum(e2), F.var_pop(y) * F.count(y))).alias("r2"))
    return _long(wide, ["rmse", "r2"])
