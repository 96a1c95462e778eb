"""Model catalog, train-and-evaluate loop and feature importance.

Training data is persisted for the iterative fits, which scan it many times,
and unpersisted afterwards. A lost executor's cached blocks are recomputed
from lineage. Metrics of every split come from one aggregation each (see
``metrics``). The metrics table is tiny (tasks x models x splits x metrics)
and is built as a DataFrame.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import InheritableThread, StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from .features import FEATURES, LABEL_CLASS, LABEL_REG
from .metrics import classification_metrics, regression_metrics

CLASSIFICATION = "classification"
REGRESSION = "regression"
SPLITS = ("train", "validation", "test")
#: Training rows a core up to which models are fitted side by side.
BESIDE_ROWS = 1_000_000


def model_catalog(task: str, seed: int = 42) -> dict[str, tuple[str, Any]]:
    """key -> (display name, estimator). Hyper-parameters are fixed values;
    a seed is set on every randomised model so runs repeat. The forests cache each row's node in every
    tree, which finds the same splits without walking all trees from the root again at every level."""
    # Model hyper-parameters.
    if task == CLASSIFICATION:
        return {
            "lr": ("Logistic Regression",
                   LogisticRegression(featuresCol=FEATURES, labelCol=LABEL_CLASS, maxIter=10)),
            "rf": ("Random Forest",
                   RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL_CLASS,
                                          numTrees=30, maxDepth=10, seed=seed, cacheNodeIds=True)),
            "gbt": ("GBT Classifier",
                    GBTClassifier(featuresCol=FEATURES, labelCol=LABEL_CLASS,
                                  maxIter=20, maxDepth=8, seed=seed)),
        }
    if task == REGRESSION:
        return {
            "lr": ("Linear Regression", LinearRegression(featuresCol=FEATURES, labelCol=LABEL_REG)),
            "rf": ("Random Forest",
                   RandomForestRegressor(featuresCol=FEATURES, labelCol=LABEL_REG,
                                         numTrees=50, maxDepth=10, seed=seed, cacheNodeIds=True)),
            "gbt": ("GBT Regressor",
                    GBTRegressor(featuresCol=FEATURES, labelCol=LABEL_REG, maxIter=70,
                                 maxDepth=7, stepSize=0.1, subsamplingRate=0.7, seed=seed)),
        }
    raise ValueError(f"unknown task {task!r}")


def evaluate(task: str, predictions: DataFrame) -> DataFrame:
    """(metric, value) for a prediction table of the task."""
    if task == CLASSIFICATION:
        return classification_metrics(predictions, LABEL_CLASS)
    return regression_metrics(predictions, LABEL_REG)


@dataclass
class TrainResult:
    task: str
    key: str
    name: str
    model: Any
    duration_s: float
    metrics: list[tuple[str, str, float]]   # (split, metric, value)
    scored: dict[str, DataFrame] = field(default_factory=dict)   # split -> (label, prediction), if kept


def train_and_evaluate(task: str, key: str, splits: dict[str, DataFrame],
                       seed: int = 42, keep_scored: bool = False) -> TrainResult:
    """Fit one catalog model on ``splits['train']`` and score every split.

    With ``keep_scored`` the result has each split's label and prediction, persisted before the metrics are taken
    from them: for more figures of the same predictions, which are then computed once. The caller unpersists them.
    """
    name, est = model_catalog(task, seed)[key]
    start = time.time()
    model = est.fit(splits["train"])
    duration = time.time() - start
    rows, kept = [], {}
    for split, df in splits.items():
        scored = model.transform(df)
        if keep_scored:
            label = LABEL_CLASS if task == CLASSIFICATION else LABEL_REG
            scored = kept[split] = scored.select(label, "prediction").persist(StorageLevel.MEMORY_AND_DISK)
        for r in evaluate(task, scored).collect():    # 2-4 metric rows
            rows.append((split, r["metric"], float(r["value"]) if r["value"] is not None else None))
    return TrainResult(task, key, name, model, duration, rows, kept)


def chosen(wanted: Sequence[str] | str, known: Sequence[str], what: str) -> list[str]:
    """A name, several names or "all" as a list of known names; an unknown one raises."""
    names = list(known) if wanted == "all" else [wanted] if isinstance(wanted, str) else list(wanted)
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown {what} {unknown}; choose from {list(known)}")
    return names


def train_suite(spark: SparkSession, splits: dict[str, DataFrame],
                tasks: Sequence[str] | str = (CLASSIFICATION, REGRESSION),
                models: Sequence[str] | str = "all", seed: int = 42,
                persist: bool = True, side_by_side: int = 1) -> tuple[DataFrame, list[TrainResult]]:
    """Train and evaluate the selected models of each task (a name, several, or "all").

    Returns the long metrics table (task, model, split, metric, value,
    duration_s) and the fitted results, in the order of the catalog. A training split without rows raises before any fit.

    ``side_by_side`` models are fitted at a time, over the same persisted splits, each from its own thread and, under the fair
    scheduler, its own pool: the small jobs of one model (tree levels, gradient steps) fill the cores that another leaves idle. The
    fits are the same as one after the other; the first error, in that order, is raised when all threads have ended. With more than
    ``BESIDE_ROWS`` training rows a core they are fitted one after the other: a pass of one model then fills all cores, while the cached rows of
    several (a forest of 50 trees holds some 350 bytes a row, and as much again for the nodes) would crowd each other out of memory.
    """
    tasks = chosen(tasks, (CLASSIFICATION, REGRESSION), "task")
    picked = {task: chosen(models, list(model_catalog(task, seed)), "model") for task in tasks}
    if not splits["train"].take(1):
        raise ValueError("no rows to train on")
    cached = {k: (v.persist(StorageLevel.MEMORY_AND_DISK) if persist else v)
              for k, v in splits.items()}
    results = []
    try:
        wanted = [(task, key) for task in tasks for key in picked[task]]
        if side_by_side > 1:
            rows = {k: v.count() for k, v in cached.items()}         # persisted once, before several fits read it
            if rows["train"] > BESIDE_ROWS * spark.sparkContext.defaultParallelism:
                side_by_side = 1
        if side_by_side <= 1:
            results += [train_and_evaluate(task, key, cached, seed) for task, key in wanted]
        else:
            results += _side_by_side(spark, wanted, cached, seed, side_by_side)
    finally:
        if persist:
            for v in cached.values():
                v.unpersist()
    rows = [(r.task, r.name, split, metric, value, r.duration_s)
            for r in results for split, metric, value in r.metrics]
    schema = "task string, model string, split string, metric string, value double, duration_s double"
    return spark.createDataFrame(rows, schema), results


def _side_by_side(spark: SparkSession, wanted: Sequence[tuple[str, str]], splits: dict[str, DataFrame], seed: int, threads: int) -> list[TrainResult]:
    """The results of the (task, key) pairs, fitted by ``threads`` threads, in the pairs' order."""
    left, done, errors, lock = list(enumerate(wanted)), {}, {}, threading.Lock()

    def work() -> None:
        while True:
            with lock:
                if not left or errors:
                    return
                i, (task, key) = left.pop(0)
            try:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{task}-{key}")
                done[i] = train_and_evaluate(task, key, splits, seed)
            except Exception as e:  # noqa: BLE001 - raised again below
                errors[i] = e
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    workers = [InheritableThread(target=work) for _ in range(min(threads, len(wanted)))]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    if errors:
        raise errors[min(errors)]
    return [done[i] for i in range(len(wanted))]


def vector_names(df: DataFrame, vector: str = FEATURES) -> list[str] | None:
    """Names of a vector column's entries from its ML attributes, in vector order (None without names)."""
    groups = (df.schema[vector].metadata or {}).get("ml_attr", {}).get("attrs", {})
    entries = sorted((e["idx"], e.get("name")) for kind in groups.values() for e in kind)
    return [n for _, n in entries] if entries and all(n for _, n in entries) else None


def feature_importance(spark: SparkSession, model: Any, feature_names: Sequence[str],
                       top: int = 10) -> DataFrame:
    """The ``top`` features by weight: what a tree model reports as importance, or the size of a linear
    model's coefficient. A model of neither kind, or with another number of features, raises."""
    weights = getattr(model, "featureImportances", None)
    if weights is None:
        weights = getattr(model, "coefficients", None)
    if weights is None:
        raise TypeError(f"{type(model).__name__} reports no feature weights")
    sizes = [abs(float(w)) for w in weights.toArray()]
    if len(sizes) != len(feature_names):
        raise ValueError(f"the model has {len(sizes)} features, but {len(feature_names)} names were given")
    ranked = sorted(zip(feature_names, sizes), key=lambda f: (-f[1], f[0]))[:top]
    return spark.createDataFrame(ranked, "feature string, importance double")
