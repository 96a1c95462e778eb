"""Feature-table preparation for MLlib: filter, cast, impute, label, assemble, scale.

Everything is an MLlib stage or a DataFrame projection, so fitting is
distributed: Imputer and StandardScaler each compute their statistics in
one aggregation pass. ``fit_preparation`` is given the rows to fit on: the
training split (so no statistics of validation or test rows leak into
training), or every row to reproduce a fit-before-split workflow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import columns_matching, columns_of_type, safe_cast
from ..functions.exprs import number_of

FEATURES_RAW = "features_raw"
FEATURES = "features"
LABEL_CLASS = "label_class"
LABEL_REG = "label_reg"


@dataclass
class FeatureSpec:
    numeric: list[str]                     # cast to DOUBLE and mean-imputed
    indicator_pattern: str | None = None   # regex for 0/1 indicator columns (one-hot output)
    status_column: str | None = None
    keep_status: tuple[str, ...] = ()      # rows kept (finished outcomes)
    negative_status: str | None = None     # status giving label_class 0.0; others 1.0
    reg_target: str | None = None          # column giving label_reg (rows without it dropped)


def feature_columns(df: DataFrame, spec: FeatureSpec) -> tuple[list[str], list[str]]:
    """(numeric features present, indicator columns) in vector order."""
    numeric = [c for c in spec.numeric if c in df.columns]
    ind = (columns_matching(df, spec.indicator_pattern, exclude=numeric)
           if spec.indicator_pattern else [])
    return numeric, ind


def select_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Keep finished rows; cast features to DOUBLE ("13.99%" -> 13.99, bad text and "NaN" -> NULL)."""
    out = df
    if spec.status_column and spec.keep_status:
        out = out.filter(F.col(spec.status_column).isin(list(spec.keep_status)))
    numeric, ind = feature_columns(out, spec)
    texts = [c for c in numeric + ind if c in columns_of_type(out, T.StringType)]
    rest = [c for c in numeric + ind if c not in texts]
    if texts:
        out = safe_cast(out, texts, "double", strip_chars="%", nan_as_null=True)
    return out.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in rest}) if rest else out


def add_labels(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """label_reg from the regression target (rows without it dropped) and
    label_class: 0.0 for the negative status, 1.0 otherwise."""
    out = df
    if spec.reg_target:
        if spec.reg_target not in df.columns:
            raise ValueError(f"regression target {spec.reg_target!r} is missing")
        out = out.withColumn(LABEL_REG, F.col(spec.reg_target).try_cast("double")) \
                 .filter(F.col(LABEL_REG).isNotNull())
    if spec.status_column and spec.negative_status is not None:
        out = out.withColumn(LABEL_CLASS, F.when(F.col(spec.status_column) == spec.negative_status,
                                                 F.lit(0.0)).otherwise(F.lit(1.0)))
    return out


def all_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with no non-missing value (one pass). Imputer cannot fit them."""
    if not columns:
        return []
    row = df.agg(*[F.count(number_of(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).collect()[0]
    return [c for i, c in enumerate(columns) if row[f"n{i}"] == 0]


def build_preparation(numeric: Sequence[str], indicators: Sequence[str],
                      scale: bool = True) -> Pipeline:
    """Imputer(mean) -> VectorAssembler(skip invalid) -> StandardScaler(mean, std)."""
    stages = []
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=list(numeric), strategy="mean"))
    stages.append(VectorAssembler(inputCols=list(numeric) + list(indicators),
                                  outputCol=FEATURES_RAW if scale else FEATURES,
                                  handleInvalid="skip"))
    if scale:
        stages.append(StandardScaler(inputCol=FEATURES_RAW, outputCol=FEATURES,
                                     withMean=True, withStd=True))
    return Pipeline(stages=stages)


@dataclass
class Prepared:
    model: PipelineModel
    feature_names: list[str]
    zero_filled: list[str]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        out = df.na.fill(0.0, subset=self.zero_filled) if self.zero_filled else df
        cols = [FEATURES] + [c for c in (LABEL_CLASS, LABEL_REG) if c in df.columns] + list(keep)
        return self.model.transform(out).select(*cols)


def fit_preparation(fit_rows: DataFrame, spec: FeatureSpec, scale: bool = True) -> Prepared:
    """Fit imputation and scaling on ``fit_rows`` (already filtered and labelled).

    A feature with no value at all cannot be imputed by its mean: it is
    filled with 0.0, and only that feature. One counting pass tells which these are.
    """
    numeric, ind = feature_columns(fit_rows, spec)
    empty = all_missing(fit_rows, numeric)
    imputable = [c for c in numeric if c not in empty]
    src = fit_rows.na.fill(0.0, subset=empty) if empty else fit_rows
    pipe = build_preparation(imputable, list(empty) + ind, scale)
    model = pipe.fit(src)
    return Prepared(model, imputable + list(empty) + ind, empty)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """MLlib mean Imputer on the columns (NULL and NaN ignored); a column with
    no value at all gets 0.0 instead, as Imputer cannot fit it."""
    cols = list(columns)
    if not cols:
        return df
    empty = all_missing(df, cols)
    rest = [c for c in cols if c not in empty]
    out = df.na.fill(0.0, subset=list(empty)) if empty else df
    if not rest:
        return out
    return Imputer(inputCols=rest, outputCols=rest, strategy="mean").fit(out).transform(out)
