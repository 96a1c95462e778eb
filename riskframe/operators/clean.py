"""Cleaning operators: fit a few small facts, then transform with one projection.

Where the output depends on the data (which columns are sparse, the column
means, the categories of a one-hot column), the fact is computed by a single
aggregation pass whose result is one row, or a checked-small set of values.
The transformation is then a plain projection. No operator collects table
rows to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import columns_of_type, require_columns
from ..functions.exprs import flag_to_int, number_of, strip_suffix_int

# Text that counts as a missing value, the sparse-column
# threshold (a share strictly above it drops the column), and the defaults
# of the text, one-hot and term rules.
MISSING_TOKENS: tuple[str, ...] = ("NaN",)
SPARSE_THRESHOLD = 0.3
TEXT_FILL = "any"
TEXT_PLACEHOLDERS: tuple[str, ...] = ("...",)
ONE_HOT_FILL = "ANY"
TERM_SUFFIX = " months"
TERM_DEFAULT = 36


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def missing(df: DataFrame, name: str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """Missing test by type: NULL everywhere, NaN for floating columns and the
    listed tokens for text columns. Comparing a number with text would
    raise under ANSI mode, so each type gets only the test it can take."""
    dtype = df.schema[name].dataType
    c = _q(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    if isinstance(dtype, T.StringType) and tokens:
        return c.isNull() | c.isin(list(tokens))
    return c.isNull()


def null_profile(df: DataFrame, columns: Sequence[str] | None = None,
                 tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Missing count and share of every column, in one pass over the data.

    Long table: (column, missing, total, missing_share), schema order.
    """
    cols = list(columns) if columns else df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__total"),
                  *[F.count_if(missing(df, c, tokens)).alias(f"__m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__m{i}").alias("missing"))
                     for i, c in enumerate(cols)])
    return (wide.select(F.col("__total").alias("total"), F.inline(rows))
            .select("column", "missing", "total",
                    F.try_divide(F.col("missing").cast("double"), F.col("total")).alias("missing_share")))


def sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD,
                   tokens: Sequence[str] = MISSING_TOKENS) -> list[str]:
    """Columns whose missing share is strictly above ``threshold`` (one pass;
    the collected profile has one row per column, not per data row)."""
    prof = null_profile(df, tokens=tokens).collect()
    return [r["column"] for r in prof
            if r["missing_share"] is not None and r["missing_share"] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD,
                        tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Drop every column with more than ``threshold`` missing values."""
    return df.drop(*sparse_columns(df, threshold, tokens))


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Means of the columns in one pass; NaN is ignored like NULL."""
    if not columns:
        return {}
    row = df.agg(*[F.avg(number_of(df, c)).alias(f"__a{i}") for i, c in enumerate(columns)]).collect()[0]
    return {c: row[f"__a{i}"] for i, c in enumerate(columns)}


def fill_mean(df: DataFrame, columns: Sequence[str] | None = None,
              means: Mapping[str, float | None] | None = None) -> DataFrame:
    """Replace NULL and NaN in numeric columns by the column mean.

    ``columns=None`` means every DOUBLE/FLOAT column. Means are computed in
    one pass unless given. A filled integer column becomes DOUBLE (filling
    2.7 into an INT would truncate to 2). An all-missing column has no mean
    and is left as it is.
    """
    cols = list(columns) if columns is not None else columns_of_type(df, T.DoubleType, T.FloatType)
    require_columns(df, cols)
    m = dict(means) if means is not None else column_means(df, cols)
    out = {}
    for c in cols:
        if m.get(c) is None:
            continue
        out[c] = F.coalesce(number_of(df, c), F.lit(float(m[c])))
    return df.withColumns(out) if out else df


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of the columns is NULL."""
    require_columns(df, columns)
    return df.na.drop(subset=list(columns))


def distinct_report(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct-value counts (NULL counted as a value) of the columns before
    and after a step: (column, distinct_before, distinct_after)."""
    from .measures import distinct_counts
    b = distinct_counts(before, columns).withColumnRenamed("n_distinct", "distinct_before")
    a = distinct_counts(after, columns).withColumnRenamed("n_distinct", "distinct_after")
    # both sides hold one row per listed column
    return b.join(F.broadcast(a), "column")


def null_row_report(df: DataFrame, required: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``distinct_report`` of dropping the rows with a NULL in ``required``, in one
    aggregate over ``df``: the distinct values of the kept rows are counted beside those of all rows."""
    require_columns(df, [*required, *columns])
    kept = F.lit(True)
    for c in required:
        kept = kept & ~missing(df, c, ())
    wide = df.select(kept.alias("__kept"), *[_q(c) for c in columns]).agg(*[
        e for i, c in enumerate(columns) for e in (
            (F.countDistinct(_q(c)) + F.coalesce(F.max(_q(c).isNull().cast("int")), F.lit(0))).alias(f"b{i}"),
            (F.countDistinct(F.when(F.col("__kept"), _q(c)))
             + F.coalesce(F.max((F.col("__kept") & _q(c).isNull()).cast("int")), F.lit(0))).alias(f"a{i}"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"b{i}").cast("long").alias("distinct_before"),
                 F.col(f"a{i}").cast("long").alias("distinct_after")) for i, c in enumerate(columns)])))


def strip_to_int(df: DataFrame, column: str, suffix: str = TERM_SUFFIX,
                 default: int | None = TERM_DEFAULT) -> DataFrame:
    """Text like " 36 months" -> INT 36; NULL or bad text -> ``default``."""
    require_columns(df, [column])
    return df.withColumn(column, strip_suffix_int(_q(column), suffix, default))


def categories(df: DataFrame, column: str, fill: str | None = ONE_HOT_FILL,
               max_categories: int | None = None) -> list[str]:
    """Sorted distinct values of a column (NULL as ``fill``).

    The distinct values are found by a distributed aggregate and become column names, so
    they reach the driver. ``max_categories`` is an optional guard (off by default): more
    values then raise.
    """
    c = F.coalesce(_q(column).cast("string"), F.lit(fill)) if fill is not None else _q(column)
    found = df.select(c.alias("v")).distinct()
    if max_categories is not None:
        found = found.limit(max_categories + 1)
    vals = [r[0] for r in found.collect()]
    if max_categories is not None and len(vals) > max_categories:
        raise ValueError(f"{column!r} has more than {max_categories} categories")
    return sorted(v for v in vals if v is not None)


def one_hot(df: DataFrame, column: str, fill: str | None = ONE_HOT_FILL,
            cats: Sequence[str] | None = None, drop_source: bool = True,
            max_categories: int | None = None) -> DataFrame:
    """One INT 0/1 column ``<column>_<category>`` per category (NULL filled
    with ``fill`` first), categories sorted, none left out; one projection."""
    require_columns(df, [column])
    cats = list(cats) if cats is not None else categories(df, column, fill, max_categories)
    src = F.coalesce(_q(column).cast("string"), F.lit(fill)) if fill is not None else _q(column)
    out = df.withColumns({f"{column}_{cat}": (src == F.lit(cat)).cast("int") for cat in cats})
    return out.drop(column) if drop_source else out


def fill_text(df: DataFrame, columns: Sequence[str], value: str = TEXT_FILL,
              placeholders: Iterable[str] | Mapping[str, Iterable[str]] = TEXT_PLACEHOLDERS) -> DataFrame:
    """NULL and placeholder text (such as "...") become ``value``. A mapping gives
    the placeholders of each column; columns outside it have none."""
    require_columns(df, columns)
    out = {}
    for c in columns:
        ph = list(placeholders.get(c, ()) if isinstance(placeholders, Mapping) else placeholders)
        v = F.coalesce(_q(c), F.lit(value))
        out[c] = F.when(v.isin(ph), F.lit(value)).otherwise(v) if ph else v
    return df.withColumns(out)


def encode_flag(df: DataFrame, columns: Sequence[str], true_value: str = "Y") -> DataFrame:
    """Y/N flags to INT 1/0; anything else, NULL included, is 0."""
    require_columns(df, columns)
    return df.withColumns({c: flag_to_int(_q(c), true_value) for c in columns})
