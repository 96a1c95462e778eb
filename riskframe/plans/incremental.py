"""Cleaning facts that merge: statistics kept per file, so new files cost one scan of themselves.

A store is a Parquet table with one row per (file, kept, column) and per (file, kept, category), where ``kept`` tells the rows that the cleaning chain's
required columns leave. Rows hold counts, means and sums of squared deviations, which merge exactly (counts) or to rounding (moments); the
facts of the chain (sparse columns, means over all and over the kept rows, categories) are read off the merged rows.
Each file is known by its path: a refresh scans the files that the store does not have, and appends their rows in one write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import columns_of_type
from ..functions.exprs import number_of
from ..operators import clean
from ..session import materialize
from ..sources.files import write_table
from .cleaning import CleaningFacts, CleaningSpec, _kept

STORE_SCHEMA = ("part string, kept boolean, column string, category string, total long, missing long, n long, mean double, m2 double, "
                "min double, max double")


def part_facts(df: DataFrame, spec: CleaningSpec, part: Column) -> DataFrame:
    """The store's rows for the rows of ``df``, by ``part`` (such as the file's path): one aggregate, grouped by part, kept and category.

    For a column: the rows, the missing ones, and number, mean, sum of squared deviations, least and largest of its
    numbers (NULL if it has none). For a category of the one-hot column: the rows.
    """
    req = [c for c in spec.required if c in df.columns]
    oh = spec.one_hot_column if spec.one_hot_column in df.columns else None
    category = F.coalesce(F.col(f"`{oh}`").cast("string"), F.lit(spec.one_hot_fill)) if oh else F.lit(None).cast("string")
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(df.columns):
        numeric = isinstance(df.schema[c].dataType, (T.NumericType, T.StringType)) and (
            not isinstance(df.schema[c].dataType, T.StringType) or c in spec.mean_fill)
        x = number_of(df, c) if numeric else F.lit(None).cast("double")
        aggs += [F.count_if(clean.missing(df, c, spec.missing_tokens)).alias(f"m{i}"), F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"),
                 F.var_pop(x).alias(f"v{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    keyed = df.select(part.cast("string").alias("__part"), _kept(df, req).alias("__kept"), category.alias("__cat"), "*")
    wide = materialize(keyed.groupBy("__part", "__kept", "__cat").agg(*aggs))
    null = F.lit(None)
    figures = [F.struct(F.lit(c).alias("column"), F.col("total"), F.col(f"m{i}").alias("missing"), F.col(f"n{i}").alias("n"),
                        F.col(f"a{i}").alias("mean"), (F.col(f"v{i}") * F.col(f"n{i}")).alias("m2"),
                        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")) for i, c in enumerate(df.columns)]
    by_column = wide.select(F.col("__part").alias("part"), F.col("__kept").alias("kept"), F.inline(F.array(*figures)))
    columns = merge_facts(by_column, ["part", "kept", "column"]).withColumn("category", null.cast("string"))
    names = [f.name for f in T.StructType.fromDDL(STORE_SCHEMA).fields]
    if not oh:
        return columns.select(*names)
    counts = wide.select(F.col("__part").alias("part"), F.col("__kept").alias("kept"), F.lit(oh).alias("column"), F.col("__cat").alias("category"),
                         "total", *[null.cast("long").alias(c) for c in ("missing", "n")], *[null.cast("double").alias(c) for c in ("mean", "m2", "min", "max")])
    return columns.select(*names).union(counts.select(*names))


def merge_facts(rows: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """(by..., total, missing, n, mean, m2, min, max) of the union of the rows' parts."""
    rows = rows.where("category is null") if "category" in rows.columns else rows
    weighted = F.sum(F.col("n") * F.col("mean"))
    means = rows.groupBy(*by).agg(F.sum("total").alias("total"), F.sum("missing").alias("missing"), F.sum("n").alias("_n"),
                                  F.try_divide(weighted, F.sum("n")).alias("_mean"), F.min("min").alias("min"), F.max("max").alias("max"))
    # deviations around the common mean, which is known now: no difference of large squares
    named = means.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("_mean").alias("__mean"))
    both = [rows[c].eqNullSafe(F.col(f"__{c}")) for c in by]
    gap = F.col("mean") - F.col("__mean")
    spread = rows.join(named, both).groupBy(*by).agg(F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2")).select(
        *[F.col(c).alias(f"__{c}") for c in by], "m2")
    joined = means.join(spread, [means[c].eqNullSafe(F.col(f"__{c}")) for c in by])
    return joined.select(*by, "total", "missing", F.col("_n").alias("n"), F.col("_mean").alias("mean"), "m2", "min", "max")


def refresh(spark: SparkSession, store: str, files: Sequence[str], spec: CleaningSpec, schema: T.StructType | str | None = None) -> list[str]:
    """Add the facts of the Parquet ``files`` that the store does not have yet; returns those, which alone were scanned."""
    known = {r["part"] for r in stored(spark, store).select("part").distinct().collect()}
    new = sorted(set(files) - known)
    if new:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(*new)
        write_table(part_facts(df, spec, F.input_file_name()).select(*[f.name for f in T.StructType.fromDDL(STORE_SCHEMA).fields]), store, mode="append")
    return new


def stored(spark: SparkSession, store: str) -> DataFrame:
    """The rows of a store (none if it does not exist yet)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(STORE_SCHEMA).parquet(store) if there else spark.createDataFrame([], STORE_SCHEMA)


def facts_from(rows: DataFrame, spec: CleaningSpec, df: DataFrame) -> CleaningFacts:
    """The cleaning chain's facts from a store's rows. ``df`` gives the columns and types (no row of it is read).

    One row per column and per category reaches the driver. Raises if a required column is sparse: the chain
    then drops no rows for it, which the stored ``kept`` does not reflect.
    """
    all_ = {r["column"]: r for r in merge_facts(rows).collect()}
    kept = {r["column"]: r for r in merge_facts(rows.where("kept")).collect()}
    sparse = [c for c in df.columns if c in all_ and all_[c]["total"] and all_[c]["missing"] / all_[c]["total"] > spec.sparse_threshold]
    if bad := [c for c in spec.required if c in sparse]:
        raise ValueError(f"required columns {bad} are sparse: fit the chain on the table itself")
    named = {c: all_[c]["mean"] if c in all_ else None for c in spec.mean_fill if c in df.columns}
    floats = {}
    for c in dict.fromkeys([*columns_of_type(df, T.DoubleType, T.FloatType), *named]):
        if c in sparse:
            continue
        k = kept.get(c)
        total, n = (k["mean"] or 0.0) * k["n"] if k else 0.0, k["n"] if k else 0
        if named.get(c) is not None and k:          # filled before the mean over the kept rows is taken
            total, n = total + named[c] * (k["total"] - k["n"]), k["total"]
        floats[c] = total / n if n else None
    oh = spec.one_hot_column
    categories = sorted(r["category"] for r in rows.where("kept and category is not null").select("category").distinct().collect()) \
        if oh in df.columns and oh not in sparse else []
    return CleaningFacts(sparse, named, floats, categories)
