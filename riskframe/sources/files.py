"""Table readers and writers.

CSV appears only at the edges: the raw file is read once, as strings, with
the options that keep quoted multi-line fields intact. It is then cast and
written as Parquet, which the analyses read: filters reach row-group
statistics and only the used columns are read.

Spark reads a multi-line CSV file in one task, so with ``read_raw`` large raw
inputs should arrive as many files (a directory or a glob; any number of paths is
accepted). ``multiline.read_multiline`` reads one file by many tasks, and
``ingest_raw(parallel=True)`` uses it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import FLOAT_TEXT
from ..session import wide_rows

CSV_DEFAULTS: dict[str, str] = {
    "header": "true",
    "multiLine": "true",     # quoted fields may hold newlines
    "quote": '"',
    "escape": '"',           # "" inside a quoted field is a literal quote
}


def string_schema(names: Sequence[str]) -> T.StructType:
    """A schema of nullable STRING fields with the given names."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_raw(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv",
             schema: T.StructType | str | None = None, header: bool = True,
             options: Mapping[str, str] | None = None, valid_row: Column | None = None,
             multiline: bool = True) -> DataFrame:
    """Read text tables with every column as STRING (no inference pass).

    ``schema`` fixes the column names (all strings, for example from
    ``string_schema``). ``valid_row`` drops rows such as a trailing summary
    line that carries text in the first column only. ``multiline=False``
    makes each file splittable across tasks, but is correct only when no
    quoted field contains a line break.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**{**CSV_DEFAULTS, "header": str(header).lower(),
                                   "multiLine": str(multiline).lower()})
    if options:
        reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(list(paths) if not isinstance(paths, str) else paths)
    return df.filter(valid_row) if valid_row is not None else df


def read_typed(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
               fmt: str = "csv", infer: bool = False, header: bool = True,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Read with an explicit schema (preferred) or, if ``infer``, with type
    inference (one extra full pass over the input)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**{**CSV_DEFAULTS, "header": str(header).lower()})
    if options:
        reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.load(list(paths) if not isinstance(paths, str) else paths)


# The text forms that type inference tells apart, narrowest first.
_TYPE_TEXTS = [("int", r"^[+-]?[0-9]{1,10}$"), ("bigint", r"^[+-]?[0-9]{1,19}$"), ("double", FLOAT_TEXT),
               ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
               ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?$"),
               ("boolean", r"(?i)^(true|false)$")]


# Frequent forms that one pattern settles: (pattern, the types above that do not fit, as bits). The last one is of
# texts whose first letters begin no number, date, infinity, "nan", "true" or "false", or that hold a character of none of them.
_QUICK_TEXTS = [(r"^[+-]?[0-9]{1,9}\z", 0b111000), (r"^[+-]?[0-9]{1,18}\.[0-9]{1,18}(?:[eE][+-]?[0-9]{1,2})?\z", 0b111011),
                (r"^(?:[^0-9+\-.\snNiItTfF]|[nN](?![aA])|[iI](?![nN][fF])|[tT](?![rR])|[fF](?![aA]))"
                 r"|[!-*,/;-@GHJKMOQVWZ\[-`ghjkmoqvwz{-~]|[0-9]\+", 0b111111)]


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type that all non-NULL texts of a column have, for the columns that are not plain text; one aggregate
    over ``df``, for each column the union of the types that do not fit (a bit each).

    Types are tried as INT, BIGINT, DOUBLE, DATE, TIMESTAMP, BOOLEAN; whole numbers past BIGINT are DOUBLE. A column of NULLs is text.
    """
    columns = list(columns or df.columns)
    bad = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        unfit = F.lit(0)
        for bit, (t, pattern) in enumerate(_TYPE_TEXTS):
            # the cast is tried on well-formed text only: a failed one is costly
            fits = F.when(c.rlike(pattern), c.try_cast(t).isNotNull()).otherwise(False)
            unfit = unfit + F.when(fits, 0).otherwise(1 << bit)
        mask = F.when(c.isNull(), F.lit(None).cast("int"))
        for pattern, bits in _QUICK_TEXTS:
            mask = mask.when(c.rlike(pattern), bits)
        bad.append(F.bit_or(mask.otherwise(unfit)).alias(f"c{i}"))
    with wide_rows(df.sparkSession):
        r = df.agg(*bad).first()
    out = {}
    for i, name in enumerate(columns):
        fitting = [t for bit, (t, _) in enumerate(_TYPE_TEXTS) if r[f"c{i}"] is not None and not r[f"c{i}"] >> bit & 1]
        if fitting:
            out[name] = fitting[0]
    return out


def apply_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Relabel columns by position; the count must match exactly."""
    if len(names) != len(df.columns):
        raise ValueError(f"header has {len(names)} names but the table has {len(df.columns)} columns")
    if len(set(names)) != len(names):
        raise ValueError("header names are not unique")
    return df.toDF(*names)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, header: bool = True,
                options: Mapping[str, str] | None = None) -> None:
    """Write a table as a directory of part files, one per task (parallel)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", str(header).lower()).option("escape", '"')
    if options:
        writer = writer.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Write a result as a directory holding exactly one CSV part file.

    One file is what the caller asks for, and means one writing task: use ``write_table`` for
    results that no single file should hold. ``repartition(1)`` (rather than ``coalesce(1)``)
    keeps the work before it parallel; the input is computed once.
    """
    (df.repartition(1).write.mode(mode).option("header", str(header).lower())
     .option("escape", '"').csv(path))


def ingest_raw(spark: SparkSession, paths: str | Sequence[str], out_path: str,
               casts: Mapping[str, str] | None = None, partitions: int | None = None,
               partition_by: Sequence[str] | None = None, strip_chars: str | None = None,
               nan_as_null: bool = False, parallel: bool = False, **read_kw) -> DataFrame:
    """Read raw CSV once, cast the listed columns in the same pass, write Parquet, and return a
    reader of the Parquet table. ``strip_chars`` and ``nan_as_null`` as in ``safe_cast``;
    ``multiline=False`` (no field holds a line break) reads splits of a file in parallel.

    ``parallel=True`` reads a file whose fields hold line breaks by many tasks
    (``multiline.read_multiline``). Otherwise a multi-line CSV file is read by one task, and the rows may be
    spread over ``partitions`` tasks (a round-robin shuffle) before casting and writing.
    Every later pass then reads columnar, splittable, statistics-bearing
    files instead of re-parsing text.
    """
    from ..functions.columns import safe_cast
    if parallel:
        from .multiline import read_multiline
        df = read_multiline(spark, paths, **{k: v for k, v in read_kw.items() if k != "multiline"})
    else:
        df = read_raw(spark, paths, **read_kw)
    if partitions:
        df = df.repartition(partitions)
    if casts:
        df = safe_cast(df, {c: t for c, t in casts.items() if c in df.columns}, strip_chars=strip_chars,
                       nan_as_null=nan_as_null)
    write_table(df, out_path, partition_by=partition_by)
    return spark.read.parquet(out_path)
