"""Join helpers that broadcast only sides of a measured size.

Static (estimate-based) broadcast is disabled in ``build_session``. A side is
broadcast here only if its rows and bytes were counted and lie within the bound.
Beyond the bound the join is a shuffle join, where ``split_join`` keeps the rows of hot keys in place and
AQE splits what is still uneven.
The choice changes the plan, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A plan's own size figure this many times above the byte bound settles the
# question without a pass: it counts scanned files before filters and pruning.
_CLEARLY_TOO_LARGE = 256

_FIXED_BYTES = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
                T.DateType: 4}


def row_bytes(df: DataFrame) -> Column:
    """The bytes of a row's values as an expression: measured for text, binary
    and nested values, the fixed width for the other types, 8 per field besides."""
    total = F.lit(8)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        else:
            size = F.lit(_FIXED_BYTES.get(type(f.dataType), 16 if isinstance(f.dataType, T.DecimalType) else 8))
        total = total + size
    return total.cast("long")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size figure of ``df`` (no job runs)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, ask_plan: bool = True) -> bool:
    """True if ``df`` is within the row and byte bounds.

    A plan that is far too large by its own figure is refused without a job. Otherwise rows
    and bytes are counted by one aggregate: each task sends one partial row, and only the
    columns of ``df`` whose sizes vary are read.
    """
    if ask_plan and plan_bytes(df) > _CLEARLY_TOO_LARGE * max_bytes:
        return False
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if its counted rows and bytes are within the bounds,
    else ``df`` unchanged: the join then stays a shuffle join, and AQE
    may still broadcast it from the size measured at run time.

    Select the join keys and payload columns before calling: the broadcast carries only them.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def _null_safe(left: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(F.col(f"{prefix}{i}"))
        cond = c if cond is None else cond & c
    return cond


def split_join(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner", heavy_rows: int | None = None,
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join one-row-per-key ``groups`` onto ``rows`` ("inner" or "left") where some keys may hold a large part of the rows.

    Keys are NULL-safe (NULL matches NULL). The rows per key are counted first, by partial aggregation. The groups of keys
    with more than ``heavy_rows`` rows are broadcast, so their rows stay where they are; only the others are shuffled. By default a key is heavy
    if it holds more than an eighth of an even partition's rows: at most 8 x ``spark.sql.shuffle.partitions`` keys can. If those groups are over the byte or row
    bound, the limit is raised fourfold until they fit. Without heavy keys this is a plain shuffle join.

    ``rows`` is read three times (count, heavy, rest), so stage what is costly to compute.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    from ..session import materialize
    spark = rows.sparkSession
    renamed = groups.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in groups.columns if c not in keys])
    counts = rows.groupBy(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n"))
    if heavy_rows is None:
        # heavy keys are among the few whose count is largest: one pass finds the total and the largest count
        counts = materialize(counts)
        total = counts.agg(F.sum("__n")).first()[0] or 0
        heavy_rows = max(1, total // (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    payload = [c for c in renamed.columns if not c.startswith("__k")]
    while True:
        heavy = counts.where(F.col("__n") > heavy_rows).drop("__n")
        cond = None
        for i in range(len(keys)):
            c = F.col(f"__h{i}").eqNullSafe(F.col(f"__k{i}"))
            cond = c if cond is None else cond & c
        # one row per heavy key, with its group's values where there is a group
        side = materialize(heavy.join(renamed.withColumn("__met", F.lit(True)), cond, "left")
                           .select(*[f"__h{i}" for i in range(len(keys))], F.coalesce("__met", F.lit(False)).alias("__met"), *payload))
        if fits_broadcast(side, max_broadcast_rows, max_broadcast_bytes, ask_plan=False):
            break
        heavy_rows = max(4 * heavy_rows, 1)
    joined = rows.join(renamed, _null_safe(rows, keys, "__k"), how).select(*[rows[c] for c in rows.columns], *payload)
    if not side.take(1):
        return joined
    hot = rows.join(F.broadcast(side), _null_safe(rows, keys, "__h"), "inner")
    if how == "inner":
        hot = hot.where("__met")
    rest = rows.join(F.broadcast(side.select(*[f"__h{i}" for i in range(len(keys))])), _null_safe(rows, keys, "__h"), "left_anti")
    cold = rest.join(renamed, _null_safe(rest, keys, "__k"), how)
    return hot.select(*[rows[c] for c in rows.columns], *payload).union(cold.select(*[rest[c] for c in rows.columns], *payload))


def attach_by_key(rows: DataFrame, groups: DataFrame, keys: Sequence[str],
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  how: str = "inner") -> DataFrame:
    """Join one-row-per-key ``groups`` onto ``rows`` with NULL-safe key equality.

    NULL keys match each other, as they do in ``groupBy`` or a window
    partition. ``groups`` (an aggregate of ``rows``) is computed once and
    written to the shared checkpoint folder. Counting it then costs no
    extra scan, and the source is read twice in all: once to aggregate, once
    to attach. Within the row and byte bound ``groups`` is broadcast, so the
    fact rows are never shuffled. Beyond it the groups of the keys that hold most rows are
    broadcast and only the rows of the others are shuffled (``split_join``).
    """
    from ..session import materialize
    renamed = materialize(groups.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                                        *[c for c in groups.columns if c not in keys]))
    # the checkpoint's own plan figure is that of its source, so count
    if not fits_broadcast(renamed, max_broadcast_rows, ask_plan=False):
        named = renamed.withColumnsRenamed({f"__k{i}": k for i, k in enumerate(keys)})
        return split_join(rows, named, keys, how)
    joined = rows.join(F.broadcast(renamed), _null_safe(rows, keys, "__k"), how)
    return joined.drop(*[f"__k{i}" for i in range(len(keys))])
