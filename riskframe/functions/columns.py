"""Column-set operators: casts, drops, renames and column selection.

All of these are single projections; Catalyst collapses them into the scan's
projection, so chaining them costs nothing at run time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exprs import try_number


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise one clear error listing every missing column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def safe_cast(df: DataFrame, columns: Mapping[str, str] | Iterable[str],
              to: str = "double", strip_chars: str | None = None,
              nan_as_null: bool = False) -> DataFrame:
    """TRY_CAST the listed columns in one projection; bad text becomes NULL.

    ``columns`` is either a ``name -> type`` map or names cast to ``to``.
    ``strip_chars`` removes characters such as ``%`` first ("13.99%" -> 13.99).
    ``nan_as_null`` turns a NaN result (from the text "NaN") into NULL.
    """
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: to for c in columns}
    require_columns(df, mapping)
    out: dict[str, Column] = {}
    for name, typ in mapping.items():
        src = F.col(f"`{name}`")
        text = isinstance(df.schema[name].dataType, T.StringType)
        if strip_chars:
            # translate deletes each listed character; cheaper than a regex per value
            src = F.translate(src.cast("string"), strip_chars, "")
            text = True
        cast = try_number(src, typ) if text else src.try_cast(typ)
        if nan_as_null and typ in ("double", "float"):
            cast = F.nanvl(cast, F.lit(None).cast(typ))
        out[name] = cast
    return df.withColumns(out)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def _sanitized(name: str) -> str:
    # Fixed replacement rules: strip; space -> "_"; "." removed; "-" -> "_"; "+" -> "_plus_"
    return (name.strip().replace(" ", "_").replace(".", "")
            .replace("-", "_").replace("+", "_plus_"))


def sanitize_names(df: DataFrame) -> DataFrame:
    """Rename every column to a SQL-friendly name; raise if two collide."""
    new = [_sanitized(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both sanitize to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def columns_of_type(df: DataFrame, *types: type[T.DataType]) -> list[str]:
    """Names of the columns whose type is one of ``types`` (schema only)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def columns_matching(df: DataFrame, pattern: str, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the columns matching a regular expression, in schema order."""
    rx = re.compile(pattern)
    skip = set(exclude)
    return [c for c in df.columns if rx.search(c) and c not in skip]


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (for comparing results across engines)."""
    cols = columns_of_type(df, T.DoubleType, T.FloatType)
    return df.withColumns({c: F.round(F.col(f"`{c}`"), places) for c in cols})
