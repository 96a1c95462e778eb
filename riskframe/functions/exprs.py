"""Scalar column expressions shared by the operators (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The text forms Spark's string-to-number cast accepts
# (surrounding whitespace allowed). Integers: optional sign and digits.
# Floating point: decimal with optional exponent and d/f suffix, NaN,
# Inf/Infinity (any case, optional sign) and hexadecimal floats with a
# binary exponent.
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = (r"(?i)^\s*[+-]?(nan|inf|infinity|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[df]?"
              r"|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[df]?)\s*$")
_GATES = {"int": INT_TEXT, "integer": INT_TEXT, "bigint": INT_TEXT, "long": INT_TEXT,
          "smallint": INT_TEXT, "short": INT_TEXT, "tinyint": INT_TEXT, "byte": INT_TEXT,
          "double": FLOAT_TEXT, "float": FLOAT_TEXT}


def try_number(text: ColumnOrName, typ: str) -> Column:
    """TRY_CAST of text to a numeric type, with the same result.

    Spark 4 implements TRY_CAST of malformed text by raising and catching an
    exception per value, which costs microseconds each: on dirty columns it
    dominates the job. A cheap pattern test sends only well-formed text to the
    cast. Overflowing digits still reach TRY_CAST and become NULL there.
    """
    c = col(text)
    gate = _GATES.get(typ.lower())
    return c.try_cast(typ) if gate is None else F.when(c.rlike(gate), c.try_cast(typ))


def number_of(df, name: str) -> Column:
    """A column as DOUBLE without raising on dirty text: malformed text, NULL and NaN are NULL."""
    c = F.col(f"`{name}`")
    v = try_number(c, "double") if isinstance(df.schema[name].dataType, T.StringType) else c.cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part / whole * 100`` as DOUBLE; NULL instead of an error when whole is 0."""
    return F.try_divide(col(part).cast("double"), col(whole)) * F.lit(100.0)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den))


def parse_month(text: ColumnOrName, fmt: str = "MMM-yyyy") -> Column:
    """Text such as ``Dec-2015`` to a DATE; unparsable text becomes NULL."""
    return F.try_to_date(col(text), fmt)


def age_years(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Years between two dates as ``months_between / 12`` (DOUBLE)."""
    return F.months_between(col(later), col(earlier)) / F.lit(12.0)


def strip_suffix_int(text: ColumnOrName, suffix: str, default: int | None = None) -> Column:
    """Remove a text suffix and TRY_CAST to INT; NULL/bad text -> ``default``."""
    value = try_number(F.replace(col(text).cast("string"), F.lit(suffix), F.lit("")), "int")
    return value if default is None else F.coalesce(value, F.lit(default))


def flag_to_int(c: ColumnOrName, true_value: str = "Y") -> Column:
    """``true_value`` -> 1, anything else (NULL included) -> 0, INT."""
    return F.when(col(c) == F.lit(true_value), F.lit(1)).otherwise(F.lit(0))


def row_hash(keys: list[ColumnOrName], seed: int = 42) -> Column:
    """Deterministic 64-bit hash of a row key: same value on any layout or retry."""
    return F.xxhash64(F.lit(seed), *[col(k) for k in keys])


def unit_hash(keys: list[ColumnOrName], seed: int = 42, resolution: int = 1 << 30) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from a row key."""
    return F.pmod(row_hash(keys, seed), F.lit(resolution)).cast("double") / F.lit(float(resolution))
