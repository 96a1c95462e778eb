"""Row-versus-group-mean operators.

``avg(x) OVER (PARTITION BY k)`` would shuffle and sort every row by ``k``
and put each group, however large, into one task. Here the groups are
aggregated first, with partial aggregation before the shuffle. The small
per-group table is written once to the checkpoint folder, and the per-group
means are joined back (see ``joins.attach_by_key``). Within the checked
size bound the means are broadcast, so the fact rows never move. The answer
is the same, NULL keys included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ColumnOrName, col
from .joins import DEFAULT_MAX_BROADCAST_ROWS, attach_by_key


def group_means(df: DataFrame, keys: Sequence[str], value: ColumnOrName,
                mean_alias: str = "group_mean") -> DataFrame:
    """One row per group: the mean of ``value`` (NULL keys form a group)."""
    return df.groupBy(*keys).agg(F.avg(col(value)).alias(mean_alias))


def diff_from_group_mean(df: DataFrame, keys: Sequence[str] | str, value: str,
                         mean_alias: str = "group_mean", diff_alias: str = "difference",
                         columns: Sequence[str] | None = None,
                         max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Every row with its group's mean of ``value`` and ``value - mean``.

    ``columns`` selects the row columns kept (default: all).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    means = group_means(df, keys, value, mean_alias)
    rows = df.select(*columns) if columns else df
    for k in keys + [value]:
        if k not in rows.columns:
            raise ValueError(f"columns must include {k!r}")
    out = attach_by_key(rows, means, keys, max_broadcast_rows)
    return out.withColumn(diff_alias, F.col(value) - F.col(mean_alias))
