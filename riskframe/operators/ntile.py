"""Exact n-tiles and exact quantiles without a global sort.

``ntile(n) OVER (ORDER BY x)`` with no partition key moves every row into a
single partition. This module gives the same answer another way: it finds
the exact sort keys of the rows at the n-1 tile boundary ranks (distributed
order-statistic selection), then computes each row's tile as a pure
expression of its own key and those n-1 literals. No row is shuffled or
sorted, and nothing whole passes through one task or the driver.

Selection runs in rounds. Each round is one aggregation pass over the input,
which Spark computes partially per split before a tiny shuffle:

1. ``percentile_approx`` of the current key inside the bracket that holds
   the target rank, at fractions just below and above the target
   (relative rank error at most 1/accuracy);
2. exact ``count_if`` of the bracket pieces below, at, between and above
   the two returned values. These counts say exactly which piece holds the
   target, so approximation never affects correctness; it only decides how
   fast the bracket shrinks;
3. when a piece is a single value (a heavy tie), that value is fixed and
   the search continues on the next key (the tie-break) inside it. A key
   value held by a third of all rows is split by the tie-break like any
   other bracket;
4. once a bracket holds at most its share of ``collect_limit`` rows (the limit
   holds for all targets of a call together) and at most 1/16 of
   the rows taking part, those rows (the key columns only) are gathered and
   the target is read off directly.

On N rows this takes about log(N / collect_limit) / log(accuracy / 6)
rounds: two or three at any practical size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import ColumnOrName, col

DEFAULT_ACCURACY = 10_000
DEFAULT_COLLECT_LIMIT = 20_000


_NOT_UNIQUE = "tie_break does not identify rows: equal rows would fall on both sides of a tile boundary"
#: Targets per counting or gathering pass: bounds the width of one aggregate.
_TARGETS_PER_PASS = 48


@dataclass
class _Target:
    keys: list[Column]          # sort keys; non-NULL, non-NaN within ``base``
    base: Column                # rows taking part
    rank: int                   # 1-based rank of the wanted row within ``base``
    prefix: list[Any] = field(default_factory=list)   # fixed values of keys[:len(prefix)]
    lo: Any = None
    lo_strict: bool = False
    hi: Any = None
    hi_strict: bool = False
    below: int = 0              # rows of the current group before the bracket
    within: int = 0             # rows of the current group inside the bracket
    widen: float = 3.0
    result: tuple | None = None
    cap: int = 0                # most rows gathered for this target (set on first use)
    seed: tuple | None = None   # first-round cut values found by an earlier pass
    unique: bool = False        # the keys must identify the wanted row

    @property
    def level(self) -> int:
        return len(self.prefix)

    def group(self) -> Column:
        cond = self.base
        for k, v in zip(self.keys, self.prefix):
            cond = cond & (k == F.lit(v))
        return cond

    def bracket(self) -> Column:
        cond = self.group()
        k = self.keys[self.level]
        if self.lo is not None:
            cond = cond & ((k > F.lit(self.lo)) if self.lo_strict else (k >= F.lit(self.lo)))
        if self.hi is not None:
            cond = cond & ((k < F.lit(self.hi)) if self.hi_strict else (k <= F.lit(self.hi)))
        return cond

    def fix_value(self, value: Any, run_rows: int, rows_before: int) -> None:
        """The wanted row has key ``value`` at this level."""
        self.prefix.append(value)
        self.rank -= rows_before
        if self.level == len(self.keys):
            if self.unique and self.rank != run_rows:
                raise ValueError(_NOT_UNIQUE)
            self.result = tuple(self.prefix)
            return
        self.lo = self.hi = None
        self.lo_strict = self.hi_strict = False
        self.below, self.within, self.widen = 0, run_rows, 3.0


def _collect_small(df: DataFrame, targets: list[_Target]) -> None:
    """Gather the few rows of each small bracket and read off the target."""
    # a row sends only the open keys of the targets whose bracket it is in
    per_target = [F.when(t.bracket(), F.struct(*[k.alias(f"k{i}") for i, k in enumerate(t.keys[t.level:])])).alias(f"_t{j}")
                  for j, t in enumerate(targets)]
    cond = None
    for t in targets:
        cond = t.bracket() if cond is None else cond | t.bracket()
    rows = df.filter(cond).select(*per_target).collect()
    for j, t in enumerate(targets):
        mine = sorted(tuple(r[j]) for r in rows if r[j] is not None)
        pos = t.rank - t.below - 1
        if not 0 <= pos < len(mine):
            raise RuntimeError("order-statistic bracket lost its target row")
        if t.unique and pos + 1 < len(mine) and mine[pos + 1] == mine[pos]:
            raise ValueError(_NOT_UNIQUE)
        t.result = tuple(t.prefix) + mine[pos]


def _refine(df: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """One percentile pass and one exact count pass for every large bracket.

    Targets whose current bracket is the same (for example all n-tile
    boundaries in the first round) share one ``percentile_approx`` summary
    evaluated at all their fractions.
    """
    groups: dict[str, list[int]] = {}
    fracs: list[tuple[float, float]] = []
    seeded = {j: t.seed for j, t in enumerate(targets) if t.seed is not None}
    for t in targets:
        t.seed = None
    for j, t in enumerate(targets):
        if j in seeded:
            fracs.append((0.0, 0.0))
            continue
        f = (t.rank - t.below - 0.5) / t.within
        d = t.widen / accuracy
        fracs.append((max(0.0, f - d), min(1.0, f + d)))
        sig = repr((str(t.keys[t.level]), str(t.bracket())))
        groups.setdefault(sig, []).append(j)
    pct, where = [], {}
    for g, members in enumerate(groups.values()):
        t = targets[members[0]]
        ps: list[float] = []
        for j in members:
            for p in fracs[j]:
                if p not in ps:
                    ps.append(p)
                where[(j, p)] = (g, ps.index(p))
        pct.append(F.percentile_approx(F.when(t.bracket(), t.keys[t.level]), ps, accuracy)
                   .alias(f"_p{g}"))
    prow = df.agg(*pct).collect()[0] if pct else None
    cuts = []
    for j in range(len(targets)):
        if j in seeded:
            cuts.append(seeded[j])
            continue
        lo_g, lo_i = where[(j, fracs[j][0])]
        hi_g, hi_i = where[(j, fracs[j][1])]
        cuts.append((prow[f"_p{lo_g}"][lo_i], prow[f"_p{hi_g}"][hi_i]))

    cnt = []
    for j, (t, (lo, hi)) in enumerate(zip(targets, cuts)):
        k, b = t.keys[t.level], t.bracket()
        cnt += [F.count_if(b & (k < F.lit(lo))).alias(f"_lt{j}"),
                F.count_if(b & (k == F.lit(lo))).alias(f"_eqlo{j}"),
                F.count_if(b & (k > F.lit(lo)) & (k < F.lit(hi))).alias(f"_mid{j}"),
                F.count_if(b & (k == F.lit(hi))).alias(f"_eqhi{j}")]
    crow = df.agg(*cnt).collect()[0]

    for j, (t, (lo, hi)) in enumerate(zip(targets, cuts)):
        lt, eqlo, mid = crow[f"_lt{j}"], crow[f"_eqlo{j}"], crow[f"_mid{j}"]
        eqhi = 0 if hi == lo else crow[f"_eqhi{j}"]
        above = t.within - lt - eqlo - mid - eqhi
        r = t.rank - t.below          # rank inside the current bracket
        if r <= lt:                   # approximation missed low: keep [lo_old, lo)
            t.hi, t.hi_strict, t.within = lo, True, lt
            t.widen *= 4
        elif r <= lt + eqlo:
            t.fix_value(lo, eqlo, t.below + lt)
        elif r <= lt + eqlo + mid:
            t.lo, t.lo_strict, t.hi, t.hi_strict = lo, True, hi, True
            t.below += lt + eqlo
            t.within = mid
        elif r <= lt + eqlo + mid + eqhi:
            t.fix_value(hi, eqhi, t.below + lt + eqlo + mid)
        else:                         # approximation missed high: keep (hi, hi_old]
            t.lo, t.lo_strict = hi, True
            t.below += lt + eqlo + mid + eqhi
            t.within = above
            t.widen *= 4


def select_ranks(df: DataFrame, targets: list[_Target], accuracy: int = DEFAULT_ACCURACY,
                 collect_limit: int = DEFAULT_COLLECT_LIMIT) -> list[tuple]:
    """Exact sort keys of the rows at the given ranks (all targets in lock-step)."""
    for t in targets:
        # gather at most 1/16 of the rows taking part, and for all targets together about the limit
        t.cap = t.cap or max(1, min(collect_limit // len(targets), max(64, t.within // 16)))
    while True:
        active = [t for t in targets if t.result is None]
        if not active:
            return [t.result for t in targets]
        small = [t for t in active if t.within <= t.cap]
        for i in range(0, len(small), _TARGETS_PER_PASS):
            _collect_small(df, small[i:i + _TARGETS_PER_PASS])
        large = [t for t in active if t.within > t.cap]
        for i in range(0, len(large), _TARGETS_PER_PASS):
            _refine(df, large[i:i + _TARGETS_PER_PASS], accuracy)


def _orderable(df: DataFrame, c: Column) -> tuple[Column, bool]:
    """A numeric key with the same order as ``c``, and whether it can be NaN."""
    dtype = df.select(c.alias("_c")).schema["_c"].dataType
    if isinstance(dtype, T.DateType):
        return F.unix_date(c), False
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c), False
    if isinstance(dtype, T.TimestampNTZType):
        # microseconds from a wall-clock epoch: no time zone, so no DST fold
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, c), False
    if isinstance(dtype, T.BooleanType):
        return c.cast("int"), False
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.cast("double"), True
    if isinstance(dtype, T.DecimalType):
        return c, False
    if isinstance(dtype, T.NumericType):
        return c.cast("long"), False
    raise TypeError(f"ntile_exact needs a numeric, date or timestamp order key, got {dtype}")


def _lex_gt(keys: list[Column], values: tuple) -> Column:
    """``keys > values`` in lexicographic order (no NULLs on either side)."""
    k, v = keys[-1], values[-1]
    expr = k > F.lit(v)
    for k, v in zip(reversed(keys[:-1]), reversed(values[:-1])):
        expr = (k > F.lit(v)) | ((k == F.lit(v)) & expr)
    return expr


def tile_boundaries(n_rows: int, n: int) -> list[int]:
    """Ranks (1-based) of the last row of tiles 1..n-1, as ``ntile`` assigns them.

    With ``q, r = divmod(N, n)`` the first ``r`` tiles get ``q + 1`` rows and
    the rest ``q``. Boundaries at or beyond the last row are dropped.
    """
    q, r = divmod(n_rows, n)
    out = []
    for j in range(1, n):
        last = j * (q + 1) if j <= r else r * (q + 1) + (j - r) * q
        if 1 <= last < n_rows:
            out.append(last)
    return out


def ntile_exact(df: DataFrame, order_by: ColumnOrName, n: int,
                tie_break: list[ColumnOrName], alias: str = "ntile",
                accuracy: int = DEFAULT_ACCURACY,
                collect_limit: int = DEFAULT_COLLECT_LIMIT) -> DataFrame:
    """Add ``ntile(n) OVER (ORDER BY order_by, *tie_break)`` as column ``alias``.

    Ascending, NULLs first and NaN last, as Spark sorts, in the order key and in the ties.
    ``tie_break`` must identify rows (an id), so that tiles are well defined: if a tile
    boundary falls between rows that agree in all keys, a ValueError is raised. Row order
    and partitioning of the input are kept.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    x, can_nan = _orderable(df, col(order_by))
    tie_keys = [_orderable(df, col(t)) for t in tie_break]
    if not tie_keys:
        raise ValueError("ntile_exact needs a unique tie_break column")
    is_null = x.isNull()
    is_nan = F.isnan(x) if can_nan else F.lit(False)
    normal = x.isNotNull() & ~is_nan
    seg = F.when(is_null, 0).when(is_nan, 2).otherwise(1)

    # The counting pass also takes percentiles at the j/n positions of the
    # non-NULL, non-NaN values: a guess of where the boundaries lie (exact
    # when there are no NULLs), which saves the first percentile pass. A
    # wrong guess only costs a round; the exact counts decide.
    guess = sorted({min(1.0, max(0.0, j / n + d * 4.0 / accuracy))
                    for j in range(1, n) for d in (-1, 1)})
    c = df.agg(*[F.count_if(k.isNull() | F.isnan(k) if nan else k.isNull()).alias(f"t{i}")
                 for i, (k, nan) in enumerate(tie_keys)],
               F.count(F.lit(1)).alias("n"), F.count_if(is_null).alias("n_null"),
               F.count_if(x.isNotNull() & is_nan).alias("n_nan"),
               F.percentile_approx(F.when(normal, x), guess, accuracy).alias("g")).collect()[0]
    total, n_null, n_nan = c["n"], c["n_null"], c["n_nan"]
    seeds = dict(zip(guess, c["g"] or []))
    n_norm = total - n_null - n_nan
    if total == 0:
        return df.withColumn(alias, F.lit(None).cast("int"))

    ties: list[Column] = []
    for i, (k, nan) in enumerate(tie_keys):
        if c[f"t{i}"]:
            # NULL first, NaN last: a rank of the kind, then the value
            kind = F.when(k.isNull(), 0).when(F.isnan(k) if nan else F.lit(False), 2).otherwise(1)
            ties += [kind, F.when(kind == 1, k).otherwise(F.lit(0))]
        else:
            ties.append(k)

    targets, segs = [], []
    for rank in tile_boundaries(total, n):
        if rank <= n_null:
            t = _Target(keys=ties, base=is_null, rank=rank, within=n_null)
            segs.append(0)
        elif rank <= n_null + n_norm:
            t = _Target(keys=[x] + ties, base=normal, rank=rank - n_null, within=n_norm)
            j = len(targets) + 1
            lo_p = min(1.0, max(0.0, j / n - 4.0 / accuracy))
            hi_p = min(1.0, max(0.0, j / n + 4.0 / accuracy))
            if lo_p in seeds and hi_p in seeds and n_norm > 0:
                t.seed = (seeds[lo_p], seeds[hi_p])
            segs.append(1)
        else:
            t = _Target(keys=ties, base=x.isNotNull() & is_nan, rank=rank - n_null - n_norm,
                        within=n_nan)
            segs.append(2)
        t.unique = True
        targets.append(t)
    bounds = select_ranks(df, targets, accuracy, collect_limit)

    tile = F.lit(1)
    for s, t, b in zip(segs, targets, bounds):
        gt = (seg > F.lit(s)) | ((seg == F.lit(s)) & _lex_gt(t.keys, b))
        tile = tile + F.when(gt, 1).otherwise(0)
    return df.withColumn(alias, tile.cast("int"))


def quantile_profile(df: DataFrame, order_by: ColumnOrName, n: int,
                     tie_break: list[ColumnOrName], aggs: dict[str, Column],
                     tile_alias: str = "quantile", **kw: Any) -> DataFrame:
    """Aggregates per exact n-tile of ``order_by``, ordered by tile."""
    tiled = ntile_exact(df, order_by, n, tie_break, alias=tile_alias, **kw)
    return (tiled.groupBy(tile_alias).agg(*[c.alias(a) for a, c in aggs.items()])
            .orderBy(tile_alias))


def exact_quantiles(df: DataFrame, columns: list[ColumnOrName] | ColumnOrName, probs: list[float],
                    accuracy: int = DEFAULT_ACCURACY,
                    collect_limit: int = DEFAULT_COLLECT_LIMIT) -> list:
    """Exact quantiles with linear interpolation (the meaning of SQL
    ``percentile`` / ``quantile_cont``); NULL and NaN are ignored.

    For one column, a list of floats (None for an empty column); for a list of
    columns, one such list per column. Only the two order statistics around
    each probability are selected, for all columns in the same passes; no
    value list is ever built.
    """
    single = not isinstance(columns, list)
    cols = [columns] if single else list(columns)
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError("probabilities must lie in [0, 1]")
    xs = [col(c).cast("double") for c in cols]
    oks = [x.isNotNull() & ~F.isnan(x) for x in xs]
    # the counting pass also takes percentiles just around each probability:
    # a guess of the bracket that saves the first percentile pass
    d = 4.0 / accuracy
    guess = sorted({min(1.0, max(0.0, p + e)) for p in probs for e in (-d, d)})
    crow = df.agg(*[F.count_if(ok).alias(f"n{i}") for i, ok in enumerate(oks)],
                  *[F.percentile_approx(F.when(ok, x), guess, accuracy).alias(f"g{i}")
                    for i, (x, ok) in enumerate(zip(xs, oks))]).collect()[0]
    targets: list[_Target] = []
    plans = []
    for i, (x, ok) in enumerate(zip(xs, oks)):
        n_rows = crow[f"n{i}"]
        if n_rows == 0:
            plans.append(None)
            continue
        need: dict[int, _Target] = {}
        plan = []
        for p in probs:
            h = (n_rows - 1) * p
            lo_i, hi_i = math.floor(h), math.ceil(h)
            plan.append((h, lo_i, hi_i))
            seeds = dict(zip(guess, crow[f"g{i}"] or []))
            lo_p, hi_p = min(1.0, max(0.0, p - d)), min(1.0, max(0.0, p + d))
            for r in (lo_i, hi_i):
                if r not in need:
                    need[r] = _Target(keys=[x], base=ok, rank=r + 1, within=n_rows)
                    if lo_p in seeds and hi_p in seeds:
                        need[r].seed = (seeds[lo_p], seeds[hi_p])
                    targets.append(need[r])
        plans.append((plan, need))
    select_ranks(df, targets, accuracy, collect_limit)
    out = []
    for entry in plans:
        if entry is None:
            out.append([None for _ in probs])
            continue
        plan, need = entry
        vals = []
        for h, lo_i, hi_i in plan:
            lo_v, hi_v = need[lo_i].result[0], need[hi_i].result[0]
            vals.append(float(lo_v) if hi_i == lo_i else lo_v + (h - lo_i) * (hi_v - lo_v))
        out.append(vals)
    return out[0] if single else out
