"""Joins that have no equality: overlapping ranges, values in a band, either of several keys.

Spark plans each of these conditions as a nested-loop or cartesian join.  Here
every one becomes equi-joins on something derived from the rows, with the exact
condition, on the original columns, as residual:

* ``overlap_join``: both sides' ranges are put into bins as wide as they are long.
* ``band_join``: bins as wide as the band, the right rows in the bins they reach.
* ``disjunctive_join``: one equi-join per alternative, each without the pairs that
  an earlier one found.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableworks.operators.sides import (
    EDGE,
    END_OPS,
    LEFT,
    LEFT_STREAMED,
    RIGHT,
    KeySpec,
    common_type,
    field_type,
    key_pairs,
    lowest_level,
    normalize_join_type,
    ordinal,
    project,
    qualified,
    unmatched,
)
from tableworks.operators.sizing import DEFAULT_BROADCAST_BYTES, fits_broadcast, row_bytes

_HELPERS = ("__tw_lkind", "__tw_lbin", "__tw_lfirst", "__tw_rkind", "__tw_rbin", "__tw_rfirst")


def _left_streamed(how: str, what: str) -> str:
    how = normalize_join_type(how)
    if how not in LEFT_STREAMED:
        raise ValueError(f"{what} preserves the left side only: inner, left, left_semi, left_anti")
    return how


# ---------------------------------------------------------------------------
# overlapping ranges


def _span(start: str, end: str, dtype: T.DataType) -> tuple[Column, Column]:
    """Smallest and largest ordinal of a range; a NULL end reaches to the edge."""
    s, e = ordinal(F.col(f"`{start}`"), dtype), F.coalesce(ordinal(F.col(f"`{end}`"), dtype), F.lit(EDGE))
    return F.least(s, e), F.greatest(s, e)


def _level(low: Column, high: Column, lowest: int) -> Column:
    """Even exponent of bins at least twice as wide as the span, and fine enough for its numbers.

    A bin of ``2**level`` must stay distinguishable at the span's magnitude; that
    bound moves in steps of eight, so that it adds few levels.
    """
    length = F.ceil(F.log2(high - low)) + 1  # NULL for a single point
    size = F.ceil(F.log2(F.greatest(F.abs(low), F.abs(high)))) - 50
    coarse = size + F.pmod(-size, F.lit(8))
    exponent = F.greatest(F.lit(lowest), length, coarse)
    return (exponent + F.pmod(exponent, F.lit(2))).cast("int")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_start: str,
    left_end: str,
    right_start: str,
    right_end: str,
    how: str = "inner",
    select_columns: Sequence[str | Column] | None = None,
    touching: bool = True,
    open_end: bool = False,
    join_keys: KeySpec | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Rows whose ranges overlap: ``left.start <= right.end AND left.end >= right.start``.

    With ``touching=False`` both comparisons are strict (half-open ranges that
    only meet don't overlap).  With ``open_end`` a NULL end, on either side, means
    that the range never ends; otherwise a NULL bound matches nothing.  A range
    whose end lies before its start is compared as written.  ``join_keys`` adds
    equalities.

    Plan: a range gets the level whose bins are a power of two at least twice as
    wide as the range is long, so it lies in at most two bins, at its own level
    and at every coarser one.  Each row goes to its bins at its own level and, as
    a guest, at the other side's coarser levels; a pair meets at the coarser of
    its two levels only, and there in its first common bin only, so it is found
    once.  Short ranges never meet in wide bins.  Two aggregates, each over both
    sides, find the finite extent (ends that are open, infinite or NaN count as
    reaching just there) and the levels in use with the sides' sizes.

    A side whose binned rows are measured at most ``max_broadcast_bytes`` is
    broadcast; otherwise both are shuffled on (keys, level, bin), where AQE splits
    a crowded bin.  Semi, anti and the unmatched rows of a left join first find
    the distinct ranges with a partner, then join the rows to those.
    """
    how = _left_streamed(how, "overlap_join")
    pairs = key_pairs(join_keys) if join_keys else []
    sides = ((left, left_start, left_end), (right, right_start, right_end))
    dtype = common_type([field_type(df, c) for df, *names in sides for c in names])
    whole = all(isinstance(field_type(df, c), T.IntegralType) for df, *names in sides for c in names)
    lowest = 0 if whole else lowest_level(dtype)

    valid = []
    for df, start, end in sides:
        bounded = F.col(f"`{start}`").isNotNull()
        valid.append(df.where(bounded if open_end else bounded & F.col(f"`{end}`").isNotNull()))

    def ends(side: int) -> DataFrame:
        low, high = _span(*sides[side][1:], dtype)
        size = row_bytes(sides[side][0]) if max_broadcast_bytes > 0 else F.lit(0)
        return valid[side].select(F.lit(side).alias("side"), low.alias("low"), high.alias("high"), size.cast("long").alias("size"))

    spans = ends(0).unionByName(ends(1))
    finite = [F.when(F.abs(F.col(c)) < EDGE, F.col(c)) for c in ("low", "high")]
    extent = spans.agg(
        F.least(*[F.min(c) for c in finite]).alias("low"), F.greatest(*[F.max(c) for c in finite]).alias("high")
    ).first()
    floor, ceiling = (extent["low"], extent["high"]) if extent["low"] is not None else (-EDGE, EDGE)

    def clamped(low: Column, high: Column) -> tuple[Column, Column]:
        return tuple(F.greatest(F.lit(floor), F.least(F.lit(ceiling), c)) for c in (low, high))

    levels: dict[int, list[int]] = {0: [], 1: []}
    sizes = {0: 0, 1: 0}
    per_side = spans.groupBy("side").agg(
        F.sort_array(F.collect_set(_level(*clamped(F.col("low"), F.col("high")), lowest))).alias("levels"),
        F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("bytes"),
    )
    for row in per_side.collect():
        levels[row["side"]] = list(row["levels"])
        sizes[row["side"]] = row["bytes"] + 64 * row["n"]

    def binned(df: DataFrame, side: int) -> DataFrame:
        """Copies of each row in its bins: as host at its own level, as guest at the other side's.

        ``kind`` names the host: ``2 * level + side``.  A guest of its own level's
        hosts is one on the right only, so equal levels meet once.
        """
        _, start, end = sides[side]
        low, high = clamped(*_span(start, end, dtype))
        mark = "lr"[side]
        own = F.col(f"__tw_{mark}own")
        others = [F.struct(F.lit(n).alias("level"), F.lit(2 * n + 1 - side).alias("kind")) for n in levels[1 - side]]
        host = F.struct(own.alias("level"), (2 * own + side).alias("kind"))
        wider = (lambda s: s["level"] > own) if side == 0 else (lambda s: s["level"] >= own)
        places = F.concat(F.array(host), F.filter(F.array(*others), wider)) if others else F.array(host)
        placed = df.withColumn(f"__tw_{mark}own", _level(low, high, lowest)).withColumn("__tw_place", F.explode(places))
        width = F.pow(F.lit(2.0), F.col("__tw_place.level").cast("double"))
        first, last = F.floor(low / width), F.floor(high / width)
        bins = F.array_distinct(F.array(first, last))
        at = placed.withColumn("__tw_at", F.explode(F.transform(bins, lambda b: F.struct(b.alias("bin"), (b == first).alias("first")))))
        out = at.withColumns(
            {
                f"__tw_{mark}kind": F.col("__tw_place.kind"),
                f"__tw_{mark}bin": F.col("__tw_at.bin"),
                f"__tw_{mark}first": F.col("__tw_at.first"),
            }
        ).drop("__tw_place", "__tw_at", f"__tw_{mark}own")
        copies = 2 * (1 + len(levels[1 - side]))
        return F.broadcast(out) if 0 < copies * sizes[side] <= max_broadcast_bytes else out

    def before(a: Column, b: Column) -> Column:
        """A start that lies before an end."""
        met = END_OPS["<=" if touching else "<"](a, b)
        return met | b.isNull() if open_end else met

    def condition() -> Column:
        exact = before(qualified(LEFT, left_start), qualified(RIGHT, right_end)) & before(
            qualified(RIGHT, right_start), qualified(LEFT, left_end)
        )
        meets = (
            (F.col(f"{LEFT}.__tw_lkind") == F.col(f"{RIGHT}.__tw_rkind"))
            & (F.col(f"{LEFT}.__tw_lbin") == F.col(f"{RIGHT}.__tw_rbin"))
            & (F.col(f"{LEFT}.__tw_lfirst") | F.col(f"{RIGHT}.__tw_rfirst"))
        )
        return reduce(operator.and_, [qualified(LEFT, a) == qualified(RIGHT, b) for a, b in pairs], meets & exact)

    def inner() -> DataFrame:
        sides_binned = binned(valid[0], 0).alias(LEFT), binned(valid[1], 1).alias(RIGHT)
        return sides_binned[0].join(sides_binned[1], condition(), "inner").drop(*_HELPERS)

    if how == "inner":
        return project(inner(), select_columns)
    by = list(dict.fromkeys([*[a for a, _ in pairs], left_start, left_end]))
    some = valid[0].select(*[F.col(f"`{c}`") for c in by]).distinct()
    met = binned(some, 0).alias(LEFT).join(binned(valid[1], 1).alias(RIGHT), condition(), "left_semi")
    met = met.select(*[F.col(f"`{c}`").alias(f"__tw_m{i}") for i, c in enumerate(by)]).distinct()
    same = reduce(operator.and_, [qualified(LEFT, c).eqNullSafe(F.col(f"__tw_m{i}")) for i, c in enumerate(by)])
    if how in ("left_semi", "left_anti"):
        return project(left.alias(LEFT).join(met, same, how), select_columns)
    alone = left.alias(LEFT).join(met, same, "left_anti")
    return project(inner(), select_columns).union(project(unmatched(alone, right), select_columns))


# ---------------------------------------------------------------------------
# values in a band


def _moved(c: Column, dtype: T.DataType, by: float | Decimal | dt.timedelta, sign: int) -> Column:
    """``c`` moved up or down by a distance in its own type."""
    if isinstance(by, dt.timedelta) and isinstance(dtype, T.DateType):
        if by % dt.timedelta(days=1):
            raise ValueError("dates move by whole days")
        return F.date_add(c, sign * by.days)
    return c + F.lit(by) if sign > 0 else c - F.lit(by)


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    below: float | Decimal | dt.timedelta,
    above: float | Decimal | dt.timedelta | None = None,
    how: str = "inner",
    select_columns: Sequence[str | Column] | None = None,
    join_keys: KeySpec | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    residual: Column | None = None,
) -> DataFrame:
    """Rows with ``left_key BETWEEN right_key - below AND right_key + above``.

    ``above`` defaults to ``below``.  Distances are numbers for numbers and
    ``timedelta`` for dates (whole days) and timestamps; neither may be negative.
    ``join_keys`` adds equalities.  ``residual`` is another form of the comparison,
    for one that rounds differently; it must not reach farther.

    Plan: the line is cut into bins twice as wide as the band.  A left row lies in
    one bin; a right row is copied into the one or two bins that its band reaches.
    The join is an equi-join on (keys, bin), with the comparison on the original
    columns as residual.  No statistics are needed, and as left rows have no
    copies, left, semi and anti joins are plain ones.  A right side measured small
    (with its copies) is broadcast.
    """
    how = _left_streamed(how, "band_join")
    above = below if above is None else above
    timed = isinstance(below, dt.timedelta)
    if timed != isinstance(above, dt.timedelta):
        raise ValueError("below and above are both numbers or both timedeltas")
    if min(below, above) < type(below)(0):
        raise ValueError("distances of a band are not negative")
    dtype = common_type([field_type(left, left_key), field_type(right, right_key)])
    if timed == isinstance(dtype, T.NumericType):
        raise ValueError("numbers take a number as distance, dates and timestamps a timedelta")
    if timed:
        unit = {T.DateType: dt.timedelta(days=1), T.TimestampType: dt.timedelta(microseconds=1)}.get(type(dtype), dt.timedelta(seconds=1))
        low, high = below / unit, above / unit
        if isinstance(dtype, T.TimestampNTZType):  # its ordinal counts whole seconds
            low, high = low + 1, high + 1
    else:
        low, high = float(below), float(above)
    width = max(2 * (low + high), 2.0**-20)
    pairs = key_pairs(join_keys) if join_keys else []
    if residual is None:
        l, r, kind = qualified(LEFT, left_key), qualified(RIGHT, right_key), field_type(right, right_key)
        residual = (l >= _moved(r, kind, below, -1)) & (l <= _moved(r, kind, above, 1))

    x = ordinal(F.col(f"`{left_key}`"), dtype)
    y = ordinal(F.col(f"`{right_key}`"), dtype)
    limit = width * 2.0**46

    def bin_of(v: Column) -> Column:
        """Monotone; beyond ``limit``, where doubles can't tell the band's ends apart, by magnitude."""
        far = F.signum(v) * (F.lit(2.0**46) + F.log2(F.abs(v) / F.lit(limit)) * F.lit(2.0**20))
        return F.floor(F.when(F.abs(v) <= limit, v / F.lit(width)).otherwise(far))

    slack = F.abs(y) * F.lit(2.0**-50) + F.lit((low + high) * 2.0**-40)  # bins are computed in doubles
    reach = F.array_distinct(F.array(bin_of(y - F.lit(low) - slack), bin_of(y + F.lit(high) + slack)))
    lft = left.withColumn("__tw_lbin", bin_of(x))
    rgt = right.where(F.col(f"`{right_key}`").isNotNull()).withColumn("__tw_rbin", F.explode(reach))
    if fits_broadcast(rgt, max_broadcast_bytes):
        rgt = F.broadcast(rgt)
    cond = (F.col(f"{LEFT}.__tw_lbin") == F.col(f"{RIGHT}.__tw_rbin")) & residual
    cond = reduce(operator.and_, [qualified(LEFT, a) == qualified(RIGHT, b) for a, b in pairs], cond)
    return project(lft.alias(LEFT).join(rgt.alias(RIGHT), cond, how).drop("__tw_lbin", "__tw_rbin"), select_columns)


# ---------------------------------------------------------------------------
# either of several keys


def disjunctive_join(
    left: DataFrame,
    right: DataFrame,
    alternatives: Sequence[KeySpec],
    how: str = "inner",
    select_columns: Sequence[str | Column] | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Rows equal in all keys of at least one of the ``alternatives``.

    Each alternative is a list of ``(left_name, right_name)`` pairs or shared
    names; key columns of both sides are kept.  An ``OR`` has no join key, so the
    inner join is a union of one equi-join per alternative, and each leaves out
    the pairs that an earlier alternative matches; a NULL there means no match.
    Semi and anti joins hand the rows that one alternative left over to the next,
    so a row is looked up only until it has a partner.  A right side measured
    small is broadcast; the others are shuffled once per alternative, and AQE
    splits a hot key.
    """
    how = _left_streamed(how, "disjunctive_join")
    if not alternatives:
        raise ValueError("alternatives must not be empty")
    # pairs of names give a condition that keeps both sides' key columns
    equal = [reduce(operator.and_, [qualified(LEFT, a) == qualified(RIGHT, b) for a, b in key_pairs(keys)]) for keys in alternatives]
    lft, rgt = left.alias(LEFT), right.alias(RIGHT)
    if fits_broadcast(right, max_broadcast_bytes):
        rgt = F.broadcast(rgt)

    def inner() -> DataFrame:
        parts = []
        for i, cond in enumerate(equal):
            earlier = [~F.coalesce(c, F.lit(False)) for c in equal[:i]]
            parts.append(project(lft.join(rgt, reduce(operator.and_, earlier, cond), "inner"), select_columns))
        return reduce(DataFrame.union, parts)

    def looked_up(keep_partnered: bool) -> DataFrame:
        rest, found = left, []
        for keys, cond in zip(alternatives, equal):
            names = list(dict.fromkeys(b for _, b in key_pairs(keys)))
            some = rgt.select(*[qualified(RIGHT, b) for b in names]).alias(RIGHT)
            if keep_partnered:
                found.append(rest.alias(LEFT).join(some, cond, "left_semi"))
            rest = rest.alias(LEFT).join(some, cond, "left_anti")
        return reduce(DataFrame.union, found) if keep_partnered else rest

    if how == "inner":
        return inner()
    if how in ("left_semi", "left_anti"):
        return project(looked_up(how == "left_semi").alias(LEFT), select_columns)
    return inner().union(project(unmatched(looked_up(False), right), select_columns))
