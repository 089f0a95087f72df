"""Joins: equi, conditional, interval, range, multi-table, coalescing, broadcast, bucketed.

All of them build a Catalyst ``Join`` and leave the physical strategy to Spark,
with two rewrites where Spark's own plan for the condition does not scale:

* ``interval_join`` (point inside a closed or half-open interval): Spark plans
  two inequalities as a nested-loop or cartesian join.  Here both sides get a
  bin number, the join is an equi-join on the bin and the exact predicate, on
  the original columns, stays as a residual.
* ``range_join`` (one inequality): equality keys make it an equi-join; without
  them a measured-small side is broadcast, or the key domain is cut at its
  quantiles and the join is an equi-join on the bin.

Sides are aliased ``left_table`` / ``right_table`` (``table_<i>`` in the
multi-table join), so SQL text in conditions and ``select_columns`` can use
those names.  No temp views are registered: nothing leaks between calls.
"""

from __future__ import annotations

import datetime as dt
import logging
import math
import operator
import re
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableworks.operators import conditions
from tableworks.operators.hot_keys import full_outer_hot
from tableworks.operators.overlaps import band_join, disjunctive_join, overlap_join
from tableworks.operators.sides import (
    EDGE,
    END_OPS,
    LEFT,
    LEFT_STREAMED,
    RANGE_OPS,
    RIGHT,
    START_OPS,
    KeySpec,
    common_type,
    field_type,
    join_on,
    key_pairs,
    lowest_level,
    normalize_join_type,
    ordinal,
    project,
    qualified,
    unmatched,
)
from tableworks.operators.sizing import DEFAULT_BROADCAST_BYTES, fits_broadcast, row_bytes
from tableworks.sources.tables import bucket_spec, qualified_name

_log = logging.getLogger(__name__)

def equi_join(
    left: DataFrame,
    right: DataFrame,
    join_keys: KeySpec,
    how: str = "inner",
    select_columns: Sequence[str | Column] | None = None,
    split_full_outer: bool = True,
) -> DataFrame:
    """Join on equal keys.

    ``join_keys`` entries are a column name present on both sides (joined
    ``USING``-style: one key column in the output, the coalesced key for a full
    outer join) or a ``(left_name, right_name)`` pair (both columns kept).
    A full outer join runs as ``full_outer_hot``: keys that hold a large share of
    a side are joined apart, where they can be split, and every row is shuffled
    once (``full_outer_split`` where keys can't be told by hashes).
    ``split_full_outer=False`` keeps Spark's single full outer join, without the
    look for hot keys, for keys known to be unique on both sides.
    """
    how = normalize_join_type(how)
    pairs = key_pairs(join_keys)
    on = join_on(pairs)
    if how == "full_outer" and split_full_outer:
        return _full_outer(left, right, pairs, lambda joined: project(joined, select_columns))
    out = left.alias(LEFT).join(right.alias(RIGHT), on, how)
    return project(out, select_columns)


def _full_outer(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], select: Callable[[DataFrame], DataFrame]) -> DataFrame:
    joined = full_outer_hot(left, right, pairs, select)
    return joined if joined is not None else full_outer_split(left, right, join_on(pairs), select, pairs)


def full_outer_split(
    left: DataFrame,
    right: DataFrame,
    on: list[str] | Column,
    project: Callable[[DataFrame], DataFrame] = lambda joined: joined,
    key_pairs: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Full outer join as matched ∪ left-only ∪ right-only.

    AQE can split a skewed partition of an inner or anti join but not of a full
    outer join, so a key holding a third of one side would otherwise land in one
    task.  The three parts are an inner join and two anti joins, each of which
    AQE splits.  The unmatched parts are joined back to an empty copy of the
    other side, which the optimizer folds into NULL columns, so every part has
    the same columns under the same ``left_table`` / ``right_table`` aliases
    and ``project`` (e.g. a ``select`` with qualified names) applies to each
    part alike.

    Shuffle cost: rows with a NULL key can never match, so they are set aside
    first (no shuffle) and all three joins read the same NULL-free inputs.  The
    inner join and the anti join that keeps a side then read identical
    subtrees, and Spark reuses that side's exchange; the other input of each
    anti join is its key columns only.  So each side is shuffled once in full
    plus once as keys: close to a single full outer join, with no unsplittable
    task.
    """
    if key_pairs is None:
        if not isinstance(on, list):
            raise ValueError("key_pairs is needed when on is a condition")
        key_pairs = [(k, k) for k in on]
    lkeys = [lk for lk, _ in key_pairs]
    rkeys = [rk for _, rk in key_pairs]

    def split(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
        all_set = reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])
        return df.where(all_set), df.where(~all_set)

    left_nn, left_null = split(left, lkeys)
    right_nn, right_null = split(right, rkeys)
    lt, rt = left_nn.alias(LEFT), right_nn.alias(RIGHT)
    matched = lt.join(rt, on, "inner")
    left_rows = lt.join(right_nn.select(*rkeys).alias(RIGHT), on, "left_anti").unionByName(left_null)
    # ``on`` names columns through the aliases, so it reads the same with the
    # right side streamed.
    right_rows = rt.join(left_nn.select(*lkeys).alias(LEFT), on, "left_anti").unionByName(right_null)
    left_only = left_rows.alias(LEFT).join(right.where(F.lit(False)).alias(RIGHT), on, "left")
    right_only = left.where(F.lit(False)).alias(LEFT).join(right_rows.alias(RIGHT), on, "right")
    parts = [project(p) for p in (matched, left_only, right_only)]
    return parts[0].union(parts[1]).union(parts[2])


def inner_join(left, right, join_keys, select_columns=None):
    return equi_join(left, right, join_keys, "inner", select_columns)


def left_join(left, right, join_keys, select_columns=None):
    return equi_join(left, right, join_keys, "left", select_columns)


def right_join(left, right, join_keys, select_columns=None):
    return equi_join(left, right, join_keys, "right", select_columns)


def full_outer_join(left, right, join_keys, select_columns=None):
    return equi_join(left, right, join_keys, "full_outer", select_columns)


def left_semi_join(left, right, join_keys):
    return equi_join(left, right, join_keys, "left_semi")


def left_anti_join(left, right, join_keys):
    return equi_join(left, right, join_keys, "left_anti")


def conditional_join(
    left: DataFrame,
    right: DataFrame,
    join_condition: str | Column,
    select_columns: Sequence[str | Column] | None = None,
    how: str = "inner",
    left_alias: str = LEFT,
    right_alias: str = RIGHT,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Join on an arbitrary condition over ``left_table`` / ``right_table``.

    Equalities inside the condition become hash/sort-merge keys (Catalyst
    extracts them).  Text that is a point-in-interval test, alone or next to
    equalities, runs as ``interval_join``: one column of a table compared with a
    start (``>=`` or ``>``) and an end (``<=`` or ``<``, optionally ``OR end IS
    NULL``) of the other, or ``BETWEEN``.  The ranges may be on either side
    (on the left for inner joins).  Any other condition of inequalities only is
    planned as a nested-loop join: a side measured at most
    ``max_broadcast_bytes`` is broadcast (the right one where the join streams
    the left; for inner joins either), with no shuffle.

    Text of three more shapes is planned without a nested loop, for the same join
    types: ranges that overlap (``overlap_join``), a column within fixed distances
    of another (``band_join``), and equalities joined by ``OR``
    (``disjunctive_join``).
    """
    how = normalize_join_type(how)
    default_aliases = (left_alias, right_alias) == (LEFT, RIGHT)
    shape = _interval_shape(join_condition) if isinstance(join_condition, str) and default_aliases else None
    if shape is not None and _orderable(left, right, shape) and (how == "inner" or (how in LEFT_STREAMED and shape["point_side"] == LEFT)):
        keys = shape["keys"]
        if shape["point_side"] == LEFT:
            points, ranges, names = left, right, (LEFT, RIGHT)
        else:
            points, ranges, names = right, left, (RIGHT, LEFT)
            keys = [(b, a) for a, b in keys]
        joined = interval_join(
            points, ranges, shape["point"], shape["start"], shape["end"], how, max_broadcast_bytes=max_broadcast_bytes,
            start_op=shape["start_op"], end_op=shape["end_op"], open_end=shape["open_end"], join_keys=keys or None,
            point_alias=names[0], range_alias=names[1],
        )
        if select_columns or names == (LEFT, RIGHT):
            return project(joined, select_columns)
        return joined.select(*[qualified(LEFT, c) for c in left.columns], *[qualified(RIGHT, c) for c in right.columns])
    if isinstance(join_condition, str) and default_aliases and how in LEFT_STREAMED:
        planned = _planned(left, right, join_condition, how, select_columns, max_broadcast_bytes)
        if planned is not None:
            return planned
    cond = F.expr(join_condition) if isinstance(join_condition, str) else join_condition
    lft, rgt = left.alias(left_alias), right.alias(right_alias)
    if how in LEFT_STREAMED and fits_broadcast(right, max_broadcast_bytes):
        rgt = F.broadcast(rgt)
    elif how in ("inner", "right") and fits_broadcast(left, max_broadcast_bytes):
        lft = F.broadcast(lft)
    return project(lft.join(rgt, cond, how), select_columns)


def _planned(
    left: DataFrame, right: DataFrame, condition: str, how: str, select_columns: Sequence[str | Column] | None, max_broadcast_bytes: int
) -> DataFrame | None:
    """The join for a condition of a known shape over columns that can be ordered, or ``None``."""
    ways = conditions.disjunction(condition)
    if ways is not None and all(a in left.columns and b in right.columns for way in ways for a, b in way):
        return disjunctive_join(left, right, ways, how, select_columns, max_broadcast_bytes)
    rest = {"how": how, "select_columns": select_columns, "max_broadcast_bytes": max_broadcast_bytes}
    shape = conditions.overlap(condition)
    if shape is not None and _ordered(left, [shape["left_start"], shape["left_end"]], right, [shape["right_start"], shape["right_end"]]):
        return overlap_join(left, right, **shape, **rest)
    shape = conditions.band(condition)
    if shape is not None and _ordered(left, [shape["left_key"]], right, [shape["right_key"]], isinstance(shape["below"], dt.timedelta)):
        return band_join(left, right, **shape, **rest, residual=F.expr(condition))
    return None


def _ordered(left: DataFrame, left_names: list[str], right: DataFrame, right_names: list[str], timed: bool | None = None) -> bool:
    """Whether the columns exist and have a common order, of times (or not) if asked."""
    if not set(left_names) <= set(left.columns) or not set(right_names) <= set(right.columns):
        return False
    types = [field_type(left, c) for c in left_names] + [field_type(right, c) for c in right_names]
    try:
        return timed is None or timed == (not isinstance(common_type(types), T.NumericType))
    except ValueError:
        return False


_IDENT = r"`?([A-Za-z_][A-Za-z0-9_]*)`?"
_MIRROR = {">=": "<=", ">": "<", "<=": ">=", "<": ">", "=": "="}


def _interval_shape(condition: str) -> dict[str, Any] | None:
    """The parts of a point-in-interval condition, or ``None`` if it isn't one.

    A conjunction of exactly one lower and one upper bound of the same point
    column, from columns of the other table, and any number of equalities.
    """
    side = rf"({LEFT}|{RIGHT})\.{_IDENT}"
    text = " ".join(condition.split())
    if re.fullmatch(r"\([^()]*\)", text):
        text = text[1:-1]
    between = re.compile(rf"{side} BETWEEN {side} AND {side}", re.I)
    text = between.sub(lambda m: f"{m[1]}.{m[2]} >= {m[3]}.{m[4]} AND {m[1]}.{m[2]} <= {m[5]}.{m[6]}", text)
    lower, upper, keys = [], [], []
    for part in re.split(r" AND ", text, flags=re.I):
        part = part.strip()
        while part.startswith("(") and part.endswith(")"):
            part = part[1:-1].strip()
        null_end = None
        either = re.split(r" OR ", part, flags=re.I)
        if len(either) == 2:
            nulls = [re.fullmatch(rf"{side} IS NULL", x.strip("() "), re.I) for x in either]
            if (nulls[0] is None) == (nulls[1] is None):
                return None
            table, column = next(m for m in nulls if m).groups()
            null_end = (table.lower(), column)
            part = next(x for x, m in zip(either, nulls) if m is None).strip("() ")
        elif len(either) > 2:
            return None
        m = re.fullmatch(rf"{side}\s*(>=|<=|>|<|=)\s*{side}", part, re.I)
        if not m or m[1].lower() == m[4].lower():
            return None
        a, op, b = (m[1].lower(), m[2]), m[3], (m[4].lower(), m[5])
        if op == "=":
            if null_end:
                return None
            keys.append((a[1], b[1]) if a[0] == LEFT else (b[1], a[1]))
            continue
        (lower if op in (">=", ">") else upper).append((a, op, b, null_end))
    bounds = lower + upper
    if len(bounds) != 2:
        return None
    # the column that both bounds share is the point
    shared = {x for x in (bounds[0][0], bounds[0][2])} & {x for x in (bounds[1][0], bounds[1][2])}
    if len(shared) != 1:
        return None
    point, found = next(iter(shared)), {}
    for a, op, b, null_end in bounds:
        if a != point:
            a, op, b = b, _MIRROR[op], a
        kind = "start" if op in (">=", ">") else "end"
        if kind in found or (null_end and (kind == "start" or null_end != b)):
            return None
        found[kind] = (b[1], op, null_end is not None)
    if len(found) != 2:
        return None
    return {
        "point_side": point[0], "point": point[1], "start": found["start"][0], "start_op": found["start"][1],
        "end": found["end"][0], "end_op": found["end"][1], "open_end": found["end"][2], "keys": keys,
    }


def _orderable(left: DataFrame, right: DataFrame, shape: dict[str, Any]) -> bool:
    """Whether the columns exist and are of types whose order bins can follow."""
    points, ranges = (left, right) if shape["point_side"] == LEFT else (right, left)
    names = ((points, shape["point"]), (ranges, shape["start"]), (ranges, shape["end"]))
    if any(c not in df.columns for df, c in names):
        return False
    try:
        common_type([field_type(df, c) for df, c in names])
    except ValueError:
        return False
    return True


def interval_join(
    points: DataFrame,
    ranges: DataFrame,
    point_col: str,
    start_col: str,
    end_col: str,
    how: str = "inner",
    select_columns: Sequence[str | Column] | None = None,
    bin_width: float | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    start_op: str = ">=",
    end_op: str = "<=",
    open_end: bool = False,
    join_keys: KeySpec | None = None,
    point_alias: str = LEFT,
    range_alias: str = RIGHT,
) -> DataFrame:
    """Rows of ``points`` joined to every range with ``point start_op start`` and ``point end_op end``.

    ``start_op`` is ``>=`` or ``>``, ``end_op`` ``<=`` or ``<`` (half-open
    intervals); with ``open_end`` a NULL end means that the range never ends.
    ``join_keys`` adds equalities (``(point_name, range_name)`` pairs or shared
    names, kept from both sides), e.g. for a lookup in a history as of a time.

    Plan: a range of length ``L`` gets the level whose bins are a power of two
    at least ``2 * L`` wide, so it covers at most two bins (numbers saturate at
    the ends of a long, which keeps their order).  One aggregate over
    the ranges gives the levels in use, their count and their bytes.  A point
    gets its bin at each of these levels, and the join is an equi-join on keys,
    level and bin with the exact predicate, on the original columns, as
    residual.  A match is found once, at the range's own level.  ``bin_width``
    sets the narrowest bins (rounded up to a power of two of the ordinal's unit:
    days, seconds, microseconds for zoned timestamps, else 1).

    A left, semi or anti join depends on the point's value and keys only:
    the distinct (keys, value) that match are found by one binned semi join, and
    one more join on them keeps or drops the points, whatever the number of
    levels; left is inner plus the points without a match.

    Ranges measured (after doubling for the two bins) at most
    ``max_broadcast_bytes`` are broadcast; for an inner join a small point
    side, measured with its copies per level, is broadcast instead.  Otherwise
    both sides are shuffled, and AQE splits a bin that holds many points.
    """
    how = normalize_join_type(how)
    if how not in LEFT_STREAMED:
        raise ValueError("interval_join preserves the point side only: inner, left, left_semi, left_anti")
    if start_op not in START_OPS or end_op not in END_OPS:
        raise ValueError("start_op is >= or >, end_op is <= or <")
    keys = key_pairs(join_keys) if join_keys else []
    ctype = common_type([field_type(points, point_col), field_type(ranges, start_col), field_type(ranges, end_col)])
    s, e = F.col(f"`{start_col}`"), F.col(f"`{end_col}`")
    valid = s.isNotNull() & (F.coalesce(s <= e, F.lit(True)) if open_end else (s <= e))
    rng = ranges.where(valid)

    s_ord = ordinal(s, ctype)
    e_ord = F.coalesce(ordinal(e, ctype), F.lit(EDGE))
    # Two levels are merged into one (bins up to four times wider than needed),
    # which halves the copies of each point.  log2 of a zero length is NULL.
    lowest = lowest_level(ctype)
    if bin_width is not None and bin_width > 0:
        lowest = max(lowest, math.ceil(math.log2(bin_width)))
    exponent = F.ceil(F.log2(e_ord - s_ord)) + 1
    level = F.greatest(F.lit(lowest), exponent + F.pmod(exponent, F.lit(2))).cast("int")
    stats = rng.agg(
        F.collect_set(level).alias("levels"), F.count(F.lit(1)).alias("n"), F.sum(row_bytes(ranges)).alias("bytes")
    ).collect()[0]
    levels = sorted(stats["levels"]) or [lowest]
    small_ranges = 0 < max_broadcast_bytes and 2 * (stats["bytes"] or 0) + 64 * stats["n"] <= max_broadcast_bytes

    def residual(left: str, right: str) -> Column:
        p = F.col(f"{left}.`{point_col}`")
        end = F.col(f"{right}.`{end_col}`")
        ends = END_OPS[end_op](p, end)
        cond = START_OPS[start_op](p, F.col(f"{right}.`{start_col}`")) & ((ends | end.isNull()) if open_end else ends)
        return reduce(operator.and_, [qualified(left, lk) == qualified(right, rk) for lk, rk in keys], cond)

    width = F.pow(F.lit(2.0), F.col("__tw_rlvl").cast("double"))
    binned = rng.withColumn("__tw_rlvl", level).withColumn(
        "__tw_rbin",
        F.explode(F.array_distinct(F.array(F.floor(s_ord / width), F.floor(e_ord / width)))),
    )
    if small_ranges:
        binned = F.broadcast(binned)

    def at_levels(frame: DataFrame) -> DataFrame:
        p_ord = ordinal(F.col(f"`{point_col}`"), ctype)
        bins = [
            F.struct(F.lit(lv).alias("l"), F.floor(p_ord / F.lit(2.0**lv)).alias("b")) for lv in levels
        ]
        some = frame.where(F.col(f"`{point_col}`").isNotNull()).withColumn("__tw_pk", F.explode(F.array(*bins)))
        return some.withColumns({"__tw_plvl": F.col("__tw_pk.l"), "__tw_pbin": F.col("__tw_pk.b")}).drop("__tw_pk")

    helpers = ("__tw_plvl", "__tw_pbin", "__tw_rlvl", "__tw_rbin")

    def meet(frame: DataFrame, join_how: str) -> DataFrame:
        cond = (
            (F.col(f"{point_alias}.__tw_plvl") == F.col(f"{range_alias}.__tw_rlvl"))
            & (F.col(f"{point_alias}.__tw_pbin") == F.col(f"{range_alias}.__tw_rbin"))
            & residual(point_alias, range_alias)
        )
        return frame.alias(point_alias).join(binned.alias(range_alias), cond, join_how).drop(*helpers)

    def inner() -> DataFrame:
        pts = at_levels(points)
        if not small_ranges and fits_broadcast(pts, max_broadcast_bytes):
            pts = F.broadcast(pts)  # few points: the ranges stream
        return meet(pts, "inner")

    if how == "inner":
        return project(inner(), select_columns)
    by = list(dict.fromkeys([*[lk for lk, _ in keys], point_col]))
    matched = meet(at_levels(points.select(*[F.col(f"`{c}`") for c in by]).distinct()), "left_semi")
    matched = matched.select(*[F.col(f"`{c}`").alias(f"__tw_m{i}") for i, c in enumerate(by)])
    same = reduce(operator.and_, [qualified(point_alias, c) == F.col(f"__tw_m{i}") for i, c in enumerate(by)])
    if how in ("left_semi", "left_anti"):
        return project(points.alias(point_alias).join(matched, same, how), select_columns)
    alone = points.alias(point_alias).join(matched, same, "left_anti")
    alone = alone.alias(point_alias).join(ranges.where(F.lit(False)).alias(range_alias), F.lit(False), "left")
    return project(inner(), select_columns).union(project(alone, select_columns))


DEFAULT_RANGE_BINS = 64
#: Pairs of rows with equal keys that one task of a range join is to compare.
PAIRS_PER_CELL = 1 << 25
_MAX_CELL_PARTITIONS = 1 << 14


def range_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    range_condition: str = ">=",
    select_columns: Sequence[str | Column] | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    num_bins: int = DEFAULT_RANGE_BINS,
    join_keys: KeySpec | None = None,
    how: str = "inner",
) -> DataFrame:
    """Join on ``left_table.left_key <op> right_table.right_key`` (and equal ``join_keys``).

    ``op`` is one of ``>=``, ``<=``, ``>``, ``<``.  The comparison is made on the
    original columns on every path, so the rows never depend on the plan.

    * With ``join_keys`` it is an equi-join with the comparison as residual.  Where
      the keys meet in more than ``PAIRS_PER_CELL`` pairs, the pairs of a key are
      dealt to cells of about that many, so few keys keep all tasks busy and no
      task holds a whole key.
    * Without, the output is a large share of all pairs, whatever the plan.  A
      side measured at most ``max_broadcast_bytes`` (right first, then left) is
      broadcast; otherwise the right key is cut at its quantiles (finite or
      clamped, one aggregate job), each left row is copied into the bins that
      can hold a partner and each right row goes to its own, and the join is an
      equi-join on the bin.  Quantiles keep the bins even; NaN and infinities
      fall into the outer bins.  AQE splits bins that many left rows reach.

    Semi and anti joins make no pairs.  A left row has a partner exactly if it
    passes the smallest right key of its group (the largest for ``<=`` and
    ``<``), so the right side is aggregated to one row per group, combined before
    its shuffle, and joined once; without keys that is one value, a scalar
    subquery.  A left join is the inner join and the left rows that the anti
    join keeps.
    """
    how = normalize_join_type(how)
    if how not in LEFT_STREAMED:
        raise ValueError("range_join preserves the left side only: inner, left, left_semi, left_anti")
    if range_condition not in RANGE_OPS:
        raise ValueError(f"range_condition must be one of {sorted(RANGE_OPS)}, got {range_condition!r}")
    compare = RANGE_OPS[range_condition](F.col(f"{LEFT}.`{left_key}`"), F.col(f"{RIGHT}.`{right_key}`"))
    ctype = common_type([field_type(left, left_key), field_type(right, right_key)])
    if how == "left":
        inner = range_join(left, right, left_key, right_key, range_condition, select_columns, max_broadcast_bytes, num_bins, join_keys)
        alone = range_join(left, right, left_key, right_key, range_condition, join_keys=join_keys, max_broadcast_bytes=max_broadcast_bytes, how="left_anti")
        return inner.union(project(unmatched(alone, right), select_columns))
    if how != "inner":
        return project(_partnered(left, right, left_key, right_key, range_condition, join_keys, how, max_broadcast_bytes), select_columns)
    lft, rgt = left.alias(LEFT), right.alias(RIGHT)
    if join_keys:
        pairs = key_pairs(join_keys)
        cells = _in_cells(left, right, pairs)
        if cells:
            lft, rgt, same = cells
            return project(lft.join(rgt, same & compare, "inner").drop(*_cell_columns(pairs)), select_columns)
        cond = reduce(operator.and_, [qualified(LEFT, lk) == qualified(RIGHT, rk) for lk, rk in pairs], compare)
        if fits_broadcast(right, max_broadcast_bytes):
            rgt = F.broadcast(rgt)
        return project(lft.join(rgt, cond, "inner"), select_columns)
    if fits_broadcast(right, max_broadcast_bytes):
        return project(lft.join(F.broadcast(rgt), compare, "inner"), select_columns)
    if fits_broadcast(left, max_broadcast_bytes):
        return project(F.broadcast(lft).join(rgt, compare, "inner"), select_columns)

    r_ord, l_ord = ordinal(F.col(f"`{right_key}`"), ctype), ordinal(F.col(f"`{left_key}`"), ctype)
    k = max(int(num_bins), 1)
    cuts = right.agg(F.percentile_approx(r_ord, [i / k for i in range(1, k)] or [0.5]).alias("cuts")).collect()[0]["cuts"]
    edges = sorted(set(cuts or []))
    last = len(edges)

    def bin_of(ordinal: Column) -> Column:
        """How many edges lie at or below the ordinal: monotone, 0 to ``last``."""
        return reduce(operator.add, [(ordinal >= F.lit(edge)).cast("int") for edge in edges], F.lit(0))

    rgt = right.where(F.col(f"`{right_key}`").isNotNull()).withColumn("__tw_rbin", bin_of(r_ord))
    low, high = (F.lit(0), bin_of(l_ord)) if range_condition in (">=", ">") else (bin_of(l_ord), F.lit(last))
    lft = left.where(F.col(f"`{left_key}`").isNotNull()).withColumn("__tw_lbin", F.explode(F.sequence(low, high)))
    cond = (F.col(f"{LEFT}.__tw_lbin") == F.col(f"{RIGHT}.__tw_rbin")) & compare
    out = lft.alias(LEFT).join(rgt.alias(RIGHT), cond, "inner").drop("__tw_lbin", "__tw_rbin")
    return project(out, select_columns)


def _cell_columns(pairs: Sequence[tuple[str, str]]) -> list[str]:
    return [*[f"__tw_k{i}" for i in range(len(pairs))], "__tw_lcell", "__tw_rcell"]


def _in_cells(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame, Column] | None:
    """Both sides dealt to cells of at most about ``PAIRS_PER_CELL`` pairs, and when two rows meet.

    ``None`` where the keys meet in no more pairs than that (or their types differ,
    other than whole numbers of two widths).  A key's rows are cut by a hash of the
    whole row into slices, about as long on both sides, and each slice meets each
    slice of the other side in a cell of its own: a pair meets exactly once.  The
    copies this takes are about ``2 / sqrt(PAIRS_PER_CELL)`` of the pairs.  Exact
    copies of a row share a slice.
    """
    columns = _cell_columns(pairs)
    keys, whole_number = columns[:-2], (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    types = [(field_type(left, lk), field_type(right, rk)) for lk, rk in pairs]
    if not all(lt == rt or isinstance(lt, whole_number) and isinstance(rt, whole_number) for lt, rt in types):
        return None
    if left.count() * right.count() <= PAIRS_PER_CELL:
        return None

    def keyed(df: DataFrame, side: int) -> DataFrame:
        names = [p[side] for p in pairs]
        cast = [F.col(f"`{c}`") if lt == rt else F.col(f"`{c}`").cast("long") for c, (lt, rt) in zip(names, types)]
        return df.where(reduce(operator.and_, [F.col(f"`{c}`").isNotNull() for c in names])).withColumns(dict(zip(keys, cast)))

    lft, rgt = keyed(left, 0), keyed(right, 1)
    met = lft.groupBy(*keys).agg(F.count(F.lit(1)).alias("__tw_ln")).join(rgt.groupBy(*keys).agg(F.count(F.lit(1)).alias("__tw_rn")), keys)
    ln, rn = F.col("__tw_ln"), F.col("__tw_rn")
    in_all = met.agg(F.sum(ln.cast("double") * rn)).first()[0] or 0.0
    if in_all <= PAIRS_PER_CELL:
        return None
    side = F.lit(PAIRS_PER_CELL**0.5)
    hot = met.where(ln.cast("double") * rn > PAIRS_PER_CELL).select(
        *keys,
        F.ceil(ln / F.greatest(side, F.lit(PAIRS_PER_CELL) / rn)).alias("__tw_lslices"),
        F.ceil(rn / F.greatest(side, F.lit(PAIRS_PER_CELL) / ln)).alias("__tw_rslices"),
    )
    n = min(max(2 * math.ceil(in_all / PAIRS_PER_CELL), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))), _MAX_CELL_PARTITIONS)

    def dealt(df: DataFrame, names: Sequence[str], own: str, other: str) -> DataFrame:
        whole = F.xxhash64(*[F.col(f"`{c}`") for c in names if "map<" not in field_type(df, c).simpleString()])
        slices = {c: F.coalesce(F.col(f"__tw_{c}slices"), F.lit(1)).cast("long") for c in "lr"}
        # each of the hot keys stands for over PAIRS_PER_CELL pairs of the output's candidates
        rows = df.join(F.broadcast(hot), keys, "left").withColumn(f"__tw_{own}cell", F.pmod(whole, slices[own]))
        rows = rows.withColumn(f"__tw_{other}cell", F.explode(F.sequence(F.lit(0).cast("long"), slices[other] - 1)))
        return rows.drop("__tw_lslices", "__tw_rslices").repartition(n, *columns)

    same = reduce(operator.and_, [qualified(LEFT, c) == qualified(RIGHT, c) for c in columns])
    return dealt(lft, left.columns, "l", "r").alias(LEFT), dealt(rgt, right.columns, "r", "l").alias(RIGHT), same


def _partnered(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, op: str, join_keys: KeySpec | None, how: str, max_broadcast_bytes: int
) -> DataFrame:
    """Left rows with (or without) a right row that ``op`` accepts, from one extreme per group."""
    extreme = (F.min if op in (">=", ">") else F.max)(F.col(f"`{right_key}`")).alias("__tw_extreme")
    if not join_keys:
        passes = F.coalesce(RANGE_OPS[op](F.col(f"`{left_key}`"), right.agg(extreme).scalar()), F.lit(False))
        return left.where(passes if how == "left_semi" else ~passes).alias(LEFT)
    pairs = key_pairs(join_keys)
    groups = right.groupBy(*[F.col(f"`{rk}`").alias(f"__tw_k{i}") for i, (_, rk) in enumerate(pairs)]).agg(extreme)
    if fits_broadcast(groups, max_broadcast_bytes):
        groups = F.broadcast(groups)
    cond = RANGE_OPS[op](qualified(LEFT, left_key), F.col("__tw_extreme"))
    cond = reduce(operator.and_, [qualified(LEFT, lk) == F.col(f"__tw_k{i}") for i, (lk, _) in enumerate(pairs)], cond)
    return left.alias(LEFT).join(groups, cond, how)


def multi_table_join(
    dataframes: Sequence[DataFrame],
    join_conditions: Sequence[dict[str, Any]],
    select_columns: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Fold ``dataframes`` (named ``table_0``, ``table_1``, ...) left to right.

    Each condition is ``{"left_table", "right_table", "left_key", "right_key",
    "join_type"}``; the table names default to the previous and the next table
    in order, ``join_type`` to inner.  Keys may be lists for composite keys.
    """
    if not dataframes:
        raise ValueError("dataframes must not be empty")
    names = [f"table_{i}" for i in range(len(dataframes))]
    result = dataframes[0].alias(names[0])
    joined = {names[0]}
    for i, cond in enumerate(join_conditions):
        right_name = cond.get("right_table", f"table_{i + 1}")
        left_name = cond.get("left_table", f"table_{i}")
        if right_name not in names:
            raise ValueError(f"unknown table {right_name!r}; frames are named {names}")
        if right_name in joined:
            raise ValueError(f"{right_name} is already part of the join")
        if left_name not in joined:
            raise ValueError(f"{left_name} is not joined yet when {right_name} is added")
        lkeys, rkeys = cond["left_key"], cond["right_key"]
        lkeys = [lkeys] if isinstance(lkeys, str) else list(lkeys)
        rkeys = [rkeys] if isinstance(rkeys, str) else list(rkeys)
        if len(lkeys) != len(rkeys):
            raise ValueError("left_key and right_key must have the same length")
        on = reduce(
            operator.and_,
            [qualified(left_name, a) == qualified(right_name, b) for a, b in zip(lkeys, rkeys)],
        )
        how = normalize_join_type(cond.get("join_type", "inner"))
        right_df = dataframes[names.index(right_name)].alias(right_name)
        result = result.join(right_df, on, how)
        joined.add(right_name)
    return project(result, select_columns)


def _side(alias: str, name: str) -> Column:
    return F.col(name) if "." in name else qualified(alias, name)


def coalesce_join(
    left: DataFrame,
    right: DataFrame,
    join_keys: Sequence[str],
    coalesce_columns: dict[str, Sequence[str]],
    how: str = "full_outer",
    split_full_outer: bool = True,
) -> DataFrame:
    """Full outer join on ``join_keys`` that prefers left values, then right.

    The full outer join treats hot keys apart (see ``equi_join``) unless
    ``split_full_outer`` is false.

    ``coalesce_columns`` maps an output name to ``[left_column, right_column]``
    (plain names are looked up on their own side).  Output: the keys, every
    other column (a column on both sides is coalesced the same way, left
    first), then the requested coalesced columns.
    """
    how = normalize_join_type(how)
    keys = list(join_keys)
    outputs = dict(coalesce_columns)
    cols: list[Column] = [F.col(f"`{k}`") for k in keys]
    seen = set(keys) | set(outputs)
    right_names = set(right.columns)
    for c in left.columns:
        if c in seen:
            continue
        seen.add(c)
        if c in right_names:
            cols.append(F.coalesce(qualified(LEFT, c), qualified(RIGHT, c)).alias(c))
        else:
            cols.append(qualified(LEFT, c).alias(c))
    for c in right.columns:
        if c not in seen:
            seen.add(c)
            cols.append(qualified(RIGHT, c).alias(c))
    for out_name, pair in outputs.items():
        lname, rname = pair
        cols.append(F.coalesce(_side(LEFT, lname), _side(RIGHT, rname)).alias(out_name))
    if how == "full_outer" and split_full_outer:
        return _full_outer(left, right, [(k, k) for k in keys], lambda joined: joined.select(*cols))
    return left.alias(LEFT).join(right.alias(RIGHT), keys, how).select(*cols)


def coalesce_many(
    frames: Sequence[DataFrame], join_keys: Sequence[str], columns: Sequence[str] | None = None, validate: bool = True
) -> DataFrame:
    """Full outer join of any number of frames that prefers earlier frames' values.

    Output: the keys, then ``columns`` (default: every column of any frame, in
    order of first appearance); each is the first non-NULL value in the order of
    ``frames``.  Keys are unique within a frame; with ``validate`` a repeated key
    fails the query itself (``raise_error``).  A row with a NULL key matches
    nothing and comes out alone.

    Plan: the frames are put under each other with their place in the order, and
    one aggregate per key takes each column's value of the smallest place that
    has one.  That is one shuffle and one scan per frame, however many frames; a
    chain of full outer joins shuffles the growing result again and again.
    """
    keys = list(join_keys)
    if not frames or not keys:
        raise ValueError("frames and join_keys must not be empty")
    found = list(dict.fromkeys(c for df in frames for c in df.columns if c not in keys))
    wanted = found if columns is None else list(columns)
    if unknown := sorted(set(wanted) - set(found)):
        raise ValueError(f"no frame has the columns {unknown}")
    placed = [
        df.select(*[F.col(f"`{c}`") for c in (*keys, *wanted) if c in df.columns], F.lit(i).alias("__tw_place")) for i, df in enumerate(frames)
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
    all_set = reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    firsts = [F.min_by(f"`{c}`", F.when(F.col(f"`{c}`").isNotNull(), F.col("__tw_place"))).alias(c) for c in wanted]
    # places are unique per key exactly if there are as many as distinct ones
    repeated = F.count("__tw_place") != F.size(F.collect_set("__tw_place"))
    merged = rows.where(all_set).groupBy(*keys).agg(*firsts, repeated.alias("__tw_repeated"))
    if validate:
        shown = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))
        message = F.concat(F.lit("a frame has more than one row for key "), shown)
        merged = merged.where(F.when(F.col("__tw_repeated"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    out = [F.col(f"`{c}`") for c in (*keys, *wanted)]
    return merged.select(*out).unionByName(rows.where(~all_set).select(*out))


def broadcast_join(
    large: DataFrame,
    small: DataFrame,
    join_keys: KeySpec,
    join_type: str = "inner",
    broadcast_threshold_mb: float = 10,
    select_columns: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Equi-join that broadcasts ``small`` once a bounded job has measured it.

    The hint is added only when ``small`` is at most ``broadcast_threshold_mb``
    (measured, see ``sizing.measured_size``) and the join type streams the
    large side (inner, left, semi, anti): a right or full join must stream the
    side it preserves, so there the join runs as an ordinary shuffle join.  The
    session's settings are never changed; above the bound AQE may still pick a
    broadcast at run time from the real shuffle size.
    """
    how = normalize_join_type(join_type)
    max_bytes = int(broadcast_threshold_mb * 1024 * 1024)
    if how in LEFT_STREAMED and fits_broadcast(small, max_bytes):
        small = F.broadcast(small)
    return equi_join(large, small, join_keys, how, select_columns)


def bucketed_join(
    spark: SparkSession,
    left_table: str,
    right_table: str,
    join_keys: KeySpec,
    left_catalog: str | None = None,
    right_catalog: str | None = None,
    join_type: str = "inner",
    select_columns: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Join two catalog tables bucketed on the join keys.

    With equal bucket counts and keys equal to the bucket columns, the
    sort-merge join reads bucket ``i`` of both sides in task ``i``: no
    exchange on either side (see ``write_bucketed``).  Other bucket specs give
    the same rows through a shuffle; that is logged as a warning.
    """
    names = qualified_name(left_table, left_catalog), qualified_name(right_table, right_catalog)
    pairs = key_pairs(join_keys)
    specs = [bucket_spec(spark, name) for name in names]
    for name, (columns, _), keys in zip(names, specs, zip(*pairs)):
        if columns is None or set(columns) != set(keys):
            _log.warning("%s is bucketed by %s, not by the join keys %s: the join shuffles it", name, columns, list(keys))
    if specs[0][1] != specs[1][1]:
        _log.warning("%s and %s have %s and %s buckets: the join shuffles one of them", *names, specs[0][1], specs[1][1])
    left, right = (spark.table(name) for name in names)
    return equi_join(left, right, join_keys, join_type, select_columns)


# The join strategy names callers pass, as in the reference.
JOIN_STRATEGIES = ("basic", "advanced", "broadcast", "bucket")


def join_data(
    left: DataFrame | str,
    right: DataFrame | str,
    join_keys: KeySpec | None = None,
    strategy: str = "basic",
    join_type: str = "inner",
    **kwargs: Any,
) -> DataFrame:
    """One entry point over the join functions.

    * ``basic``: ``equi_join`` (``select_columns``).
    * ``advanced``: ``interval_join`` when ``point_col``/``start_col``/``end_col``
      are given, ``range_join`` when ``left_key``/``right_key`` are (``band_join``
      with ``below`` too), ``overlap_join`` for ``left_start``/``left_end``/
      ``right_start``/``right_end``, ``disjunctive_join`` for ``alternatives``,
      else ``conditional_join`` with ``join_condition``.
    * ``broadcast``: ``broadcast_join`` (``broadcast_threshold_mb``).
    * ``bucket``: ``bucketed_join``; ``left``/``right`` are table names.
    """
    if strategy not in JOIN_STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; use one of {JOIN_STRATEGIES}")
    how = normalize_join_type(join_type)
    select_columns = kwargs.pop("select_columns", None)
    if strategy == "basic":
        return equi_join(left, right, join_keys, how, select_columns)
    if strategy == "broadcast":
        return broadcast_join(left, right, join_keys, how, select_columns=select_columns, **kwargs)
    if strategy == "bucket":
        spark = kwargs.pop("spark", None) or SparkSession.getActiveSession()
        return bucketed_join(
            spark, left, right, join_keys, join_type=how, select_columns=select_columns, **kwargs
        )
    if "point_col" in kwargs:
        return interval_join(
            left, right, kwargs.pop("point_col"), kwargs.pop("start_col"), kwargs.pop("end_col"),
            how, select_columns, **kwargs,
        )
    if "left_key" in kwargs:
        if "below" in kwargs:
            return band_join(
                left, right, kwargs.pop("left_key"), kwargs.pop("right_key"), kwargs.pop("below"), how=how,
                select_columns=select_columns, join_keys=join_keys, **kwargs,
            )
        return range_join(
            left, right, kwargs.pop("left_key"), kwargs.pop("right_key"),
            kwargs.pop("range_condition", ">="), select_columns, join_keys=join_keys, how=how, **kwargs,
        )
    if "left_start" in kwargs:
        names = [kwargs.pop(c) for c in ("left_start", "left_end", "right_start", "right_end")]
        return overlap_join(left, right, *names, how, select_columns, join_keys=join_keys, **kwargs)
    if "alternatives" in kwargs:
        return disjunctive_join(left, right, kwargs.pop("alternatives"), how, select_columns, **kwargs)
    if "join_condition" not in kwargs:
        raise ValueError("the advanced strategy needs join_condition, left_key/right_key or point_col")
    return conditional_join(left, right, kwargs.pop("join_condition"), select_columns, how, **kwargs)
