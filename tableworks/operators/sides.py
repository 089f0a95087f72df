"""What the join functions share: side names, key specs, join types and ordered keys."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEFT = "left_table"
RIGHT = "right_table"

JOIN_TYPES = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "leftouter": "left",
    "right": "right",
    "right_outer": "right",
    "rightouter": "right",
    "outer": "full_outer",
    "full": "full_outer",
    "full_outer": "full_outer",
    "fullouter": "full_outer",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
    "leftanti": "left_anti",
}

# Join types in which only the left side is preserved or filtered: a hint on
# the right side can serve them as a broadcast hash join.
LEFT_STREAMED = ("inner", "left", "left_semi", "left_anti")

KeySpec = Sequence["str | tuple[str, str]"]


def normalize_join_type(join_type: str) -> str:
    """Canonical Spark join type; unknown names and cross joins raise ``ValueError``."""
    key = join_type.strip().lower().replace(" ", "_")
    if key not in JOIN_TYPES:
        raise ValueError(
            f"unknown join type {join_type!r}; use one of {sorted(set(JOIN_TYPES.values()))}"
        )
    return JOIN_TYPES[key]


def key_pairs(join_keys: KeySpec) -> list[tuple[str, str]]:
    if isinstance(join_keys, str):
        join_keys = [join_keys]
    pairs = []
    for k in join_keys:
        if isinstance(k, str):
            pairs.append((k, k))
        else:
            left_key, right_key = k
            pairs.append((left_key, right_key))
    if not pairs:
        raise ValueError("join_keys must not be empty")
    return pairs


def qualified(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def project(df: DataFrame, select_columns: Sequence[str | Column] | None) -> DataFrame:
    """``select_columns`` entries are SQL text (names, qualified names,
    expressions with aliases) or Columns."""
    if not select_columns:
        return df
    return df.select(*[F.expr(c) if isinstance(c, str) else c for c in select_columns])


def unmatched(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows beside NULLs for the right side, which the optimizer fills in."""
    return left.alias(LEFT).join(right.where(F.lit(False)).alias(RIGHT), F.lit(False), "left")


def join_on(pairs: list[tuple[str, str]]) -> list[str] | Column:
    """Key names for a ``USING`` join, or an equality condition over the aliases."""
    if all(lk == rk for lk, rk in pairs):
        return [lk for lk, _ in pairs]
    return reduce(operator.and_, [qualified(LEFT, lk) == qualified(RIGHT, rk) for lk, rk in pairs])


# ---------------------------------------------------------------------------
# Ordered keys: a monotone image of numbers, dates and timestamps as doubles,
# used only to place rows into bins; the comparison itself is always made on
# the original columns, with Spark's own coercion.

# Ordinals end here: infinities and NaN (which Spark orders above all) fall into
# the outermost bins.  A power of two, so bin edges stay exact.
EDGE = 2.0**1000


def common_type(types: list[T.DataType]) -> T.DataType:
    if any(isinstance(t, T.TimestampType) for t in types):
        return T.TimestampType()
    if any(isinstance(t, T.TimestampNTZType) for t in types):
        return T.TimestampNTZType()
    if any(isinstance(t, T.DateType) for t in types):
        if all(isinstance(t, T.DateType) for t in types):
            return T.DateType()
        raise ValueError(f"cannot order a date against {types}")
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    raise ValueError(f"range and interval keys must be numbers, dates or timestamps, got {types}")


def ordinal(c: Column, dtype: T.DataType) -> Column:
    """Monotone non-decreasing double for ``c``, within ``[-EDGE, EDGE]``; NULL stays NULL."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c.cast(dtype)).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        c = c.cast(dtype)
        # Wall-clock seconds, independent of the session time zone.
        seconds = F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        return seconds.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    d = c.cast("double")
    clamped = F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), d))
    return F.when(d.isNull(), d).when(F.isnan(d), F.lit(EDGE)).otherwise(clamped)


def lowest_level(dtype: T.DataType) -> int:
    """Exponent of the narrowest bin worth using for ``dtype``'s ordinal."""
    if isinstance(dtype, T.TimestampType):
        return 20  # about a second
    return 0 if isinstance(dtype, (T.TimestampNTZType, T.DateType)) else -40


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


START_OPS: dict[str, Callable[[Column, Column], Column]] = {">=": operator.ge, ">": operator.gt}
END_OPS: dict[str, Callable[[Column, Column], Column]] = {"<=": operator.le, "<": operator.lt}
RANGE_OPS: dict[str, Callable[[Column, Column], Column]] = {
    ">=": operator.ge,
    "<=": operator.le,
    ">": operator.gt,
    "<": operator.lt,
}
