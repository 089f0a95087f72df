"""A bitmap of a source's keys, so that a load doesn't move target rows it can't touch.

An upsert or history load joins the target to its source.  With a source too large
to broadcast, Spark shuffles the whole target, though most of its rows meet no
source key.  A bitmap of the keys' hashes has a fixed size however long the keys
are: it is built by one aggregate (``bitmap_construct_agg``, combined before its
shuffle), broadcast, and tells for every target row whether it may have a partner.
A set bit may be a collision, an unset bit is proof; so rows without their bit pass
by the join, and the join itself stays exact.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest bitmap that is broadcast: 2**27 bits.
MAX_FILTER_BYTES = 16 << 20

# Fixed value: bits in one binary of ``bitmap_construct_agg``.
_BITS_PER_ROW = 32768

#: Bits per source key: about one target row in nine without a partner is taken along.
_BITS_PER_KEY = 8

_EXACT = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def comparable(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> bool:
    """Whether equal keys surely have equal hashes: same types, and none with two forms of one value."""
    for lk, rk in pairs:
        a, b = left.schema[lk].dataType, right.schema[rk].dataType
        plain_text = isinstance(a, T.StringType) and a == T.StringType()
        if a != b or not (isinstance(a, (*_EXACT, T.DecimalType)) or plain_text):
            return False
    return True


def filter_bits(source_rows: int, target_rows: int, max_bytes: int = MAX_FILTER_BYTES) -> int:
    """Bits for a filter of so many keys, or 0 where it wouldn't pay.

    It pays where at least half of the target can have no partner and the bits
    fit ``max_bytes``.
    """
    bits = _BITS_PER_ROW
    while bits < _BITS_PER_KEY * source_rows:
        bits *= 2
    return bits if 2 * source_rows <= target_rows and bits <= 8 * max_bytes else 0


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(bits))


def key_bitmap(source: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(bucket, bitmap) rows: which hashes of the keys occur; at most ``bits / 8`` bytes in all."""
    if bits % _BITS_PER_ROW:
        raise ValueError(f"bits must be a multiple of {_BITS_PER_ROW}")
    all_set = reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    places = source.where(all_set).select(_place(keys, bits).alias("h"))
    return places.groupBy(F.bitmap_bucket_number("h").alias("__tw_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("__tw_bitmap")
    )


def with_may_match(target: DataFrame, source: DataFrame, keys: Sequence[str], bits: int, flag: str) -> DataFrame:
    """``target`` with a boolean column ``flag``: false only for rows whose key is in no source row."""
    h = _place(keys, bits)
    position = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(F.col("__tw_bitmap"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, F.pmod(position, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    marked = target.withColumn("__tw_b", F.bitmap_bucket_number(h)).join(
        F.broadcast(key_bitmap(source, keys, bits)), F.col("__tw_b") == F.col("__tw_bucket"), "left"
    )
    all_set = reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    return marked.withColumn(flag, all_set & F.coalesce(is_set, F.lit(False))).drop("__tw_b", "__tw_bucket", "__tw_bitmap")


def split_by_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], max_bytes: int = MAX_FILTER_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """(rows that may have a source row, rows that can't), or (target, ``None``) where a filter wouldn't pay.

    Two counts decide; both read key columns at most (a Parquet target's count
    comes from file footers).
    """
    keys = list(keys)
    if max_bytes <= 0 or not comparable(target, source, [(k, k) for k in keys]):
        return target, None
    bits = filter_bits(source.select(*keys).count(), target.count(), max_bytes)
    if not bits:
        return target, None
    flag = "__tw_may"
    marked = with_may_match(target, source, keys, bits, flag)
    return marked.where(flag).drop(flag), marked.where(~F.col(flag)).drop(flag)
