"""Size checks that stand behind every explicit broadcast.

A side is broadcast only when bounded jobs have measured it: they read about
``max_rows + 1`` rows at most, so they cost little even when the side turns out
to be huge, and the answer is a measured byte count, not an optimizer estimate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024

# Fixed per-row and per-field costs of Spark's binary row format (UnsafeRow):
# an 8-byte null bitset word per 64 fields and one 8-byte slot per field.
_WORD = 8


def _variable_bytes(field: T.StructField) -> Column | None:
    dtype = field.dataType
    c = F.col(f"`{field.name}`")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return None


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row in Spark's binary row layout (variable parts measured)."""
    fields = df.schema.fields
    fixed = _WORD * (len(fields) + (len(fields) + 63) // 64)
    parts = [p for p in (_variable_bytes(f) for f in fields) if p is not None]
    variable = reduce(lambda a, b: a + b, parts, F.lit(0))
    return F.lit(fixed).cast("long") + variable.cast("long")


def measured_size(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> int | None:
    """Exact byte size of ``df`` if it is at most ``max_bytes``, else ``None``.

    Two bounded jobs.  First ``offset(max_rows).take(1)``: Spark's collect-limit
    scans partitions incrementally (one, then more) and stops once
    ``max_rows + 1`` rows are seen, so a huge frame costs about ``max_rows``
    rows of reading, where ``max_rows = max_bytes // row_floor`` and
    ``row_floor`` is the fixed part of a row.  Only then, with the row count
    proven small, one aggregate sums the real row sizes.
    """
    if max_bytes <= 0:
        return None
    ncols = max(len(df.columns), 1)
    row_floor = _WORD * (ncols + (ncols + 63) // 64)
    max_rows = max_bytes // row_floor
    if df.select(F.lit(1).alias("one")).offset(max_rows).take(1):
        return None
    size = df.agg(F.sum(row_bytes(df)).alias("bytes")).collect()[0]["bytes"]
    size = int(size or 0)
    return size if size <= max_bytes else None


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return measured_size(df, max_bytes) is not None
