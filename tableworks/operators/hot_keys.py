"""Keys that hold a large share of a table's rows, found by a heavy-hitter sketch.

Most joins and writes need no care; a few keys do.  One aggregate over the key
columns (``approx_top_k``, a few kilobytes per task, no shuffle of rows) names
them, so that only their rows are treated apart and all others take Spark's plain
plan.  A key is known by a hash: another key with the same hash is treated as hot
too, which changes where its rows go, never the result.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableworks.operators.key_filter import comparable
from tableworks.operators.sides import LEFT, RIGHT, join_on, key_pairs, qualified

#: A key with a larger share of its table's rows is hot; so at most a hundred are.
HOT_SHARE = 0.01
#: A key with fewer rows is no burden to a task, whatever its share of a small table.
HOT_ROWS = 1000
_TRACKED = 10_000


def _key_hash(keys: Sequence[str], alias: str | None = None) -> Column:
    return F.xxhash64(*[qualified(alias, k) if alias else F.col(f"`{k}`") for k in keys])


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, least: int = HOT_ROWS) -> tuple[dict[int, int], int]:
    """({hash of a hot key: about how many rows}, rows in all); rows with a NULL key don't count as hot.

    One job over the key columns.  Counts of the sketch are off by at most
    ``3.5 / 10,000`` of the rows.
    """
    h = F.when(_all_set(keys), _key_hash(keys))
    most = min(int(1 / share) + 1, 1000)
    row = df.select(h.alias("h")).agg(F.expr(f"approx_top_k(h, {most}, {_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    enough = max(share * row["n"], least)
    return {t["item"]: t["count"] for t in row["top"] or [] if t["item"] is not None and t["count"] > enough}, row["n"]


def full_outer_hot(
    left: DataFrame,
    right: DataFrame,
    join_keys: Sequence[str | tuple[str, str]],
    select: Callable[[DataFrame], DataFrame] = lambda joined: joined,
    share: float = HOT_SHARE,
    least: int = HOT_ROWS,
) -> DataFrame | None:
    """Full outer join in which every row is shuffled once, also with hot keys.

    AQE can't split a partition of a full outer join.  So the rows of hot keys,
    of either side, are joined apart: an inner join, which AQE splits, and the
    rows whose key the other side doesn't have, found by broadcasting the distinct
    hot keys (a hundred or so).  All other rows are one full outer join.  Rows with
    a NULL key match nothing and are not shuffled at all.  ``None`` if the key
    columns differ in type or have values equal in more than one form, where
    hashes can't name a key.
    """
    pairs = key_pairs(join_keys)
    lkeys, rkeys = [a for a, _ in pairs], [b for _, b in pairs]
    if not comparable(left, right, pairs):
        return None
    hot = sorted({*hot_keys(left, lkeys, share, least)[0], *hot_keys(right, rkeys, share, least)[0]})
    on = join_on(pairs)

    def parts(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
        usual = df.where(_all_set(keys))
        null = df.where(~_all_set(keys))
        is_hot = _key_hash(keys).isin(hot)
        return usual.where(~is_hot) if hot else usual, usual.where(is_hot), null

    (l_rest, l_hot, l_null), (r_rest, r_hot, r_null) = parts(left, lkeys), parts(right, rkeys)
    # frames without rows give a missing side its columns
    no_right, no_left = right.where(F.lit(False)).alias(RIGHT), left.where(F.lit(False)).alias(LEFT)

    def left_only(rows: DataFrame) -> DataFrame:
        return select(rows.alias(LEFT).join(no_right, on, "left"))

    def right_only(rows: DataFrame) -> DataFrame:
        return select(no_left.join(rows.alias(RIGHT), on, "right"))

    found = [select(l_rest.alias(LEFT).join(r_rest.alias(RIGHT), on, "full_outer")), left_only(l_null), right_only(r_null)]
    if hot:
        l_some, r_some = (F.broadcast(rows.select(*keys).distinct()) for rows, keys in ((l_hot, lkeys), (r_hot, rkeys)))
        found.append(select(l_hot.alias(LEFT).join(r_hot.alias(RIGHT), on, "inner")))
        found.append(left_only(l_hot.alias(LEFT).join(r_some.alias(RIGHT), on, "left_anti")))
        found.append(right_only(r_hot.alias(RIGHT).join(l_some.alias(LEFT), on, "left_anti")))
    return reduce(DataFrame.union, found)


def dealt_to_buckets(df: DataFrame, bucket_columns: Sequence[str], num_buckets: int, files_per_bucket: int, share: float = HOT_SHARE) -> DataFrame:
    """``df`` with every partition holding rows of one bucket, and no partition much larger than the others.

    A row's bucket is Spark's own: Murmur3 of the bucket columns modulo
    ``num_buckets``; hash partitioning into a multiple of it keeps buckets apart.
    The rows of a hot key, which all hash to one partition, are dealt by a hash of
    the whole row to partitions of their own, as many as make them as large as the
    rest.  The place depends on the row alone, so a task that runs again deals
    alike.  (Rows equal in all columns stay together.)
    """
    base = num_buckets * files_per_bucket
    hot, rows = hot_keys(df, bucket_columns, share)
    usual = max(rows - sum(hot.values()), 1) / base
    extra: list[tuple[int, int, int]] = []  # (hash, first partition, partitions)
    parts = base
    for h, count in sorted(hot.items()):
        n = max(1, round(count / usual)) if count > usual else 0
        n = min(n, base)
        if n > 1:
            extra.append((h, parts, n))
            parts += n
    if not extra:
        return df.repartition(base, *[F.col(f"`{c}`") for c in bucket_columns])
    key, whole = _key_hash(bucket_columns), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    place = F.pmod(F.hash(*[F.col(f"`{c}`") for c in bucket_columns]), F.lit(base))
    for h, first, n in extra:
        place = F.when(key == F.lit(h), F.lit(first) + F.pmod(whole, F.lit(n))).otherwise(place)
    return df.repartitionById(parts, place.cast("int"))
