"""SCD type 2 from a change feed: several versions of a key in one load."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.operators.key_filter import MAX_FILTER_BYTES, split_by_keys
from tableworks.operators.loads import EFFECTIVE_DATE, EXPIRY_DATE, IS_CURRENT, SCD_COLUMNS, check_unique_keys
from tableworks.operators.sizing import DEFAULT_BROADCAST_BYTES, fits_broadcast

#: Versions of one key that are chained in one task; a key with more is cut along time.
MAX_VERSIONS = 1_000_000
_MOST_CUTS = 4096


def scd2_feed(
    history: DataFrame,
    feed: DataFrame,
    business_keys: Sequence[str],
    time_col: str,
    validate: bool = True,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    max_filter_bytes: int = MAX_FILTER_BYTES,
    max_versions: int = MAX_VERSIONS,
) -> DataFrame:
    """New history after all changes of ``feed``, in the order of ``time_col``.

    The rows are those that ``scd2_apply`` would give for one batch per time, in
    order: a version that differs (NULL-safe) from the one before it starts at its
    time and ends it; a version equal to the one before it is merged into it;
    keys missing from the feed and expired versions are untouched.  A change that
    is not later than the key's current version fails the write.  With
    ``validate`` (key, time) must be unique and not NULL.

    Plan: current versions that can have a change (a small feed is broadcast, a
    larger one gives a bitmap of its keys) and the feed meet in one shuffle on the
    keys.  There one window over each key's versions compares each with the one
    before it, and a second gives each kept version the start of the next as its
    end.  A key with more than ``max_versions`` versions is cut along time: each
    cut is sorted in a task of its own, and its neighbours' last and first
    versions are handed on in one row per cut.
    """
    keys = list(business_keys)
    if not keys:
        raise ValueError("business_keys must be provided for SCD type 2")
    missing = [c for c in SCD_COLUMNS if c not in history.columns]
    if missing:
        raise ValueError(f"history lacks columns {missing}")
    data_cols = [c for c in history.columns if c not in SCD_COLUMNS]
    if set(feed.columns) != {*data_cols, time_col} or time_col in data_cols:
        raise ValueError(f"the feed has the columns {sorted(feed.columns)}, not {sorted(data_cols)} and its time")
    if validate:
        check_unique_keys(feed, [*keys, time_col], "feed")
    types = {f.name: f.dataType for f in history.schema.fields}
    time_type = types[EFFECTIVE_DATE]
    changes = feed.select(
        *[F.col(f"`{c}`").cast(types[c]).alias(c) for c in data_cols],
        F.col(f"`{time_col}`").cast(time_type).alias("__tw_at"),
        F.lit(False).alias("__tw_seed"),
    )

    all_keys = reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    is_current = F.coalesce(F.col(IS_CURRENT), F.lit(False)) & all_keys
    passing, current = [history.where(~is_current)], history.where(is_current)
    feed_keys = changes.select(*keys).distinct()
    if fits_broadcast(feed_keys, max_broadcast_bytes):
        some = F.broadcast(feed_keys)
        passing.append(current.join(some, keys, "left_anti"))
        current = current.join(some, keys, "left_semi")
    else:
        current, apart = split_by_keys(current, feed_keys, keys, max_filter_bytes)
        passing += [] if apart is None else [apart]
    if validate:
        check_unique_keys(current, keys, "current versions of the history: ")
    seeds = current.select(*[F.col(f"`{c}`") for c in data_cols], F.col(EFFECTIVE_DATE).alias("__tw_at"), F.lit(True).alias("__tw_seed"))
    versions = seeds.unionByName(changes)

    state = F.struct(*[F.col(f"`{c}`") for c in data_cols])
    by_key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    cuts = _cuts(versions, keys, max_versions)
    if cuts is None:
        groups, order = by_key, [F.desc("__tw_seed"), F.asc("__tw_at")]
        rows = versions.withColumns({"__tw_carry": F.lit(False), "__tw_since": F.max(F.when(F.col("__tw_seed"), F.col("__tw_at"))).over(by_key)})
    else:
        rows = _carried(versions, cuts, keys, data_cols)
        groups = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], "__tw_chunk")
        order = [F.desc("__tw_carry"), F.desc("__tw_seed"), F.asc("__tw_at")]
    before = F.lag(state).over(groups.orderBy(*order))
    differs = before.isNull() | ~before.eqNullSafe(state)
    kept = rows.withColumn("__tw_kept", F.col("__tw_seed") | differs).where(F.col("__tw_kept") & ~F.col("__tw_carry"))
    ends = F.lead("__tw_at").over(groups.orderBy(F.desc("__tw_seed"), F.asc("__tw_at")))
    kept = kept.withColumn("__tw_end", ends)
    if cuts is not None:
        kept = _next_starts(kept, keys)

    late = ~F.col("__tw_seed") & (F.col("__tw_at") <= F.col("__tw_since"))
    shown = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))
    error = F.raise_error(F.concat(F.lit("changes must be later than the current version of key "), shown))
    chained = kept.select(
        *[F.col(f"`{c}`") for c in data_cols],
        F.col("__tw_at").alias(EFFECTIVE_DATE),
        F.when(late, error).otherwise(F.col("__tw_end").isNull()).alias(IS_CURRENT),
        F.col("__tw_end").cast(types[EXPIRY_DATE]).alias(EXPIRY_DATE),
    )
    return reduce(DataFrame.unionByName, [part.select(*history.columns) for part in (*passing, chained)])


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _cuts(versions: DataFrame, keys: list[str], max_versions: int) -> DataFrame | None:
    """Keys with more than ``max_versions`` versions, with times that part them evenly; ``None`` if there are none."""
    large = versions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__tw_n"), F.max(F.when(F.col("__tw_seed"), F.col("__tw_at"))).alias("__tw_since")
    ).where(F.col("__tw_n") > max_versions)
    most = large.agg(F.max("__tw_n")).first()[0]
    if most is None:
        return None
    parts = min(-(-most // max_versions), _MOST_CUTS)
    changes = versions.where(~F.col("__tw_seed")).join(large.select(*keys), keys, "left_semi")
    times = changes.groupBy(*keys).agg(F.percentile_approx(_micros(F.col("__tw_at")), [i / parts for i in range(1, parts)] or [0.5]).alias("__tw_cuts"))
    return large.select(*keys, "__tw_since").join(times, keys)


def _carried(versions: DataFrame, cuts: DataFrame, keys: list[str], data_cols: list[str]) -> DataFrame:
    """Versions with the cut they lie in, and in front of every cut of a large key the last version before it."""
    after = F.size(F.filter("__tw_cuts", lambda c: c <= _micros(F.col("__tw_at"))))
    chunk = F.when(F.col("__tw_seed") | F.col("__tw_cuts").isNull(), F.lit(0)).otherwise(after)
    placed = versions.join(cuts, keys, "left").withColumn("__tw_chunk", chunk)
    within = Window.partitionBy(*keys, "__tw_chunk")
    placed = placed.withColumn("__tw_since", F.coalesce("__tw_since", F.max(F.when(F.col("__tw_seed"), F.col("__tw_at"))).over(within)))
    others = [c for c in placed.columns if c not in (*keys, "__tw_chunk", "__tw_cuts")]
    # a seed comes before all changes of its key, whatever its time
    latest = F.struct(~F.col("__tw_seed"), F.col("__tw_at"))
    ends = placed.where(F.col("__tw_cuts").isNotNull()).groupBy(*keys, "__tw_chunk").agg(F.max_by(F.struct(*others), latest).alias("__tw_last"))
    following = F.lead("__tw_chunk").over(Window.partitionBy(*keys).orderBy("__tw_chunk"))
    carry = ends.withColumn("__tw_chunk", following).where(F.col("__tw_chunk").isNotNull()).select(*keys, "__tw_chunk", "__tw_last.*")
    carry = carry.withColumns({"__tw_carry": F.lit(True), "__tw_seed": F.lit(False)})
    return placed.drop("__tw_cuts").withColumn("__tw_carry", F.lit(False)).unionByName(carry)


def _next_starts(kept: DataFrame, keys: list[str]) -> DataFrame:
    """Kept versions at the end of a cut end where the next cut with a kept version starts."""
    starts = kept.groupBy(*keys, "__tw_chunk").agg(F.min_by("__tw_at", F.struct(~F.col("__tw_seed"), F.col("__tw_at"))).alias("__tw_first"))
    following = F.lead("__tw_first").over(Window.partitionBy(*keys).orderBy("__tw_chunk"))
    following = starts.withColumn("__tw_following", following).where(F.col("__tw_following").isNotNull()).drop("__tw_first")
    return kept.join(following, [*keys, "__tw_chunk"], "left").withColumn("__tw_end", F.coalesce("__tw_end", "__tw_following"))
