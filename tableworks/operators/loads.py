"""Table-loading strategies: delete+insert, merge/upsert, SCD type 2.

Each strategy is a pure function from the current table contents and a source
frame to the new table contents (lazy, no action), and ``load_data`` is the one
place that reads the target, calls the function and writes through
``replace_table``'s staged swap.  So a failure anywhere before the swap leaves
the table as it was.

Only two small actions run besides the write: the unique-key check of the
source (a map-side-combined ``groupBy`` whose result is cut to five rows), and,
for interval width choices elsewhere, single-row aggregates.  Nothing is
collected whole to the driver.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import logging
import operator
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException, UnsupportedOperationException

from tableworks.operators.key_filter import MAX_FILTER_BYTES, split_by_keys
from tableworks.operators.sizing import DEFAULT_BROADCAST_BYTES, fits_broadcast
from tableworks.sources.locks import DEFAULT_TTL, load_lock
from tableworks.sources.tables import (
    create_table,
    drop_partitions,
    overwrite_partitions,
    partition_columns,
    qualified_name,
    recover_interrupted_swap,
    replace_table,
    table_exists,
)

# The names and order of the history columns of an SCD type 2
# table, as the reference creates them.
EFFECTIVE_DATE = "effective_date"
IS_CURRENT = "is_current"
EXPIRY_DATE = "expiry_date"
SCD_COLUMNS = (EFFECTIVE_DATE, IS_CURRENT, EXPIRY_DATE)

# The loading strategy names callers pass, as in the reference.
LOAD_STRATEGIES = ("delete_insert", "merge_upsert", "scd_type2")


def _same_columns(target: DataFrame, source: DataFrame, what: str = "source") -> None:
    t, s = set(target.columns), set(source.columns)
    if t != s:
        raise ValueError(
            f"{what} columns differ from the target: missing {sorted(t - s)}, extra {sorted(s - t)}"
        )


def _as_condition(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def check_unique_keys(source: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise ``ValueError`` if a key is NULL or occurs twice in ``source``.

    One aggregate job: partial counts per key are combined map-side, so a key
    holding a third of all rows costs one row per task in the shuffle; at most
    five offending keys reach the driver.
    """
    keys = list(keys)
    any_null = reduce(operator.or_, [F.col(f"`{k}`").isNull() for k in keys])
    bad = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__tw_n"))
        .where((F.col("__tw_n") > 1) | any_null)
        .limit(5)
        .collect()
    )
    if bad:
        shown = [tuple(r[k] for k in keys) + (r["__tw_n"],) for r in bad]
        raise ValueError(f"{what} keys {keys} must be unique and not NULL; e.g. (key..., count): {shown}")


# ---------------------------------------------------------------------------
# delete + insert


def delete_insert(
    target: DataFrame, source: DataFrame, filter_condition: str | Column | None = None
) -> DataFrame:
    """New contents: target rows not matching ``filter_condition``, plus ``source``.

    Without a condition the source replaces everything.  A row whose condition
    is NULL is kept, as SQL ``DELETE ... WHERE`` would keep it.
    """
    _same_columns(target, source)
    if filter_condition is None:
        return source.select(*target.columns)
    kept = target.where(~F.coalesce(_as_condition(filter_condition), F.lit(False)))
    return kept.unionByName(source)


def _small_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """``df``, hinted for broadcast if it is measured at most ``max_bytes``."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


# ---------------------------------------------------------------------------
# merge / upsert


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    merge_keys: Sequence[str],
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """New contents: every source row, plus the target rows whose key is not in the source.

    Matched rows take all source columns (updated ∪ inserted = source), so one
    anti join does the work of match / no-match / keep.  Target rows with a
    NULL key never match and are kept.  A key repeated in the target is
    replaced as a whole by the one source row.

    Source keys measured at most ``max_broadcast_bytes`` are broadcast, so a
    small batch never shuffles the target.  With a larger source, a bitmap of its
    keys (at most ``max_filter_bytes``, broadcast) lets target rows that can't
    match pass by; only the others and the source's keys are shuffled, and AQE
    splits a hot key.
    """
    if not merge_keys:
        raise ValueError("merge_keys must be provided for merge/upsert")
    _same_columns(target, source)
    keys = list(merge_keys)
    source_keys = source.select(*keys)
    if fits_broadcast(source_keys, max_broadcast_bytes):
        kept = target.join(F.broadcast(source_keys), keys, "left_anti")
    else:
        near, apart = split_by_keys(target, source_keys, keys, max_filter_bytes)
        kept = near.join(source_keys, keys, "left_anti")
        kept = kept if apart is None else kept.unionByName(apart)
    return kept.select(*[F.col(f"`{c}`") for c in target.columns]).unionByName(source.select(*target.columns))


# ---------------------------------------------------------------------------
# SCD type 2


def _ts_literal(value: _dt.datetime | _dt.date | str | None, dtype: T.DataType) -> Column:
    """A pinned timestamp literal of ``dtype`` (one value for the whole load).

    A datetime with a zone, and the default (now), is an instant: a zoned column
    stores exactly that instant whatever the session's zone, and a column
    without zone stores its UTC wall clock.  A datetime without zone, a date or
    text is a wall clock, read in the session's zone by a zoned column.
    """
    if value is None:
        value = _dt.datetime.now(_dt.timezone.utc)
    if isinstance(value, _dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc)
        if isinstance(dtype, T.TimestampType):
            since = value - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
            return F.timestamp_micros(F.lit(since // _dt.timedelta(microseconds=1)))
        value = value.replace(tzinfo=None)
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.isoformat()
    else:
        text = str(value)
    return F.lit(text).cast(dtype)


def scd2_initial(
    source: DataFrame,
    effective_date: _dt.datetime | _dt.date | str | None = None,
    timestamp_type: T.DataType = T.TimestampNTZType(),
) -> DataFrame:
    """First load: every source row is the current version from ``effective_date``."""
    clash = [c for c in SCD_COLUMNS if c in source.columns]
    if clash:
        raise ValueError(f"source already has history columns {clash}")
    return source.select(
        *[F.col(f"`{c}`") for c in source.columns],
        _ts_literal(effective_date, timestamp_type).alias(EFFECTIVE_DATE),
        F.lit(True).alias(IS_CURRENT),
        F.lit(None).cast(timestamp_type).alias(EXPIRY_DATE),
    )


def scd2_apply(
    history: DataFrame,
    source: DataFrame,
    business_keys: Sequence[str],
    effective_date: _dt.datetime | _dt.date | str | None = None,
    validate: bool = True,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """New history after loading ``source`` at ``effective_date``.

    * key with a current version whose data columns differ (NULL-safe): that
      version is closed (``is_current`` false, ``expiry_date`` = the new
      ``effective_date``) and the source row is added as current;
    * key without a current version (new, or only expired versions): added;
    * unchanged keys and keys missing from the source: untouched.

    Plan: expired versions pass straight through (a filtered scan, no join).
    Current versions meet the source in one left join on the keys, and each
    joined row yields its old and, if it changed, its new version.  Source rows
    without a current version are found by an anti join against the keys that
    do match, which are never more than the source's.  A source measured at most
    ``max_broadcast_bytes`` is broadcast in both joins, so the history is not
    shuffled.  With a larger one, current versions that a bitmap of the source's
    keys (at most ``max_filter_bytes``, broadcast) proves to have no source row
    pass through like expired ones; AQE can split a hot key in all joins.
    A key with two current versions would insert its source row twice; with
    ``validate`` such a history is refused (only keys of the source are looked
    at).  A changed key whose current version is not older than
    ``effective_date`` fails the write itself (``raise_error``).
    """
    keys = list(business_keys)
    if not keys:
        raise ValueError("business_keys must be provided for SCD type 2")
    missing = [c for c in SCD_COLUMNS if c not in history.columns]
    if missing:
        raise ValueError(f"history lacks columns {missing}")
    data_cols = [c for c in history.columns if c not in SCD_COLUMNS]
    _same_columns(history.select(*data_cols), source)
    if validate:
        check_unique_keys(source, keys)

    ts_type = history.schema[EFFECTIVE_DATE].dataType
    eff = _ts_literal(effective_date, ts_type)
    hist_types = {f.name: f.dataType for f in history.schema.fields}

    is_cur = F.coalesce(F.col(IS_CURRENT), F.lit(False))
    # Current versions with a NULL key can never match a (validated, non-NULL)
    # source key; like expired versions they pass through without a shuffle,
    # so many of them cannot pile up in the one task the NULL key hashes to.
    all_keys = reduce(operator.and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    expired = history.where(~is_cur | ~all_keys)
    current = history.where(is_cur & all_keys)
    src = source.select(
        *[F.col(f"`{c}`").cast(hist_types[c]).alias(c) for c in data_cols],
        F.lit(True).alias("__tw_s"),
    )

    small = fits_broadcast(src, max_broadcast_bytes)
    src_keys = src.select(*keys)
    passing = [expired]
    if not small:
        current, apart = split_by_keys(current, src_keys, keys, max_filter_bytes)
        passing += [] if apart is None else [apart]
    hit = current.select(*keys).join(F.broadcast(src_keys) if small else src_keys, keys, "left_semi")
    if validate:
        check_unique_keys(hit, keys, "current versions of the history: ")
    t, s = current.alias("t"), (F.broadcast(src) if small else src).alias("s")
    on = reduce(operator.and_, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys])
    joined = t.join(s, on, "left")

    in_s = F.col("s.__tw_s").isNotNull()
    non_keys = [c for c in data_cols if c not in keys]
    differs = reduce(
        operator.or_,
        [~F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in non_keys],
        F.lit(False),
    )
    changed = in_s & differs
    too_old = changed & (F.col(f"t.{EFFECTIVE_DATE}") >= eff)
    too_old_error = F.raise_error(
        F.concat(
            F.lit("effective_date must be later than the current version's for key "),
            F.to_json(F.struct(*[F.col(f"t.`{k}`") for k in keys])),
        )
    )
    old_version = F.struct(
        *[F.col(f"t.`{c}`").alias(c) for c in data_cols],
        F.col(f"t.{EFFECTIVE_DATE}").alias(EFFECTIVE_DATE),
        F.when(too_old, too_old_error)
        .when(changed, F.lit(False))
        .otherwise(F.col(f"t.{IS_CURRENT}"))
        .alias(IS_CURRENT),
        F.when(changed, eff).otherwise(F.col(f"t.{EXPIRY_DATE}")).alias(EXPIRY_DATE),
    )

    def current_from(prefix: str) -> list[Column]:
        return [
            *[F.col(f"{prefix}`{c}`").alias(c) for c in data_cols],
            eff.alias(EFFECTIVE_DATE),
            F.lit(True).alias(IS_CURRENT),
            F.lit(None).cast(ts_type).alias(EXPIRY_DATE),
        ]

    new_version = F.when(changed, F.struct(*current_from("s.")))
    versions = (
        joined.select(F.explode(F.array(old_version, new_version)).alias("__tw_v"))
        .where(F.col("__tw_v").isNotNull())
        .select("__tw_v.*")
    )
    absent = src.join(hit.distinct(), keys, "left_anti").select(*current_from(""))
    parts = [*passing, versions, absent]
    return reduce(DataFrame.unionByName, [part.select(*history.columns) for part in parts])


def scd2_current(history: DataFrame) -> DataFrame:
    """Current versions only."""
    return history.where(F.col(IS_CURRENT))


def scd2_history(history: DataFrame, business_keys: Sequence[str]) -> DataFrame:
    """All versions ordered by key and ``effective_date``."""
    return history.orderBy(*business_keys, EFFECTIVE_DATE)


# ---------------------------------------------------------------------------
# partition-scoped loads: rewrite only the partitions a load touches

def _null_safe_on(pcols: Sequence[str], left: str, right: str) -> Column:
    return reduce(
        operator.and_, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in pcols]
    )


def source_partitions(target: DataFrame, source: DataFrame, pcols: Sequence[str]) -> DataFrame:
    """Distinct partition values of ``source``, typed as the target's partition columns."""
    types = {f.name: f.dataType for f in target.schema.fields}
    return source.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in pcols]).distinct()


def touched_partitions(target: DataFrame, source: DataFrame, pcols: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in the partitions ``source`` has rows for.

    The smallest and largest source value of each partition column become a
    filter on the file listing (static pruning, one literal pair per column
    however many partitions there are); a null-safe semi join with the distinct
    source partitions, broadcast when measured small, then selects exactly
    those, and prunes the rest at run time.
    """
    parts = source_partitions(target, source, pcols)
    bounds = parts.agg(
        *[f(F.col(f"`{c}`")).alias(f"{n}{i}") for i, c in enumerate(pcols) for n, f in (("lo", F.min), ("hi", F.max))],
        *[F.max(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, c in enumerate(pcols)],
    ).collect()[0]
    pred = F.lit(True)
    for i, c in enumerate(pcols):
        col, lo, hi, nulls = F.col(f"`{c}`"), bounds[f"lo{i}"], bounds[f"hi{i}"], bounds[f"null{i}"]
        if nulls is None:  # no source row at all
            return target.where(F.lit(False))
        inside = F.lit(False) if lo is None else col.between(F.lit(lo), F.lit(hi))
        pred = pred & (inside | col.isNull() if nulls else inside)
    listed = target.where(pred).alias("t")
    some = _small_broadcast(parts, DEFAULT_BROADCAST_BYTES).alias("p")
    return listed.join(some, _null_safe_on(pcols, "t", "p"), "left_semi")


def _only_over(columns: Sequence[str], target: DataFrame, condition: Column) -> bool:
    """Whether ``condition`` reads at least one of ``columns`` of ``target``, reads
    nothing else, and gives the same answer for a partition every time."""
    spark = target.sparkSession
    schema = T.StructType([target.schema[c] for c in columns])
    # PySpark logs every analysis error it raises; this one is an expected answer.
    quiet = logging.getLogger("SQLQueryContextLogger")
    was_disabled, quiet.disabled = quiet.disabled, True
    try:
        filtered = spark.createDataFrame([], schema).where(condition)
    except AnalysisException:  # unresolved column: the condition reads other columns
        return False
    finally:
        quiet.disabled = was_disabled
    analyzed = filtered._jdf.queryExecution().analyzed()
    if analyzed.nodeName() != "Filter":
        return False
    resolved = analyzed.condition()
    return bool(resolved.deterministic()) and resolved.references().size() > 0


@contextlib.contextmanager
def _evaluated_once(source: DataFrame, name: str) -> Iterator[DataFrame]:
    """``source`` written to a table next to ``name`` for the time of a load.

    A scoped load lists the source's partitions and then writes its rows; both
    have to see the same rows, also when the source is not deterministic or
    another job appends to what it reads.  The table lies in the shared
    warehouse, so a lost executor reads it again.
    """
    spark = source.sparkSession
    copy = f"{name}__src_{uuid.uuid4().hex[:8]}"
    create_table(source, copy)
    try:
        yield spark.table(copy)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {copy}")


def delete_insert_partitions(
    name: str, source: DataFrame, filter_condition: str | Column, pcols: Sequence[str]
) -> DataFrame:
    """``delete_insert`` for a condition over partition columns only.

    Such a condition deletes whole partitions.  The partitions the source has
    rows for are rewritten as (their rows not deleted) + (their source rows);
    partitions the condition deletes and the source does not refill are
    dropped from the catalog afterwards; all others are not touched.
    """
    spark = source.sparkSession
    target = spark.table(name)
    cond = _as_condition(filter_condition)
    _same_columns(target, source)
    with _evaluated_once(source, name) as rows:
        overwrite_partitions(delete_insert(touched_partitions(target, rows, pcols), rows, cond), name)
        # what the condition still finds besides the refilled partitions
        left_over = spark.table(name).where(F.coalesce(cond, F.lit(False))).select(*pcols).distinct()
        refilled = source_partitions(target, rows, pcols)
        emptied = left_over.alias("d").join(refilled.alias("s"), _null_safe_on(pcols, "d", "s"), "left_anti")
        specs: list[dict[str, object]] = []
        for r in emptied.toLocalIterator():
            specs.append({c: r[c] for c in pcols})
            if len(specs) == 500:
                drop_partitions(spark, name, specs)
                specs = []
        drop_partitions(spark, name, specs)
    return spark.table(name)


def merge_upsert_partitions(
    name: str, source: DataFrame, merge_keys: Sequence[str], pcols: Sequence[str]
) -> DataFrame:
    """``merge_upsert`` when the partition columns are among the merge keys.

    A key then fixes its partition, so only the partitions the source has
    rows for can change: they are rewritten as (their rows whose key is not in
    the source) + (their source rows), and no other partition is read or
    written.
    """
    target = source.sparkSession.table(name)
    with _evaluated_once(source, name) as rows:
        check_unique_keys(rows, merge_keys)  # on the rows that are written
        return overwrite_partitions(merge_upsert(touched_partitions(target, rows, pcols), rows, merge_keys), name)


def scd2_apply_partitions(
    name: str,
    source: DataFrame,
    business_keys: Sequence[str],
    effective_date: _dt.datetime | _dt.date | str,
    pcols: Sequence[str],
) -> DataFrame:
    """``scd2_apply`` when the partition columns are among the business keys.

    Keys absent from the source keep all their versions, and a key never
    leaves its partition, so only partitions the source has rows for change;
    each of them still has rows afterwards (the source row's version, new or
    unchanged), so overwriting exactly those partitions is the whole update.
    """
    history = source.sparkSession.table(name)
    with _evaluated_once(source, name) as rows:
        touched = touched_partitions(history, rows, pcols)
        return overwrite_partitions(scd2_apply(touched, rows, business_keys, effective_date), name)


# ---------------------------------------------------------------------------
# row-level writes on tables that support them (Iceberg, Delta, ...)

# Providers whose tables Spark writes as plain files: no row-level operations.
FILE_PROVIDERS = frozenset({"parquet", "orc", "csv", "json", "text", "avro", "hive"})


def table_provider(spark: SparkSession, name: str) -> str | None:
    """The table's provider (``parquet``, ``iceberg``, ...), from the catalog."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"].strip().lower() if rows else None


def _refused(exc: BaseException) -> bool:
    """Errors a table raises while the statement is analysed or planned: the
    table does not support the operation and nothing was written."""
    return isinstance(exc, (AnalysisException, UnsupportedOperationException))


def merge_upsert_row_level(source: DataFrame, name: str, merge_keys: Sequence[str]) -> None:
    """``MERGE INTO name`` from ``source``: matched rows take every source
    column, unmatched source rows are inserted (Spark's ``mergeInto``).  On
    tables with row-level support only the files holding matched keys are
    rewritten, in one atomic commit."""
    target = name.split(".")[-1].strip("`")
    on = reduce(
        operator.and_, [F.col(f"`{target}`.`{k}`") == F.col(f"`__tw_src`.`{k}`") for k in merge_keys]
    )
    (
        source.alias("__tw_src")
        .mergeInto(name, on)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def delete_insert_row_level(source: DataFrame, name: str, filter_condition: str | Column | None) -> None:
    """Delete the rows matching ``filter_condition`` and append ``source``.

    Without a condition both are one atomic overwrite of the whole table.  With
    one, ``DELETE FROM`` takes any condition on a row-level table (an
    overwrite-by-filter only takes those that fall on whole files); the append
    is a second commit, and running the load again after a failure in between
    gives the same rows.  A condition given as a ``Column`` has no SQL text and
    goes through the overwrite-by-filter.
    """
    target_columns = source.sparkSession.table(name).columns
    rows = source.select(*target_columns)
    if isinstance(filter_condition, str):
        source.sparkSession.sql(f"DELETE FROM {name} WHERE {filter_condition}")
        rows.writeTo(name).append()
        return
    rows.writeTo(name).overwrite(F.lit(True) if filter_condition is None else filter_condition)


def _try_row_level(spark: SparkSession, name: str, row_level: bool | None, write: Any) -> bool:
    """Run ``write`` natively when the table may support it; ``False`` if it refused."""
    if row_level is False:
        return False
    if row_level is None and (table_provider(spark, name) or "parquet") in FILE_PROVIDERS:
        return False
    try:
        write()
    except Exception as exc:  # noqa: BLE001 - only analysis-time refusals fall back
        if _refused(exc):
            return False
        raise
    return True


def materialize(source: DataFrame) -> DataFrame:
    """``source`` written once to the cluster's checkpoint folder and read back.

    A load reads its source several times (key check, partition list, the
    write).  An expensive or non-deterministic source is then computed once,
    and every pass sees the same rows; the lineage is cut, so a lost executor
    re-reads the checkpoint instead of recomputing upstream.  The folder is the
    session's ``spark.checkpoint.dir``, which must be shared storage; none is
    invented here.
    """
    spark = source.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("materialize_source needs spark.checkpoint.dir set to a folder the cluster shares")
        sc.setCheckpointDir(configured)
    return source.checkpoint(eager=True)


# ---------------------------------------------------------------------------
# dispatch: read -> pure transform -> staged write


def load_data(
    source: DataFrame,
    target_table: str,
    strategy: str = "delete_insert",
    target_catalog: str | None = None,
    **kwargs: Any,
) -> DataFrame:
    """Load ``source`` into ``target_catalog.target_table`` with ``strategy``.

    * ``delete_insert``: ``filter_condition`` (optional);
    * ``merge_upsert``: ``merge_keys`` (required);
    * ``scd_type2``: ``business_keys`` (required), ``effective_date``; with
      ``version_col``, the source is a change feed (see ``scd2_feed``) whose
      versions begin at that column's times.

    A missing table is created from the (prepared) source.  Other keyword
    arguments go to ``replace_table`` (``drop_stale``, ``bucket_by``,
    ``num_buckets``, ``partition_by``).  Returns a fresh scan of the table.

    Tables whose provider is not a plain file format (Iceberg, Delta, ...)
    are first loaded with row-level statements: ``MERGE INTO`` for upserts,
    an atomic overwrite-by-filter for delete+insert.  A table that refuses
    them while the statement is analysed falls back to the paths below;
    ``row_level=True`` forces the attempt, ``False`` skips it.

    ``materialize_source=True`` checkpoints the source first (see
    ``materialize``), for sources that are expensive or not deterministic.

    On a partitioned table these loads rewrite only the partitions they touch
    (``partition_scoped=False`` forces the whole-table swap): a delete+insert
    whose condition reads partition columns only, and a merge/upsert or SCD
    type 2 load whose keys include every partition column.  Everything else
    rewrites the whole table through the staged swap.

    A load holds the table's lock from before it looks at the table's state until
    its write is done (see ``load_lock``), so of two loaders the second is refused
    with ``TableLockedError``, or waits up to ``lock_wait`` seconds.  A lock older
    than ``lock_ttl`` seconds is taken over.  ``lock=False`` does without.
    """
    if strategy not in LOAD_STRATEGIES:
        raise ValueError(f"unknown loading strategy {strategy!r}; use one of {LOAD_STRATEGIES}")
    spark: SparkSession = source.sparkSession
    name = qualified_name(target_table, target_catalog)
    lock, ttl, wait = kwargs.pop("lock", True), kwargs.pop("lock_ttl", DEFAULT_TTL), kwargs.pop("lock_wait", 0.0)
    with load_lock(spark, name, ttl, wait) if lock else contextlib.nullcontext():
        return _load(spark, source, name, strategy, kwargs)


def _load(spark: SparkSession, source: DataFrame, name: str, strategy: str, kwargs: dict[str, Any]) -> DataFrame:
    write_opts = {k: kwargs.pop(k) for k in ("drop_stale", "bucket_by", "num_buckets", "partition_by") if k in kwargs}
    scoped = kwargs.pop("partition_scoped", True)
    row_level = kwargs.pop("row_level", None)
    if kwargs.pop("materialize_source", False):
        source = materialize(source)
    # Settle an interrupted swap before deciding whether the table exists.
    recover_interrupted_swap(spark, name, drop_stale=write_opts.get("drop_stale", False))
    exists = table_exists(spark, name)
    pcols = partition_columns(spark, name) if exists and scoped else []

    if strategy == "delete_insert":
        condition = kwargs.pop("filter_condition", None)
        _no_extra(kwargs)
        if not exists:
            return replace_table(source, name, **write_opts)
        target = spark.table(name)
        _same_columns(target, source)
        if _try_row_level(spark, name, row_level, lambda: delete_insert_row_level(source, name, condition)):
            return spark.table(name)
        if pcols and condition is not None and _only_over(pcols, target, _as_condition(condition)):
            return delete_insert_partitions(name, source, condition, pcols)
        return replace_table(delete_insert(target, source, condition), name, **write_opts)

    if strategy == "merge_upsert":
        keys = kwargs.pop("merge_keys", None)
        _no_extra(kwargs)
        if not keys:
            raise ValueError("merge_keys must be provided for merge/upsert")
        by_partition = exists and bool(pcols) and set(pcols) <= set(keys)
        if exists and by_partition and row_level is not True and (table_provider(spark, name) or "parquet") in FILE_PROVIDERS:
            _same_columns(spark.table(name), source)
            return merge_upsert_partitions(name, source, keys, pcols)
        check_unique_keys(source, keys)
        if not exists:
            return replace_table(source, name, **write_opts)
        _same_columns(spark.table(name), source)
        if _try_row_level(spark, name, row_level, lambda: merge_upsert_row_level(source, name, keys)):
            return spark.table(name)
        if by_partition:
            return merge_upsert_partitions(name, source, keys, pcols)
        return replace_table(merge_upsert(spark.table(name), source, keys), name, **write_opts)

    keys = kwargs.pop("business_keys", None)
    effective_date = kwargs.pop("effective_date", None)
    version_col = kwargs.pop("version_col", None)
    _no_extra(kwargs)
    if not keys:
        raise ValueError("business_keys must be provided for SCD type 2")
    if version_col is not None:
        if effective_date is not None:
            raise ValueError("a feed's versions begin at version_col; effective_date is for one batch")
        from tableworks.operators.change_feed import scd2_feed

        none_yet = scd2_initial(source.drop(version_col), "2000-01-01").limit(0)
        return replace_table(scd2_feed(spark.table(name) if exists else none_yet, source, keys, version_col), name, **write_opts)
    if effective_date is None:  # pin one instant for the whole load
        effective_date = _dt.datetime.now(_dt.timezone.utc)
    if not exists:
        check_unique_keys(source, keys)
        return replace_table(scd2_initial(source, effective_date), name, **write_opts)
    if pcols and set(pcols) <= set(keys):
        return scd2_apply_partitions(name, source, keys, effective_date, pcols)
    return replace_table(scd2_apply(spark.table(name), source, keys, effective_date), name, **write_opts)


def _no_extra(kwargs: dict[str, Any]) -> None:
    if kwargs:
        raise TypeError(f"unexpected arguments {sorted(kwargs)}")


def create_history_table(
    source: DataFrame,
    name: str,
    effective_date: _dt.datetime | _dt.date | str | None = None,
) -> DataFrame:
    """Create an SCD2 table from a first source (fails if ``name`` exists)."""
    return create_table(scd2_initial(source, effective_date), name)
