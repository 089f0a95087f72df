"""Catalog tables: names, reads, appends, bucketed writes and the staged replace.

Every write goes through the catalog the session already has (the session
catalog, or a V2 catalog named in the table name), so the data lands in the
warehouse the cluster shares.  Nothing here touches a machine-local folder.

Replacing a table that the new contents are computed from cannot be done in
place (Spark refuses to overwrite a table it is reading, and a V2 catalog
without staging drops it first).  ``replace_table`` therefore writes a stage
table ``<name>__stg`` first, and only after that write has committed drops the
old table and renames the stage.  A failed computation or write leaves the old
table untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_SUFFIX = "__stg"
COMPLETE_SUFFIX = "__new"  # a finished stage that is being copied over an external table


class TableStateError(RuntimeError):
    """The target and its stage table are in a state a load must not touch."""


def qualified_name(table: str, catalog: str | None = None) -> str:
    """``catalog.table``, or the bare name when no catalog is given."""
    return f"{catalog}.{table}" if catalog else table


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, table: str, catalog: str | None = None) -> DataFrame:
    """Lazy scan of a catalog table (pushdown and pruning reach the files)."""
    return spark.table(qualified_name(table, catalog))


def _check_columns(columns: list[str], target_columns: list[str], name: str) -> None:
    got, want = set(columns), set(target_columns)
    if got != want:
        missing = sorted(want - got)
        extra = sorted(got - want)
        raise ValueError(
            f"columns do not match table {name}: missing {missing}, extra {extra}"
        )


# Table option under which an overwrite of a partitioned file-source table
# replaces only the partitions the written rows fall into (Spark's data source
# option ``partitionOverwriteMode``; kept with the table, not the session).
DYNAMIC_OVERWRITE = ("partitionOverwriteMode", "dynamic")


def _laid_out(
    df: DataFrame, partition_by: list[str] | None = None, bucket_by: list[str] | None = None, num_buckets: int | None = None
) -> DataFrame:
    """``df`` arranged so that a partitioned or bucketed write makes few files.

    Partitions: a rebalance on their columns puts the rows of a partition into
    few tasks and splits one that holds very many (adaptive execution).
    Buckets: a hash on the bucket columns, so each task writes one bucket.
    """
    if bucket_by:
        shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        buckets = num_buckets or 10
        return df.repartition(buckets * max(shuffles // buckets, 1), *bucket_by)
    if partition_by:
        return df.hint("rebalance", *partition_by)
    return df


def _create(
    df: DataFrame,
    name: str,
    *,
    bucket_by: list[str] | None = None,
    num_buckets: int | None = None,
    partition_by: list[str] | None = None,
) -> None:
    writer = _laid_out(df, partition_by, bucket_by, num_buckets).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(*DYNAMIC_OVERWRITE)
    if bucket_by:
        writer = writer.bucketBy(num_buckets or 10, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def create_table(
    df: DataFrame,
    name: str,
    *,
    bucket_by: list[str] | None = None,
    num_buckets: int | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Create ``name`` from ``df``; fails if it already exists.

    A partitioned table is created with dynamic partition overwrite as its own
    option, so ``overwrite_partitions`` can later replace single partitions.
    """
    _create(df, name, bucket_by=bucket_by, num_buckets=num_buckets, partition_by=partition_by)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    """Append ``df`` to ``name`` by column name; create the table if missing.

    Columns are matched by name and must be the same set as the table's
    (a positional append can cross columns of equal type silently).
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        return create_table(df, name)
    target_columns = spark.table(name).columns
    _check_columns(df.columns, target_columns, name)
    rows = _laid_out(df.select(*target_columns), partition_columns(spark, name), *bucket_spec(spark, name))
    if _is_session_catalog(name):
        rows.write.insertInto(name)
    else:
        rows.writeTo(name).append()
    return spark.table(name)


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    """The catalog's description of a table: ``Type``, ``Location``, ``Comment``, ..."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    start = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed")), len(rows))
    return {r["col_name"].strip(): (r["data_type"] or "").strip() for r in rows[start + 1 :]}


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str] | None, int | None]:
    """Bucket columns and count of a catalog table; ``(None, None)`` without buckets."""
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isBucket]
    if not columns:
        return None, None
    return columns, int(_details(spark, name).get("Num Buckets", "10"))


def _is_external(spark: SparkSession, name: str) -> bool:
    return _details(spark, name).get("Type", "").upper() == "EXTERNAL"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Properties that a catalog keeps by itself.
_OWN_PROPERTIES = ("transient_lastDdlTime", "numFiles", "totalSize", "numRows", "rawDataSize", "numPartitions")


def _copy_metadata(spark: SparkSession, source: str, target: str) -> None:
    """Table properties and comment, which ``CREATE TABLE ... LIKE`` leaves behind."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {source}").collect()
    kept = [(r["key"], r["value"]) for r in rows if r["key"] not in _OWN_PROPERTIES and not r["key"].startswith("spark.sql.")]
    if kept:
        pairs = ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in kept)
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({pairs})")
    if comment := _details(spark, source).get("Comment"):
        spark.sql(f"COMMENT ON TABLE {target} IS {_sql_text(comment)}")


def _split(name: str) -> list[str]:
    return [p.strip("`") for p in name.split(".")]


def _rename_target(spark: SparkSession, new_name: str) -> str:
    """Name to put after ``RENAME TO``: V2 catalogs take it without the catalog."""
    parts = _split(new_name)
    if len(parts) >= 3 and parts[0] != "spark_catalog":
        return ".".join(parts[1:])
    return new_name


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {_rename_target(spark, new)}")


def recover_interrupted_swap(spark: SparkSession, name: str, *, drop_stale: bool = False) -> None:
    """Bring ``name`` and its stage table back to a state a load may start from.

    * target missing, stage present: an earlier swap wrote the stage, dropped the
      target and died before the rename; finish the rename.
    * both present: another loader is running, or one died before it dropped the
      target (the stage may be incomplete).  Refuse unless ``drop_stale``.
    """
    if table_exists(spark, name + COMPLETE_SUFFIX) and table_exists(spark, name):
        _copy_complete(spark, name)
    stage = name + STAGE_SUFFIX
    if not table_exists(spark, stage):
        return
    if not table_exists(spark, name):
        _rename(spark, stage, name)
        return
    if not drop_stale:
        raise TableStateError(
            f"stage table {stage} exists next to {name}: another load is running or one "
            "was interrupted before its swap; pass drop_stale=True to discard the stage"
        )
    spark.sql(f"DROP TABLE {stage}")


def _is_session_catalog(name: str) -> bool:
    parts = _split(name)
    return len(parts) <= 2 or parts[0] == "spark_catalog"


def replace_table(
    df: DataFrame,
    name: str,
    *,
    drop_stale: bool = False,
    bucket_by: list[str] | None = None,
    num_buckets: int | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Make ``df`` the whole contents of ``name`` (created if missing).

    ``df`` may read ``name`` itself.  A managed table of the session catalog:
    write the stage (the only job that runs ``df``), drop the old table, rename
    the stage.  Bucket and partition specs, properties and comment are kept.
    An EXTERNAL table keeps its location: the stage is written and marked
    complete by a rename, then copied over the table's files, then dropped; an
    interrupted copy is finished by the next load.  A table of a V2 catalog is
    overwritten in one commit of its own and never dropped.
    Returns a fresh lazy scan of the new table: a frame built on the old table
    cannot be run after the swap.
    """
    spark = df.sparkSession
    recover_interrupted_swap(spark, name, drop_stale=drop_stale)
    if not table_exists(spark, name):
        return create_table(
            df, name, bucket_by=bucket_by, num_buckets=num_buckets, partition_by=partition_by
        )
    target_columns = spark.table(name).columns
    _check_columns(df.columns, target_columns, name)
    ordered = _laid_out(df.select(*target_columns), partition_columns(spark, name), *bucket_spec(spark, name))
    if not _is_session_catalog(name):
        ordered.writeTo(name).overwrite(F.lit(True))
        return spark.table(name)
    stage = name + STAGE_SUFFIX
    external = _is_external(spark, name)
    try:
        spark.sql(f"CREATE TABLE {stage} LIKE {name}")
        if not external:
            _copy_metadata(spark, name, stage)
        ordered.write.insertInto(stage)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        raise
    if external:
        _rename(spark, stage, name + COMPLETE_SUFFIX)
        _copy_complete(spark, name)
    else:
        spark.sql(f"DROP TABLE {name}")
        _rename(spark, stage, name)
    return spark.table(name)


def _copy_complete(spark: SparkSession, name: str) -> None:
    """Overwrite an external table's files with its completed stage, then drop the stage."""
    complete = name + COMPLETE_SUFFIX
    if not partition_columns(spark, name):
        spark.table(complete).write.insertInto(name, overwrite=True)
    else:
        # every partition goes, also those without new rows
        key, value = DYNAMIC_OVERWRITE[0], "static"
        spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ('{key}' = '{value}')")
        spark.table(complete).write.insertInto(name, overwrite=True)
    spark.sql(f"DROP TABLE {complete}")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """Partition columns of a catalog table, in table order (empty if none)."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def overwrite_partitions(df: DataFrame, name: str) -> DataFrame:
    """Replace the partitions of ``name`` that ``df`` has rows for.

    Partitions without rows in ``df`` are neither read nor rewritten, so a
    load touching one day of a partitioned fact table costs that day, not the
    table.  ``df`` may read ``name`` itself: Spark writes the new partitions
    into a staging folder under the table and moves them in at job commit, so
    a lost executor only retries its tasks and a failed job leaves every
    partition as it was.  Session-catalog file tables get the dynamic-overwrite
    table option set (a metadata change, idempotent); V2 catalogs use
    ``overwritePartitions``.  Returns a fresh scan of the table.
    """
    spark = df.sparkSession
    if not partition_columns(spark, name):
        raise ValueError(f"table {name} is not partitioned")
    target_columns = spark.table(name).columns
    _check_columns(df.columns, target_columns, name)
    ordered = _laid_out(df.select(*target_columns), partition_columns(spark, name), *bucket_spec(spark, name))
    if _is_session_catalog(name):
        key, value = DYNAMIC_OVERWRITE
        spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ('{key}' = '{value}')")
        ordered.write.insertInto(name, overwrite=True)
    else:
        ordered.writeTo(name).overwritePartitions()
    return spark.table(name)


def _sql_literal(value: object) -> str:
    if value is None:  # the NULL partition (Hive's default partition)
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partitions(spark: SparkSession, name: str, specs: list[dict[str, object]]) -> None:
    """Drop the partitions given as ``{column: value}`` specs (missing ones are skipped)."""
    for start in range(0, len(specs), 500):
        parts = ", ".join(
            "PARTITION (" + ", ".join(f"`{c}` = {_sql_literal(v)}" for c, v in spec.items()) + ")"
            for spec in specs[start : start + 500]
        )
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def write_bucketed(
    df: DataFrame,
    name: str,
    bucket_columns: list[str],
    num_buckets: int = 10,
    *,
    sort: bool = True,
    files_per_bucket: int | None = None,
    catalog: str | None = None,
    spread_hot: bool = True,
) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) on ``bucket_columns``.

    The frame is hash-partitioned on the bucket columns into
    ``num_buckets * files_per_bucket`` partitions.  Spark's bucket id is the
    same Murmur3 hash modulo ``num_buckets``, so partition ``p`` holds rows of
    bucket ``p % num_buckets`` only: every task writes one sorted file of one
    bucket, and each bucket is written by ``files_per_bucket`` tasks in
    parallel instead of one.  The default takes the write parallelism from the
    session (``spark.sql.shuffle.partitions // num_buckets``, at least 1), so a
    cluster sized for its data does not funnel a 10-bucket table through 10
    tasks.  Joins on the bucket columns of two tables with the same bucket
    count skip the exchange whatever the number of files per bucket.

    A key that holds a large share of the rows (found by a sketch over the bucket
    columns, one job) would still be one task's: with ``spread_hot`` its rows are
    dealt to partitions of their own, all of the key's bucket, as many as make
    them as large as the others.

    In a V2 catalog (``catalog``, or one named in ``name``) the table is created
    with a bucket transform as its partitioning, which takes one column.
    """
    if not bucket_columns:
        raise ValueError("bucket_columns must not be empty")
    name = qualified_name(name, catalog)
    if not _is_session_catalog(name):
        if len(bucket_columns) != 1:
            raise ValueError("a V2 bucket transform takes one column")
        df.writeTo(name).partitionedBy(F.partitioning.bucket(num_buckets, bucket_columns[0])).create()
        return df.sparkSession.table(name)
    if files_per_bucket is None:
        shuffle_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        files_per_bucket = max(shuffle_partitions // num_buckets, 1)
    files_per_bucket = max(int(files_per_bucket), 1)
    if spread_hot:
        from tableworks.operators.hot_keys import dealt_to_buckets

        dealt = dealt_to_buckets(df, bucket_columns, num_buckets, files_per_bucket)
    else:
        dealt = df.repartition(num_buckets * files_per_bucket, *bucket_columns)
    writer = dealt.write.bucketBy(num_buckets, *bucket_columns)
    if sort:
        writer = writer.sortBy(*bucket_columns)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
