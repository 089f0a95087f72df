"""Loading rules at the edges: NULLs, duplicates, schemas, reloads, swap states."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tableworks import (
    STAGE_SUFFIX,
    TableStateError,
    append_table,
    delete_insert,
    load_data,
    merge_upsert,
    replace_table,
    scd2_apply,
    scd2_initial,
    table_exists,
)

SCHEMA = "id long, name string, amount double, day date"
T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_of(frame, *cols):
    cols = cols or frame.columns
    return sorted(tuple(r[c] for c in cols) for r in frame.collect())


# --- SCD type 2 ---------------------------------------------------------------


@pytest.mark.parametrize(
    "before,after",
    [
        (("a", None, None), ("a", 1.0, None)),  # NULL -> value
        (("a", 1.0, dt.date(2024, 1, 1)), ("a", None, dt.date(2024, 1, 1))),  # value -> NULL
        ((None, 1.0, None), ("", 1.0, None)),  # NULL -> ''
        (("a", 1.0, None), ("a", 1.0, dt.date(2024, 1, 2))),  # date NULL -> value
    ],
)
def test_scd2_detects_null_changes(spark, before, after):
    history = scd2_initial(df(spark, [(1, *before)]), T1)
    out = scd2_apply(history, df(spark, [(1, *after)]), ["id"], T2)
    assert out.count() == 2
    assert out.where("is_current").select("name", "amount", "day").first() == tuple(after)


def test_scd2_same_source_twice_is_idempotent(spark):
    src = df(spark, [(1, "a", 1.0, None), (2, None, None, None)])
    history = scd2_initial(src, T1)
    once = scd2_apply(history, src, ["id"], T2)
    assert rows_of(once) == rows_of(history)


def test_scd2_key_with_only_expired_versions_comes_back(spark):
    history = df(spark, [(1, "a", 1.0, None)]).select(
        "*", F.lit(T1).cast("timestamp_ntz").alias("effective_date"), F.lit(False).alias("is_current"),
        F.lit(T2).cast("timestamp_ntz").alias("expiry_date"),
    )
    out = scd2_apply(history, df(spark, [(1, "a", 1.0, None)]), ["id"], T3)
    assert out.count() == 2
    assert out.where("is_current").count() == 1


def test_scd2_keys_missing_from_source_are_untouched(spark):
    history = scd2_initial(df(spark, [(1, "a", 1.0, None), (2, "b", 2.0, None)]), T1)
    out = scd2_apply(history, df(spark, [(1, "z", 1.0, None)]), ["id"], T2)
    assert rows_of(out.where("id = 2")) == rows_of(history.where("id = 2"))


def test_scd2_effective_date_must_move_forward(spark, fresh):
    name = fresh("scd2_date")
    load_data(df(spark, [(1, "a", 1.0, None)]), name, "scd_type2", business_keys=["id"], effective_date=T2)
    with pytest.raises(Exception, match="effective_date must be later"):
        load_data(df(spark, [(1, "b", 1.0, None)]), name, "scd_type2", business_keys=["id"], effective_date=T1)
    # the failed load left the table as it was
    assert spark.table(name).count() == 1
    assert not table_exists(spark, name + STAGE_SUFFIX)


def test_scd2_source_columns_in_other_order(spark):
    history = scd2_initial(df(spark, [(1, "a", 1.0, None)]), T1)
    src = df(spark, [(1, "b", 1.0, None)]).select("day", "amount", "name", "id")
    out = scd2_apply(history, src, ["id"], T2)
    assert out.columns == history.columns
    assert out.where("is_current").first()["name"] == "b"


@pytest.mark.parametrize("rows", [[(1, "a", 1.0, None), (1, "b", 2.0, None)], [(None, "a", 1.0, None)]])
def test_scd2_rejects_duplicate_and_null_keys(spark, rows):
    history = scd2_initial(df(spark, [(1, "a", 1.0, None)]), T1)
    with pytest.raises(ValueError, match="unique and not NULL"):
        scd2_apply(history, df(spark, rows), ["id"], T2)


# --- merge / upsert -----------------------------------------------------------


def test_upsert_rejects_duplicate_source_keys(spark, fresh):
    name = fresh("up_dup")
    load_data(df(spark, [(1, "a", 1.0, None)]), name, "merge_upsert", merge_keys=["id"])
    with pytest.raises(ValueError, match="unique"):
        load_data(df(spark, [(2, "a", 1.0, None), (2, "b", 1.0, None)]), name, "merge_upsert", merge_keys=["id"])


def test_upsert_replaces_duplicate_target_keys_with_one_row(spark):
    target = df(spark, [(1, "a", 1.0, None), (1, "b", 2.0, None), (2, "c", 3.0, None)])
    out = merge_upsert(target, df(spark, [(1, "z", 9.0, None)]), ["id"])
    assert rows_of(out, "id", "name") == [(1, "z"), (2, "c")]


def test_upsert_keeps_null_key_target_rows(spark):
    target = df(spark, [(None, "a", 1.0, None), (1, "b", 2.0, None)])
    out = merge_upsert(target, df(spark, [(1, "z", 9.0, None)]), ["id"])
    assert rows_of(out, "name") == [("a",), ("z",)]


def test_upsert_by_name_not_position(spark):
    target = df(spark, [(1, "a", 1.0, None)], "id long, name string, other string, day date")
    src = df(spark, [(2, "x", "y", None)], "id long, other string, name string, day date")
    out = merge_upsert(target, src, ["id"])
    assert out.where("id = 2").first()["name"] == "y"


def test_missing_or_extra_column_is_refused(spark):
    target = df(spark, [(1, "a", 1.0, None)])
    with pytest.raises(ValueError, match="missing"):
        merge_upsert(target, target.drop("amount"), ["id"])
    with pytest.raises(ValueError, match="extra"):
        delete_insert(target, target.withColumn("x", F.lit(1)))


def test_upsert_requires_keys(spark):
    target = df(spark, [(1, "a", 1.0, None)])
    with pytest.raises(ValueError, match="merge_keys"):
        merge_upsert(target, target, [])


# --- delete + insert ---------------------------------------------------------


def test_delete_keeps_rows_whose_condition_is_null(spark):
    target = df(spark, [(1, "a", None, None), (2, "b", 5.0, None), (3, "c", 1.0, None)])
    out = delete_insert(target, df(spark, [(9, "n", 0.0, None)]), "amount > 2")
    assert rows_of(out, "id") == [(1,), (3,), (9,)]


# --- writer and swap ---------------------------------------------------------


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown loading strategy"):
        load_data(df(spark, [(1, "a", 1.0, None)]), "whatever", "truncate_all")


def test_replace_reads_itself(spark, fresh):
    name = fresh("self")
    replace_table(df(spark, [(1, "a", 1.0, None), (2, "b", 2.0, None)]), name)
    out = replace_table(spark.table(name).where("id = 2"), name)
    assert rows_of(out, "id") == [(2,)]
    assert not table_exists(spark, name + STAGE_SUFFIX)


def test_failed_write_leaves_target(spark, fresh):
    name = fresh("fail")
    replace_table(df(spark, [(1, "a", 1.0, None)]), name)
    boom = spark.table(name).withColumn("name", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        replace_table(boom, name)
    assert rows_of(spark.table(name), "id") == [(1,)]
    assert not table_exists(spark, name + STAGE_SUFFIX)


def test_interrupted_swap_is_finished(spark, fresh):
    name = fresh("swap")
    replace_table(df(spark, [(1, "a", 1.0, None)]), name)
    stage = name + STAGE_SUFFIX
    # a loader wrote the stage and dropped the target, then died before the rename
    spark.sql(f"CREATE TABLE {stage} LIKE {name}")
    df(spark, [(7, "s", 1.0, None)]).write.insertInto(stage)
    spark.sql(f"DROP TABLE {name}")
    out = load_data(df(spark, [(8, "n", 1.0, None)]), name, "merge_upsert", merge_keys=["id"])
    assert rows_of(out, "id") == [(7,), (8,)]


def test_stale_stage_is_refused_unless_dropped(spark, fresh):
    name = fresh("stale")
    replace_table(df(spark, [(1, "a", 1.0, None)]), name)
    spark.sql(f"CREATE TABLE {name + STAGE_SUFFIX} LIKE {name}")
    with pytest.raises(TableStateError):
        replace_table(df(spark, [(2, "b", 1.0, None)]), name)
    out = replace_table(df(spark, [(2, "b", 1.0, None)]), name, drop_stale=True)
    assert rows_of(out, "id") == [(2,)]


def test_replace_keeps_bucket_spec(spark, fresh):
    name = fresh("bkt")
    replace_table(df(spark, [(1, "a", 1.0, None)]), name, bucket_by=["id"], num_buckets=4)
    replace_table(spark.table(name).union(df(spark, [(2, "b", 1.0, None)])), name)
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert desc.get("Num Buckets") == "4"


def test_append_by_name(spark, fresh):
    name = fresh("app")
    append_table(df(spark, [(1, "a", 1.0, None)]), name)
    append_table(df(spark, [(2, "b", 2.0, None)]).select("day", "amount", "name", "id"), name)
    assert rows_of(spark.table(name), "id", "name") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        append_table(df(spark, [(3, "c", 1.0, None)]).drop("day"), name)


# --- row-level statements ------------------------------------------------------


def test_file_tables_are_not_row_level(spark, fresh):
    from tableworks.operators.loads import FILE_PROVIDERS, table_provider

    name = fresh("prov")
    df(spark, [(1, "a", 1.0, None)]).write.saveAsTable(name)
    assert table_provider(spark, name) in FILE_PROVIDERS


@pytest.mark.parametrize("strategy,kwargs", [
    ("merge_upsert", {"merge_keys": ["id"]}),
    ("delete_insert", {"filter_condition": "id = 1"}),
    ("delete_insert", {}),
])
def test_refused_row_level_falls_back_to_rewrite(spark, fresh, strategy, kwargs):
    """A Parquet table refuses MERGE / overwrite-by-filter at analysis; the
    load then takes the rewrite path and gives the same rows."""
    target = df(spark, [(1, "a", 1.0, None), (2, "b", 2.0, None)])
    source = df(spark, [(1, "A", 9.0, None), (3, "c", 3.0, None)])
    expected = {
        "merge_upsert": lambda: merge_upsert(target, source, ["id"]),
        "delete_insert": lambda: delete_insert(target, source, kwargs.get("filter_condition")),
    }[strategy]()
    name = fresh("rl")
    target.write.saveAsTable(name)
    out = load_data(source, name, strategy, row_level=True, **kwargs)
    assert rows_of(out) == rows_of(expected)


def test_scd2_null_key_history_rows_pass_through(spark):
    """Current versions with a NULL key (from older loads) stay as they are."""
    history = scd2_initial(df(spark, [(None, "x", 1.0, None), (None, "y", 2.0, None), (1, "a", 1.0, None)]), T1)
    out = scd2_apply(history, df(spark, [(1, "b", 1.0, None)]), ["id"], T2)
    assert out.count() == 4
    assert sorted(r.name for r in out.where("id IS NULL AND is_current").collect()) == ["x", "y"]
    assert out.where("id = 1 AND is_current").first()["name"] == "b"


def test_materialized_source_is_read_once(spark, fresh):
    """A non-deterministic source: the key check and the write see the same rows."""
    src = spark.range(50).select(
        F.col("id"), F.lit("n").alias("name"), F.rand(7).alias("amount"), F.lit(None).cast("date").alias("day")
    )
    name = fresh("mat")
    out = load_data(src, name, "merge_upsert", merge_keys=["id"], materialize_source=True)
    first = rows_of(out)
    assert len(first) == 50 and rows_of(spark.table(name)) == first


def test_materialize_needs_a_shared_checkpoint_folder(spark):
    from tableworks import materialize

    sc = spark.sparkContext
    assert sc.getCheckpointDir()  # the test session names one (conftest)
    assert materialize(spark.range(3)).count() == 3
