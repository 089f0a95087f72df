"""What a replaced table keeps, instants of history columns, write layout, plans of small batches."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableworks import create_table, load_data, merge_upsert, replace_table, scd2_apply, scd2_initial
from tableworks.operators.loads import _ts_literal
from tableworks.plans.inspect import plan_text


def describe(spark, name):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Type", "Location", "Comment", "Table Properties")}


def test_managed_table_keeps_properties_and_comment(spark, fresh):
    name = fresh("props")
    create_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('team' = 'it''s \"x\"', 'tier' = '1')".replace("''", "\\'"))
    spark.sql(f"COMMENT ON TABLE {name} IS 'what it holds'")
    before = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    load_data(spark.createDataFrame([(2, "b")], "k int, v string"), name, "merge_upsert", merge_keys=["k"])
    after = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert {r["key"]: r["value"] for r in before if r["key"] in ("team", "tier")}.items() <= after.items()
    assert describe(spark, name)["Comment"] == "what it holds"
    assert spark.table(name).count() == 2


def test_external_table_stays_where_it_is(spark, fresh):
    name, place = fresh("ext"), tempfile.mkdtemp(prefix="tw-ext-", dir="/tmp")
    spark.sql(f"CREATE TABLE {name} (k int, v string) USING parquet LOCATION '{place}' TBLPROPERTIES ('team' = 'x') COMMENT 'c'")
    before = describe(spark, name)
    load_data(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), name, "merge_upsert", merge_keys=["k"])
    out = load_data(spark.createDataFrame([(2, "c")], "k int, v string"), name, "merge_upsert", merge_keys=["k"])
    assert describe(spark, name) == before and before["Type"] == "EXTERNAL"
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "c")]
    assert any(f.endswith(".parquet") for f in os.listdir(place))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "__")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_effective_date_is_an_instant(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        aware = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=2)))
        ltz = spark.range(1).select(F.unix_micros(_ts_literal(aware, T.TimestampType())).alias("x")).first()["x"]
        assert ltz == int(aware.timestamp() * 1_000_000)
        ntz = spark.range(1).select(_ts_literal(aware, T.TimestampNTZType()).alias("x")).first()["x"]
        assert ntz == dt.datetime(2024, 5, 1, 10)
        now = spark.range(1).select(F.unix_micros(_ts_literal(None, T.TimestampType())).alias("x")).first()["x"]
        assert abs(now / 1e6 - dt.datetime.now(dt.timezone.utc).timestamp()) < 120
        wall = spark.range(1).select(_ts_literal(dt.datetime(2024, 5, 1, 12), T.TimestampType()).cast("string").alias("x")).first()["x"]
        assert wall == "2024-05-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_partitioned_write_makes_few_files(spark, fresh):
    name = fresh("files")
    many = spark.range(4000, numPartitions=40).selectExpr("id AS k", "id % 30 AS day")
    create_table(many, name, partition_by=["day"])
    assert len(spark.table(name).inputFiles()) <= 120


def test_small_batches_never_shuffle_the_target(spark):
    target = spark.range(20000).selectExpr("id AS k", "'a' AS v")
    batch = spark.createDataFrame([(5, "b")], "k long, v string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange hashpartitioning" not in plan_text(merge_upsert(target, batch, ["k"]))
        history = scd2_initial(target, dt.datetime(2024, 1, 1))
        out = scd2_apply(history, batch, ["k"], dt.datetime(2024, 2, 1))
        assert "FullOuter" not in plan_text(out) and "SortMergeJoin LeftOuter" not in plan_text(out)
        assert out.count() == 20001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_two_current_versions_of_a_key_are_refused(spark):
    row = spark.createDataFrame([(1, "a")], "k long, v string")
    history = scd2_initial(row, dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="current versions"):
        scd2_apply(history.union(history), row, ["k"], dt.datetime(2024, 2, 1))


def test_replacing_a_partitioned_external_table_drops_old_partitions(spark, fresh):
    name, place = fresh("extpart"), tempfile.mkdtemp(prefix="tw-ext-", dir="/tmp")
    spark.sql(f"CREATE TABLE {name} (k int, day string) USING parquet PARTITIONED BY (day) LOCATION '{place}'")
    spark.createDataFrame([(1, "d1"), (2, "d2")], "k int, day string").write.insertInto(name)
    replace_table(spark.createDataFrame([(3, "d2")], "k int, day string"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(3, "d2")]
