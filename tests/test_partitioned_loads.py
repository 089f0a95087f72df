"""Partition-scoped loads: same rows as the whole-table rewrite, fewer partitions touched."""

import random

import pytest
from pyspark.sql import functions as F

from tableworks import create_table, delete_insert, load_data, merge_upsert, partition_columns
from tableworks.operators.loads import touched_partitions
from tableworks.plans.inspect import plan_text

SCHEMA = "k long, v string, day string, region int"


def rows_of(frame):
    cols = sorted(frame.columns)
    return sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=str)


def files_of(spark, name, where):
    return set(spark.table(name).where(where).inputFiles())


def random_rows(rng, n, keys, days, with_null_day=True):
    pool = days + ([None] if with_null_day else [])
    return [(rng.choice(keys), f"v{rng.randrange(5)}", rng.choice(pool), rng.choice([1, 2])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scoped_merge_upsert_equals_whole_table_merge(spark, fresh, seed):
    rng = random.Random(seed)
    days = ["d1", "d2", "d3", "d4"]
    target = spark.createDataFrame(random_rows(rng, 60, range(20), days), SCHEMA)
    source_rows = {(k, d, r): v for k, v, d, r in random_rows(rng, 15, range(30), days[1:] + ["d9"], False)}
    source = spark.createDataFrame([(k, v, d, r) for (k, d, r), v in source_rows.items()], SCHEMA)
    expected = rows_of(merge_upsert(target, source, ["k", "day", "region"]))
    name = fresh("mu")
    create_table(target, name, partition_by=["day", "region"])
    out = load_data(source, name, "merge_upsert", merge_keys=["k", "day", "region"])
    assert rows_of(out) == expected


@pytest.mark.parametrize(
    "condition",
    ["day IN ('d1', 'd2')", "day = 'd3' AND region = 1", "day IS NULL", "day > 'd2'", "region = 2"],
)
def test_scoped_delete_insert_equals_whole_table_delete_insert(spark, fresh, condition):
    rng = random.Random(len(condition))
    days = ["d1", "d2", "d3", "d4"]
    target = spark.createDataFrame(random_rows(rng, 60, range(20), days), SCHEMA)
    source = spark.createDataFrame(random_rows(rng, 12, range(30), ["d2", "d4", "d9"], False), SCHEMA)
    expected = rows_of(delete_insert(target, source, condition))
    name = fresh("di")
    create_table(target, name, partition_by=["day", "region"])
    out = load_data(source, name, "delete_insert", filter_condition=condition)
    assert rows_of(out) == expected


def test_untouched_partitions_keep_their_files(spark, fresh):
    rows = [(i, "a", d, 1) for i, d in enumerate(["d1", "d2", "d3"] * 4)]
    name = fresh("keep")
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    before = files_of(spark, name, "day = 'd3'")
    src = spark.createDataFrame([(0, "new", "d1", 1), (99, "x", "d2", 1)], SCHEMA)
    load_data(src, name, "merge_upsert", merge_keys=["day", "k"])
    load_data(src, name, "delete_insert", filter_condition="day = 'd1'")
    assert files_of(spark, name, "day = 'd3'") == before
    assert files_of(spark, name, "day = 'd1'") != set()


def test_emptied_partition_is_dropped(spark, fresh):
    rows = [(1, "a", "d1", 1), (2, "b", "d2", 1)]
    name = fresh("drop")
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    src = spark.createDataFrame([(3, "c", "d3", 1)], SCHEMA)
    out = load_data(src, name, "delete_insert", filter_condition="day = 'd1'")
    assert rows_of(out) == rows_of(spark.createDataFrame([(2, "b", "d2", 1), (3, "c", "d3", 1)], SCHEMA))
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert sorted(parts) == ["day=d2", "day=d3"]


def test_keys_without_partition_column_rewrite_whole_table(spark, fresh):
    """A key that does not fix the partition can move a row between partitions."""
    rows = [(1, "a", "d1", 1), (2, "b", "d2", 1)]
    name = fresh("move")
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    src = spark.createDataFrame([(1, "a2", "d2", 1)], SCHEMA)
    out = load_data(src, name, "merge_upsert", merge_keys=["k"])
    assert rows_of(out) == rows_of(spark.createDataFrame([(1, "a2", "d2", 1), (2, "b", "d2", 1)], SCHEMA))


def test_created_partitioned_table_has_partition_columns(spark, fresh):
    name = fresh("pc")
    create_table(spark.createDataFrame([(1, "a", "d1", 1)], SCHEMA), name, partition_by=["day", "region"])
    assert partition_columns(spark, name) == ["day", "region"]


def test_touched_partitions_prune_and_select_exactly(spark, fresh):
    rows = [(i, "a", d, 1) for i, d in enumerate(["d1", "d2", "d3", "d4"] * 3)]
    name = fresh("prune")
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    src = spark.createDataFrame([(0, "x", "d1", 1), (1, "y", "d3", 1)], SCHEMA)
    touched = touched_partitions(spark.table(name), src, ["day"])
    assert sorted(r["day"] for r in touched.collect()) == ["d1"] * 3 + ["d3"] * 3
    text = plan_text(touched)
    filters = text.split("PartitionFilters")[1].split("]")[0]
    assert "day" in filters and "d1" in filters and "d3" in filters  # the listing stops at d3
    assert "LeftSemi" in text and "Exchange hashpartitioning(day" not in text.split("Scan parquet")[0]


def test_two_thousand_two_column_partitions(spark, fresh):
    name = fresh("many")
    wide = "id int, v string, a int, b int"
    create_table(spark.createDataFrame([(1, "old", 1, 1), (2, "old", 3000, 0)], wide), name, partition_by=["a", "b"])
    src = spark.range(2000).selectExpr("CAST(id AS int) AS id", "'new' AS v", "CAST(id AS int) AS a", "CAST(id % 7 AS int) AS b")
    touched = touched_partitions(spark.table(name), src, ["a", "b"])
    assert [tuple(r) for r in touched.collect()] == [(1, "old", 1, 1)]


def test_conditions_that_decide_no_partition_go_the_whole_way(spark, fresh):
    name = fresh("rand")
    rows = [(i, "a", f"d{i % 25}", 1) for i in range(1000)]
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    empty = spark.createDataFrame([], SCHEMA)
    left = load_data(empty, name, "delete_insert", filter_condition="rand(7) < 0.5").count()
    assert 380 < left < 620
    assert load_data(empty, name, "delete_insert", filter_condition="1 = 0").count() == left


def test_a_source_that_changes_between_reads_loses_no_partition(spark, fresh):
    name = fresh("unstable")
    rows = [(i, "a", f"d{i % 10}", 1) for i in range(1000)]
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    # lands in another partition each time it is evaluated
    src = spark.range(1).selectExpr("id + 5000 AS k", "'x' AS v", "concat('d', CAST(floor(rand() * 10) AS int)) AS day", "1 AS region")
    got = load_data(src, name, "merge_upsert", merge_keys=["day", "k"])
    assert got.count() == 1001


def test_scoped_merge_reads_only_touched_partitions(spark, fresh):
    rows = [(i, "a", d, 1) for i, d in enumerate(["d1", "d2", "d3"] * 3)]
    name = fresh("reads")
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    src = spark.createDataFrame([(0, "x", "d1", 1)], SCHEMA)
    content = merge_upsert(touched_partitions(spark.table(name), src, ["day"]), src, ["day", "k"])
    scans = [line for line in plan_text(content).splitlines() if "PartitionFilters" in line]
    assert scans and all("d1" in line for line in scans)


def test_whole_table_path_still_available(spark, fresh):
    rows = [(1, "a", "d1", 1), (2, "b", "d2", 1)]
    name = fresh("whole")
    create_table(spark.createDataFrame(rows, SCHEMA), name, partition_by=["day"])
    src = spark.createDataFrame([(3, "c", "d1", 1)], SCHEMA)
    out = load_data(src, name, "delete_insert", filter_condition="day = 'd1'", partition_scoped=False)
    assert rows_of(out) == rows_of(spark.createDataFrame([(2, "b", "d2", 1), (3, "c", "d1", 1)], SCHEMA))
    assert partition_columns(spark, name) == ["day"]
    assert out.where(F.col("day") == "d1").count() == 1


@pytest.mark.parametrize("seed", [4, 5])
def test_scoped_scd2_equals_whole_table_scd2(spark, fresh, seed):
    import datetime as dt

    from tableworks import scd2_apply, scd2_initial

    rng = random.Random(seed)
    days = ["d1", "d2", "d3"]

    def batch(n, keys):
        rows = {(k, d): (k, rng.choice(["a", "b", None]), d, rng.choice([1, 2])) for k, _, d, _ in
                random_rows(rng, n, keys, days, False)}
        return spark.createDataFrame(list(rows.values()), SCHEMA)

    first, second, third = batch(30, range(15)), batch(12, range(25)), batch(12, range(25))
    t1, t2, t3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    keys = ["day", "k"]
    expected = scd2_apply(scd2_apply(scd2_initial(first, t1), second, keys, t2), third, keys, t3)
    name = fresh("scd")
    load_data(first, name, "scd_type2", business_keys=keys, effective_date=t1, partition_by=["day"])
    untouched = files_of(spark, name, "day = 'd9'")
    load_data(second, name, "scd_type2", business_keys=keys, effective_date=t2)
    out = load_data(third, name, "scd_type2", business_keys=keys, effective_date=t3)
    assert partition_columns(spark, name) == ["day"]
    assert rows_of(out) == rows_of(expected)
    assert untouched == set()


def test_scoped_scd2_leaves_other_partitions_alone(spark, fresh):
    import datetime as dt

    rows = [(i, "a", d, 1) for i, d in enumerate(["d1", "d2", "d3"] * 3)]
    name = fresh("scd_keep")
    load_data(spark.createDataFrame(rows, SCHEMA), name, "scd_type2", business_keys=["day", "k"],
              effective_date=dt.datetime(2024, 1, 1), partition_by=["day"])
    before = files_of(spark, name, "day = 'd3'")
    src = spark.createDataFrame([(0, "changed", "d1", 1)], SCHEMA)
    out = load_data(src, name, "scd_type2", business_keys=["day", "k"], effective_date=dt.datetime(2024, 2, 1))
    assert files_of(spark, name, "day = 'd3'") == before
    assert out.count() == len(rows) + 1
    assert out.where("k = 0 AND is_current").first()["v"] == "changed"


@pytest.mark.parametrize("pcols", [["day"], ["day", "region"]])
def test_source_with_null_partition_values(spark, fresh, pcols):
    rng = random.Random(9)
    target = spark.createDataFrame(random_rows(rng, 40, range(20), ["d1", "d2"]), SCHEMA)
    source = spark.createDataFrame([(50, "n", None, 1), (51, "m", "d2", 2)], SCHEMA)
    for condition in ["day = 'd1'", "day IS NULL"]:
        expected = rows_of(delete_insert(target, source, condition))
        name = fresh("nullsrc")
        create_table(target, name, partition_by=pcols)
        assert rows_of(load_data(source, name, "delete_insert", filter_condition=condition)) == expected
