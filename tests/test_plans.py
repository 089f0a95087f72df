"""Physical plan shapes the design depends on."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tableworks import (
    broadcast_join,
    bucketed_join,
    conditional_join,
    interval_join,
    normalize_text,
    range_join,
    with_date_parts,
    write_bucketed,
)
from tableworks.plans import workloads as w
from tableworks.plans.inspect import plan_text
from tests.conftest import SF_SMALL


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


NO_AUTO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_broadcast_join_uses_broadcast_hash_join(spark):
    with conf(spark, **NO_AUTO_BROADCAST):
        orders, customer = w.table(spark, SF_SMALL, "orders"), w.table(spark, SF_SMALL, "customer")
        for how in ("inner", "left", "left_semi", "left_anti"):
            plan = plan_text(broadcast_join(orders, customer, [("o_custkey", "c_custkey")], how))
            assert "BroadcastHashJoin" in plan, how
        # a preserved right side cannot be the broadcast side: ordinary join
        plan = plan_text(broadcast_join(orders, customer, [("o_custkey", "c_custkey")], "right"))
        assert "BroadcastHashJoin" not in plan


def test_broadcast_join_skips_hint_above_bound(spark):
    with conf(spark, **NO_AUTO_BROADCAST):
        orders, customer = w.table(spark, SF_SMALL, "orders"), w.table(spark, SF_SMALL, "customer")
        plan = plan_text(broadcast_join(orders, customer, [("o_custkey", "c_custkey")], "inner", 0.001))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_bucketed_join_has_no_exchange(spark, fresh):
    customer, orders = w.table(spark, SF_SMALL, "customer"), w.table(spark, SF_SMALL, "orders")
    lt, rt = fresh("bc"), fresh("bo")
    write_bucketed(customer, lt, ["c_custkey"], 4)
    write_bucketed(orders, rt, ["o_custkey"], 4)
    with conf(spark, **NO_AUTO_BROADCAST):
        plan = plan_text(bucketed_join(spark, lt, rt, [("c_custkey", "o_custkey")]))
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan


@pytest.mark.parametrize("files_per_bucket", [1, 3])
def test_bucketed_write_one_bucket_per_file(spark, fresh, files_per_bucket):
    """Each written file holds one bucket; several files per bucket still join
    without an exchange, and the join result is unchanged."""
    import re

    customer, orders = w.table(spark, SF_SMALL, "customer"), w.table(spark, SF_SMALL, "orders")
    lt, rt = fresh("bc"), fresh("bo")
    left = write_bucketed(customer, lt, ["c_custkey"], 4, files_per_bucket=files_per_bucket)
    write_bucketed(orders, rt, ["o_custkey"], 4, files_per_bucket=files_per_bucket)
    # file name: part-<task>-<uuid>_<bucket>.c000...: one bucket per task
    names = [re.search(r"part-(\d{5})-.*_(\d{5})\.c\d+", f).groups() for f in left.inputFiles()]
    tasks = {}
    for task, bucket in names:
        tasks.setdefault(task, set()).add(bucket)
    assert all(len(b) == 1 for b in tasks.values())
    assert len({b for _, b in names}) == 4
    assert len(names) == 4 * files_per_bucket
    with conf(spark, **NO_AUTO_BROADCAST):
        joined = bucketed_join(spark, lt, rt, [("c_custkey", "o_custkey")])
        plan = plan_text(joined)
        assert "Exchange" not in plan
        expected = customer.join(orders, F.col("c_custkey") == F.col("o_custkey")).count()
        assert joined.count() == expected


def test_bucket_count_mismatch_needs_exchange(spark, fresh):
    customer, orders = w.table(spark, SF_SMALL, "customer"), w.table(spark, SF_SMALL, "orders")
    lt, rt = fresh("bc"), fresh("bo")
    write_bucketed(customer, lt, ["c_custkey"], 4)
    write_bucketed(orders, rt, ["o_custkey"], 3)
    with conf(spark, **NO_AUTO_BROADCAST):
        plan = plan_text(bucketed_join(spark, lt, rt, [("c_custkey", "o_custkey")]))
    assert "Exchange" in plan


@pytest.mark.parametrize("max_bytes", [0, 10 << 20])
def test_interval_join_is_an_equi_join(spark, max_bytes):
    with conf(spark, **NO_AUTO_BROADCAST):
        out = interval_join(w.table(spark, SF_SMALL, "orders"), w.period_frame(spark), "o_orderdate",
                            "start_date", "end_date", max_broadcast_bytes=max_bytes)
        plan = plan_text(out)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert ("BroadcastHashJoin" in plan) == (max_bytes > 0)


def test_conditional_join_broadcasts_small_side(spark):
    """An interval-shaped condition becomes a hash join on bins; any other
    inequality with a small side streams the big side against a broadcast."""
    orders, periods = w.table(spark, SF_SMALL, "orders"), w.period_frame(spark)
    with conf(spark, **NO_AUTO_BROADCAST):
        interval = plan_text(conditional_join(
            orders, periods, "left_table.o_orderdate BETWEEN right_table.start_date AND right_table.end_date"))
        other = plan_text(conditional_join(
            orders, periods, "left_table.o_totalprice > right_table.period_id * 20000"))
    assert "BroadcastHashJoin" in interval and "NestedLoopJoin" not in interval
    assert "BroadcastNestedLoopJoin" in other and "BuildRight" in other


def test_range_join_binned_has_no_cartesian(spark):
    with conf(spark, **NO_AUTO_BROADCAST):
        out = range_join(w.table(spark, SF_SMALL, "supplier"), w.table(spark, SF_SMALL, "customer"),
                         "s_acctbal", "c_acctbal", ">=", max_broadcast_bytes=0)
        plan = plan_text(out)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_column_functions_stay_in_the_jvm(spark):
    orders = w.table(spark, SF_SMALL, "orders")
    plan = plan_text(with_date_parts(normalize_text(orders, "o_orderpriority"), "o_orderdate"))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert node not in plan
    # the projection is compiled by whole-stage codegen ("*(n) Project")
    simple = plan_text(normalize_text(orders, "o_orderpriority"), "simple")
    assert "*(1) Project" in simple


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_text(w.q_join_left(spark, SF_SMALL))
    assert "GreaterThan(o_totalprice,300000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_order_amounts_aggregates_before_the_join(spark):
    with conf(spark, **NO_AUTO_BROADCAST):
        plan = plan_text(w.q_query_order_amounts(spark, SF_SMALL), "simple")
    # partial aggregate below the lineitem exchange (map-side combine)
    assert "partial_sum" in plan
    # the join reuses the aggregate's hash partitioning: 2 hash exchanges + 1 range (sort)
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange rangepartitioning") == 1


def _exchanges(final: str) -> int:
    return len([line for line in final.split("Initial Plan")[0].splitlines() if "Exchange" in line and "Reused" not in line])


def test_full_outer_shuffles_every_row_once(spark):
    from tableworks import equi_join
    from tests.plans import shuffled_rows

    customer = w.table(spark, SF_SMALL, "customer").where(F.col("c_mktsegment") == "BUILDING")
    orders = w.table(spark, SF_SMALL, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    with conf(spark, **NO_AUTO_BROADCAST):
        joined = equi_join(customer, orders, [("c_custkey", "o_custkey")], "full_outer")
        assert shuffled_rows(joined) <= customer.count() + orders.count()


def test_split_full_outer_reuses_side_exchanges(spark):
    """The inner part and each anti part read the same NULL-free side, so each
    side is shuffled once in full (reused) plus once as keys only."""
    from tableworks.operators.joins import full_outer_split
    from tests.plans import final_plan_text

    customer = w.table(spark, SF_SMALL, "customer").where(F.col("c_mktsegment") == "BUILDING")
    orders = w.table(spark, SF_SMALL, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    with conf(spark, **NO_AUTO_BROADCAST):
        on = F.col("left_table.c_custkey") == F.col("right_table.o_custkey")
        joined = full_outer_split(customer, orders, on, key_pairs=[("c_custkey", "o_custkey")])
        final = final_plan_text(joined).split("Initial Plan")[0]
    assert _exchanges(final) == 4
    assert final.count("ReusedExchange") == 2


def test_interval_join_broadcasts_few_points_against_many_ranges(spark):
    points = spark.createDataFrame([(1, 5.0), (2, 50.0)], "pid int, p double")
    ranges = spark.range(20000).select(
        F.col("id").alias("rid"), F.col("id").cast("double").alias("s"), (F.col("id") + 3).cast("double").alias("e")
    )
    with conf(spark, **NO_AUTO_BROADCAST):
        out = interval_join(points, ranges, "p", "s", "e", max_broadcast_bytes=64 * 1024)
        plan = plan_text(out)
        assert "BroadcastHashJoin" in plan and "BuildLeft" in plan
        assert sorted((r.pid, r.rid) for r in out.collect()) == sorted(
            [(1, j) for j in range(2, 6)] + [(2, j) for j in range(47, 51)]
        )
