"""Interval and range joins: the rows of Spark's own join on every path and type."""

import decimal
import itertools

import pytest
from pyspark.sql import functions as F

from tableworks import conditional_join, interval_join, range_join
from tableworks.plans.inspect import plan_text

NAN, INF = float("nan"), float("inf")
BIG = 10**20
PATHS = [10 * 1024 * 1024, 0]


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def doubles(spark):
    values = [NAN, INF, -INF, 0.0, -0.0, 1.0, 1.5, 1e300, -3.25, None]
    points = spark.createDataFrame(list(enumerate(values)), "pid int, p double")
    pairs = [(s, e) for s, e in itertools.product(values, values)]
    ranges = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(pairs)], "rid int, s double, e double")
    return points, ranges


def decimals(spark):
    kind = "decimal(38,0)"
    points = spark.createDataFrame([(i, decimal.Decimal(BIG + i)) for i in range(6)] + [(9, None)], f"pid int, p {kind}")
    ranges = [(i, decimal.Decimal(BIG + i), decimal.Decimal(BIG + i + i % 3)) for i in range(6)]
    return points, spark.createDataFrame(ranges, f"rid int, s {kind}, e {kind}")


@pytest.mark.parametrize("make", [doubles, decimals])
@pytest.mark.parametrize("max_bytes", PATHS)
@pytest.mark.parametrize("ops", [(">=", "<="), (">=", "<"), (">", "<=")])
def test_inner_join_equals_sparks(spark, make, max_bytes, ops):
    points, ranges = make(spark)
    text = f"p {ops[0]} s AND p {ops[1]} e"
    got = interval_join(points, ranges, "p", "s", "e", start_op=ops[0], end_op=ops[1], max_broadcast_bytes=max_bytes)
    assert rows(got) == rows(points.join(ranges, F.expr(text)))


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_bytes", PATHS)
def test_preserving_joins_with_open_ends_and_keys(spark, how, max_bytes):
    points = spark.createDataFrame([(i, i % 3, float(i)) for i in range(30)] + [(90, None, 1.0), (91, 1, None)], "pid int, k int, p double")
    ranges = spark.createDataFrame([(i, i % 4, float(3 * i), None if i % 5 == 0 else 3.0 * i + 2.0 ** (i % 7)) for i in range(12)], "rid int, rk int, s double, e double")
    got = interval_join(points, ranges, "p", "s", "e", how, end_op="<", open_end=True, join_keys=[("k", "rk")], max_broadcast_bytes=max_bytes)
    want = points.join(ranges, F.expr("k = rk AND p >= s AND (e IS NULL OR p < e)"), how)
    assert rows(got) == rows(want)
    text = plan_text(got, "simple")
    assert text.split("Initial Plan")[0].count("Join") <= 6


CONDITIONS = [
    "left_table.p >= right_table.s AND left_table.p < right_table.e",
    "right_table.s < left_table.p AND right_table.e >= left_table.p",
    "left_table.p BETWEEN right_table.s AND right_table.e AND left_table.pid = right_table.rid",
    "left_table.p >= right_table.s AND (left_table.p < right_table.e OR right_table.e IS NULL)",
    "(left_table.p >= right_table.s AND left_table.p <= right_table.e)",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_conditions_become_binned_joins(spark, condition):
    points, ranges = doubles(spark)
    got = conditional_join(points, ranges, condition, max_broadcast_bytes=0)
    assert "__tw_pbin" in plan_text(got) and "Cartesian" not in plan_text(got)
    want = points.alias("left_table").join(ranges.alias("right_table"), F.expr(condition))
    assert rows(got) == rows(want)


def test_ranges_on_the_left(spark):
    points, ranges = doubles(spark)
    condition = "right_table.p >= left_table.s AND right_table.p < left_table.e"
    got = conditional_join(ranges, points, condition, max_broadcast_bytes=0)
    assert got.columns == [*ranges.columns, *points.columns] and "Cartesian" not in plan_text(got)
    assert rows(got) == rows(ranges.alias("left_table").join(points.alias("right_table"), F.expr(condition)))


def test_small_left_side_is_broadcast(spark):
    few = spark.createDataFrame([(1, 2)], "a int, b int")
    many = spark.range(5000).selectExpr("id AS c")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = conditional_join(few, many, "left_table.a + right_table.c < left_table.b + 3", max_broadcast_bytes=4096)
        assert "BroadcastNestedLoopJoin" in plan_text(got) and got.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("make", [doubles, decimals])
@pytest.mark.parametrize("op", [">=", "<=", ">", "<"])
def test_range_join_has_the_same_rows_on_every_path(spark, make, op):
    points, ranges = make(spark)
    want = rows(points.join(ranges, F.expr(f"p {op} s")).select("pid", "rid"))
    for extra in ({}, {"max_broadcast_bytes": 0}, {"max_broadcast_bytes": 0, "num_bins": 2}):
        assert rows(range_join(points, ranges, "p", "s", op, ["pid", "rid"], **extra)) == want


def test_range_join_with_keys_is_an_equi_join(spark):
    left = spark.createDataFrame([(i, i % 3, float(i)) for i in range(20)], "a int, k int, x double")
    right = left.toDF("b", "m", "y")
    got = range_join(left, right, "x", "y", ">", ["a", "b"], join_keys=[("k", "m")], max_broadcast_bytes=0)
    assert "NestedLoop" not in plan_text(got) and "Cartesian" not in plan_text(got)
    assert rows(got) == rows(left.join(right, F.expr("k = m AND x > y")).select("a", "b"))
