"""Binned range and interval joins against a brute-force pair check."""

import datetime as dt
import random

import pytest

from tableworks import interval_join, range_join

OPS = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b}


def _values(rng, n, lo, hi, nulls=0.1):
    return [None if rng.random() < nulls else rng.randint(lo, hi) for _ in range(n)]


@pytest.mark.parametrize("op", sorted(OPS))
@pytest.mark.parametrize("bins,max_bytes", [(1, 0), (3, 0), (16, 0), (64, 10 << 20)])
def test_range_join_matches_brute_force(spark, op, bins, max_bytes):
    rng = random.Random(7 + bins)
    left = [(i, v) for i, v in enumerate(_values(rng, 120, -20, 20))]
    right = [(j, v) for j, v in enumerate(_values(rng, 80, -10, 30))]
    ldf = spark.createDataFrame(left, "lid int, lv int")
    rdf = spark.createDataFrame(right, "rid int, rv int")
    got = sorted(
        tuple(r) for r in range_join(ldf, rdf, "lv", "rv", op, ["lid", "rid"],
                                     max_broadcast_bytes=max_bytes, num_bins=bins).collect()
    )
    want = sorted(
        (i, j) for i, a in left for j, b in right if a is not None and b is not None and OPS[op](a, b)
    )
    assert got == want


def test_range_join_doubles_and_timestamps(spark):
    rng = random.Random(3)
    left = [(i, rng.uniform(-5, 5)) for i in range(60)] + [(60, 5.0), (61, -5.0)]
    right = [(j, rng.uniform(-5, 5)) for j in range(40)] + [(40, 5.0)]
    ldf = spark.createDataFrame(left, "lid int, lv double")
    rdf = spark.createDataFrame(right, "rid int, rv double")
    got = sorted(tuple(r) for r in range_join(ldf, rdf, "lv", "rv", ">", ["lid", "rid"], max_broadcast_bytes=0,
                                              num_bins=5).collect())
    assert got == sorted((i, j) for i, a in left for j, b in right if a > b)

    base = dt.datetime(2024, 1, 1)
    lt = [(i, base + dt.timedelta(hours=rng.randint(0, 500))) for i in range(50)]
    rt = [(j, base + dt.timedelta(hours=rng.randint(0, 500))) for j in range(30)]
    ldf = spark.createDataFrame(lt, "lid int, lv timestamp_ntz")
    rdf = spark.createDataFrame(rt, "rid int, rv timestamp_ntz")
    got = sorted(tuple(r) for r in range_join(ldf, rdf, "lv", "rv", "<=", ["lid", "rid"], max_broadcast_bytes=0,
                                              num_bins=7).collect())
    assert got == sorted((i, j) for i, a in lt for j, b in rt if a <= b)


def test_range_join_rejects_unknown_operator(spark):
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(ValueError, match="range_condition"):
        range_join(df, df, "v", "v", "= 1 OR 1")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("width", [None, 1.0, 4.0, 1000.0])
def test_interval_join_matches_brute_force(spark, how, width):
    rng = random.Random(11)
    points = [(i, None if rng.random() < 0.1 else rng.randint(0, 100)) for i in range(150)]
    ranges = []
    for j in range(40):
        s = rng.randint(-5, 100)
        e = s + rng.choice([0, 1, 3, 10, 40, -2])  # includes inverted ranges
        ranges.append((j, None if rng.random() < 0.05 else s, e))
    pdf = spark.createDataFrame(points, "pid int, p int")
    rdf = spark.createDataFrame(ranges, "rid int, s int, e int")
    out = interval_join(pdf, rdf, "p", "s", "e", how=how, bin_width=width)
    pairs = [(i, j) for i, p in points for j, s, e in ranges
             if p is not None and s is not None and e is not None and s <= p <= e]
    matched = {i for i, _ in pairs}
    if how == "inner":
        got = sorted((r.pid, r.rid) for r in out.collect())
        assert got == sorted(pairs)
    elif how == "left":
        got = sorted((r.pid, r.rid if r.rid is not None else -1) for r in out.collect())
        want = sorted(pairs + [(i, -1) for i, _ in points if i not in matched])
        assert got == want
    elif how == "left_semi":
        assert sorted(r.pid for r in out.collect()) == sorted(matched)
        assert out.columns == ["pid", "p"]
    else:
        assert sorted(r.pid for r in out.collect()) == sorted(i for i, _ in points if i not in matched)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_bytes", [0, 10 << 20])
def test_interval_join_mixed_lengths_matches_brute_force(spark, how, max_bytes):
    """A third of the ranges are very long: several bin levels, each match once."""
    rng = random.Random(21)
    points = [(i, None if rng.random() < 0.05 else rng.uniform(-50, 5000)) for i in range(300)]
    ranges = []
    for j in range(90):
        s = rng.uniform(0, 4000)
        length = rng.choice([0.0, 0.5, 2.0, 3.0]) if j % 3 else rng.choice([800.0, 2500.0, 4000.0])
        ranges.append((j, s, s + length))
    pdf = spark.createDataFrame(points, "pid int, p double")
    rdf = spark.createDataFrame(ranges, "rid int, s double, e double")
    out = interval_join(pdf, rdf, "p", "s", "e", how=how, max_broadcast_bytes=max_bytes)
    pairs = [(i, j) for i, p in points for j, s, e in ranges if p is not None and s <= p <= e]
    matched = {i for i, _ in pairs}
    if how == "inner":
        assert sorted((r.pid, r.rid) for r in out.collect()) == sorted(pairs)
    elif how == "left":
        got = sorted((r.pid, r.rid if r.rid is not None else -1) for r in out.collect())
        assert got == sorted(pairs + [(i, -1) for i, _ in points if i not in matched])
    elif how == "left_semi":
        assert sorted(r.pid for r in out.collect()) == sorted(matched)
        assert out.columns == ["pid", "p"]
    else:
        assert sorted(r.pid for r in out.collect()) == sorted(i for i, _ in points if i not in matched)


def test_interval_join_short_and_very_long_ranges(spark):
    """Ranges 1 and 100,000 long: each level finds its own matches once."""
    from tableworks.plans.inspect import plan_text

    short = [(j, float(j), float(j) + 1.0) for j in range(200)]
    long_ = [(1000 + j, float(j), float(j) + 100000.0) for j in range(100)]
    rdf = spark.createDataFrame(short + long_, "rid int, s double, e double")
    pdf = spark.createDataFrame([(0, 5.5), (1, 150000.0)], "pid int, p double")
    out = interval_join(pdf, rdf, "p", "s", "e", max_broadcast_bytes=0)
    assert sorted(r.rid for r in out.collect()) == [5] + [1000 + j for j in range(6)]
    assert "CartesianProduct" not in plan_text(out)
    anti = interval_join(pdf, rdf, "p", "s", "e", how="left_anti", max_broadcast_bytes=0)
    assert [r.pid for r in anti.collect()] == [1]


def test_interval_join_timestamp_points_in_date_ranges(spark):
    base = dt.datetime(2024, 1, 1)
    points = [(i, base + dt.timedelta(hours=7 * i)) for i in range(100)]
    ranges = [(j, (base + dt.timedelta(days=3 * j)).date(), (base + dt.timedelta(days=3 * j + 2)).date())
              for j in range(12)]
    pdf = spark.createDataFrame(points, "pid int, p timestamp_ntz")
    rdf = spark.createDataFrame(ranges, "rid int, s date, e date")
    got = sorted((r.pid, r.rid) for r in interval_join(pdf, rdf, "p", "s", "e").collect())
    want = sorted((i, j) for i, p in points for j, s, e in ranges
                  if dt.datetime.combine(s, dt.time()) <= p <= dt.datetime.combine(e, dt.time()))
    assert got == want


def test_interval_join_preserves_points_only(spark):
    df = spark.createDataFrame([(1, 1, 2)], "p int, s int, e int")
    with pytest.raises(ValueError, match="point side"):
        interval_join(df, df, "p", "s", "e", how="right")


@pytest.mark.parametrize("keys", [["k"], [("k", "k2")]])
def test_split_full_outer_equals_full_outer(spark, keys):
    from tableworks import coalesce_join, equi_join

    rng = random.Random(5)
    left = [(None if rng.random() < 0.1 else rng.choice([0, 0, 0, 1, 2, 3]), f"l{i}") for i in range(40)]
    right = [(None if rng.random() < 0.1 else rng.choice([0, 2, 4, 5]), f"r{i}") for i in range(30)]
    ldf = spark.createDataFrame(left, "k int, lv string")
    rdf = spark.createDataFrame(right, "k int, rv string")
    if keys != ["k"]:
        rdf = rdf.withColumnRenamed("k", "k2")
    split = equi_join(ldf, rdf, keys, "full_outer")
    single = equi_join(ldf, rdf, keys, "full_outer", split_full_outer=False)
    assert split.columns == single.columns
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, single.collect()), key=str)
    if keys == ["k"]:
        spec = {"v": ["lv", "rv"]}
        a = coalesce_join(ldf, rdf, ["k"], spec)
        b = coalesce_join(ldf, rdf, ["k"], spec, split_full_outer=False)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("form", ["ge_le", "between", "mirrored"])
def test_interval_shaped_condition_equals_spark_join(spark, how, form):
    """A point-in-interval condition is routed to the binned join with the same result."""
    from pyspark.sql import functions as F

    from tableworks import conditional_join
    from tableworks.plans.inspect import plan_text

    rng = random.Random(31)
    points = [(i, None if rng.random() < 0.1 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60)))
              for i in range(120)]
    ranges = []
    for j in range(25):
        s = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(-5, 60))
        ranges.append((j, s, s + dt.timedelta(days=rng.choice([0, 1, 5, 30, -3]))))
    pdf = spark.createDataFrame(points, "pid int, d date")
    rdf = spark.createDataFrame(ranges, "rid int, s timestamp_ntz, e timestamp_ntz")
    cond = {
        "ge_le": "left_table.d >= right_table.s AND left_table.d <= right_table.e",
        "between": "left_table.d BETWEEN right_table.s AND right_table.e",
        "mirrored": "right_table.e >= left_table.d AND right_table.s <= left_table.d",
    }[form]
    out = conditional_join(pdf, rdf, cond, how=how, max_broadcast_bytes=0)
    assert "NestedLoopJoin" not in plan_text(out) and "CartesianProduct" not in plan_text(out)
    expected = pdf.alias("left_table").join(rdf.alias("right_table"), F.expr(cond), how)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(out.collect(), key=key) == sorted(expected.collect(), key=key)
    assert out.columns == expected.columns
