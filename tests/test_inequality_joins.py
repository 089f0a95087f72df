"""Overlap, band, disjunctive and range semi joins against brute force and Spark's own join."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tableworks import band_join, conditional_join, disjunctive_join, join_data, overlap_join, range_join
from tableworks.operators import conditions
from tableworks.plans import workloads as w
from tests.conftest import SF_SMALL
from tests.plans import final_plan_text

HOWS = ["inner", "left", "left_semi", "left_anti"]
NAN, INF = float("nan"), float("inf")


def sorted_rows(df):
    return sorted((tuple(repr(v) for v in r) for r in df.collect()))


def same_as_spark(joined, left, right, condition, how):
    expected = left.alias("left_table").join(right.alias("right_table"), F.expr(condition), how)
    assert joined.columns == expected.columns
    assert sorted_rows(joined) == sorted_rows(expected)
    plan = final_plan_text(joined)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def ranges(rng, n, lengths, lo=0, hi=300, make=float, nulls=0.06):
    rows = []
    for i in range(n):
        s = rng.uniform(lo, hi)
        e = s + rng.choice(lengths)
        s, e = make(s), make(e)
        rows.append((i, None if rng.random() < nulls else s, None if rng.random() < nulls else e))
    return rows


def frames(spark, left, right, dtype):
    return (
        spark.createDataFrame(left, f"lid int, ls {dtype}, le {dtype}"),
        spark.createDataFrame(right, f"rid int, rs {dtype}, re {dtype}"),
    )


CLOSED = "left_table.ls <= right_table.re AND left_table.le >= right_table.rs"


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("max_bytes", [0, 10 << 20])
def test_overlap_of_mixed_lengths(spark, how, max_bytes):
    rng = random.Random(3)
    left = ranges(rng, 160, [0, 0, 0.5, 3, 40, 250, -5])  # points, inverted and long ranges
    right = ranges(rng, 90, [0, 1, 2, 7, 100, -30])
    left += left[:15]  # repeated rows
    ldf, rdf = frames(spark, left, right, "double")
    joined = overlap_join(ldf, rdf, "ls", "le", "rs", "re", how, max_broadcast_bytes=max_bytes)
    same_as_spark(joined, ldf, rdf, CLOSED, how)


@pytest.mark.parametrize("how", HOWS)
def test_overlap_of_odd_numbers(spark, how):
    """NaN sorts above everything, infinities reach everywhere, huge and tiny numbers keep their order."""
    odd = [NAN, INF, -INF, 0.0, -0.0, 1e300, -1e300, 5e-324, 1e15, 1e15 + 0.125, 2.0**62, 3.0, None]
    pairs = [(a, b) for a in odd for b in odd]
    left = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    right = [(i, b, a) for i, (a, b) in enumerate(pairs[::2])]
    ldf, rdf = frames(spark, left, right, "double")
    same_as_spark(overlap_join(ldf, rdf, "ls", "le", "rs", "re", how, max_broadcast_bytes=0), ldf, rdf, CLOSED, how)


@pytest.mark.parametrize("how", HOWS)
def test_overlap_with_open_ends(spark, how):
    rng = random.Random(5)
    left, right = ranges(rng, 120, [1, 5, 60], nulls=0.2), ranges(rng, 80, [2, 30], nulls=0.2)
    ldf, rdf = frames(spark, left, right, "double")
    condition = (
        "(left_table.ls <= right_table.re OR (right_table.re IS NULL AND left_table.ls IS NOT NULL)) AND "
        "(right_table.rs <= left_table.le OR (left_table.le IS NULL AND right_table.rs IS NOT NULL))"
    )
    same_as_spark(overlap_join(ldf, rdf, "ls", "le", "rs", "re", how, open_end=True, max_broadcast_bytes=0), ldf, rdf, condition, how)


@pytest.mark.parametrize("dtype, make", [
    ("int", int),
    ("decimal(38,0)", lambda x: Decimal(10**37) + int(x)),
    ("date", lambda x: dt.date(2024, 1, 1) + dt.timedelta(days=int(x))),
    ("timestamp_ntz", lambda x: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=x)),
    ("timestamp", lambda x: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=x)),
])
@pytest.mark.parametrize("touching", [True, False])
def test_overlap_of_every_type(spark, dtype, make, touching):
    rng = random.Random(9)
    ldf, rdf = frames(spark, ranges(rng, 90, [0, 2, 9, 70], make=make), ranges(rng, 60, [0, 1, 25], make=make), dtype)
    condition = CLOSED if touching else CLOSED.replace("<=", "<").replace(">=", ">")
    joined = overlap_join(ldf, rdf, "ls", "le", "rs", "re", touching=touching, max_broadcast_bytes=0)
    same_as_spark(joined, ldf, rdf, condition, "inner")


@pytest.mark.parametrize("how", HOWS)
def test_overlap_with_keys_and_no_rows(spark, how):
    rng = random.Random(11)
    left = [(i, s, e, rng.choice(["a", "b", None])) for i, s, e in ranges(rng, 100, [3, 50])]
    right = [(i, s, e, rng.choice(["a", "b", "c", None])) for i, s, e in ranges(rng, 70, [10])]
    ldf = spark.createDataFrame(left, "lid int, ls double, le double, k string")
    rdf = spark.createDataFrame(right, "rid int, rs double, re double, j string")
    joined = overlap_join(ldf, rdf, "ls", "le", "rs", "re", how, join_keys=[("k", "j")], max_broadcast_bytes=0)
    same_as_spark(joined, ldf, rdf, f"left_table.k = right_table.j AND {CLOSED}", how)
    for a, b in ((ldf.limit(0), rdf), (ldf, rdf.limit(0))) if how in ("left", "left_anti") else ():
        same_as_spark(overlap_join(a, b, "ls", "le", "rs", "re", how, max_broadcast_bytes=0), a, b, CLOSED, how)


def test_short_ranges_do_not_meet_in_wide_bins(spark):
    """One long range on each side must not make candidates of all short ones."""
    n = 2000
    short = spark.range(n).select(F.col("id").alias("lid"), (F.col("id") * 10.0).alias("ls"), (F.col("id") * 10.0 + 1).alias("le"))
    long_row = spark.createDataFrame([(-1, 0.0, 10.0 * n)], "lid long, ls double, le double")
    left = short.unionByName(long_row)
    right = left.select(F.col("lid").alias("rid"), F.col("ls").alias("rs"), F.col("le").alias("re"))
    joined = overlap_join(left, right, "ls", "le", "rs", "re", max_broadcast_bytes=0)
    assert joined.count() == n + 2 * n + 1
    with pytest.raises(ValueError, match="left side"):
        overlap_join(left, right, "ls", "le", "rs", "re", "full_outer")


@pytest.mark.parametrize("how, max_bytes, below, above", [
    ("inner", 0, 5.0, None), ("inner", 10 << 20, 0.0, 2.5), ("inner", 0, 0.1, 0.2), ("inner", 0, 0.0, 0.0), ("left", 0, 5.0, None),
    ("left", 0, 0.0, 2.5), ("left_semi", 10 << 20, 0.1, 0.2), ("left_anti", 0, 0.1, 0.2), ("left_anti", 0, 0.0, 0.0),
])
def test_band_of_doubles(spark, how, max_bytes, below, above):
    rng = random.Random(2)
    odd = [None, NAN, INF, -INF, 1e18, 1e18 + 256, 0.3, 0.1 + 0.2, 0.5, 0.30000000000000004]
    left = [(i, v) for i, v in enumerate([rng.choice([rng.uniform(-40, 40), float(rng.randint(-30, 30))]) for _ in range(150)] + odd)]
    right = [(i, v) for i, v in enumerate([float(rng.randint(-40, 40)) / rng.choice([1, 10]) for _ in range(90)] + odd)]
    ldf, rdf = spark.createDataFrame(left, "lid int, x double"), spark.createDataFrame(right, "rid int, y double")
    joined = band_join(ldf, rdf, "x", "y", below, above, how, max_broadcast_bytes=max_bytes)
    up = below if above is None else above
    same_as_spark(joined, ldf, rdf, f"left_table.x BETWEEN right_table.y - {below}D AND right_table.y + {up}D", how)


@pytest.mark.parametrize("dtype, values, distance, text", [
    ("int", lambda r: r.randint(-50, 50), 3, "3"),
    ("decimal(30,2)", lambda r: Decimal(10**20) + Decimal(r.randint(-3000, 3000)) / 100, Decimal("0.05"), "0.05"),
    ("date", lambda r: dt.date(2024, 1, 1) + dt.timedelta(days=r.randint(0, 90)), dt.timedelta(days=2), "INTERVAL 2 DAYS"),
    ("timestamp", lambda r: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=r.randint(0, 10**9)), dt.timedelta(seconds=7), "INTERVAL 7 SECONDS"),
    ("timestamp_ntz", lambda r: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=r.randint(0, 10**9)), dt.timedelta(seconds=7), "INTERVAL 7 SECONDS"),
])
def test_band_of_every_type(spark, dtype, values, distance, text):
    rng = random.Random(4)
    ldf = spark.createDataFrame([(i, values(rng)) for i in range(120)] + [(-1, None)], f"lid int, x {dtype}")
    rdf = spark.createDataFrame([(i, values(rng)) for i in range(80)] + [(-1, None)], f"rid int, y {dtype}")
    condition = f"left_table.x BETWEEN right_table.y - {text} AND right_table.y + {text}"
    same_as_spark(band_join(ldf, rdf, "x", "y", distance, max_broadcast_bytes=0), ldf, rdf, condition, "inner")


def test_band_rejects_bad_distances(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "v int, d date")
    for args in (("v", "v", -1), ("v", "v", dt.timedelta(days=1)), ("d", "d", 1), ("d", "d", dt.timedelta(hours=1)), ("v", "v", 1, dt.timedelta(1))):
        with pytest.raises((ValueError, TypeError)):
            band_join(df, df, *args)


@pytest.mark.parametrize("how, max_bytes", [("inner", 0), ("inner", 10 << 20), ("left", 0), ("left_semi", 0), ("left_anti", 10 << 20)])
def test_disjunction(spark, how, max_bytes):
    rng = random.Random(8)
    pick = lambda n: None if rng.random() < 0.15 else rng.randint(0, n)
    left = [(i, pick(9), pick(30), pick(4)) for i in range(120)]
    right = [(i, pick(14), pick(40), pick(6)) for i in range(80)]
    left += left[:9]
    ldf = spark.createDataFrame(left, "lid int, a int, b int, c int")
    rdf = spark.createDataFrame(right, "rid int, d int, b2 int, c2 int")
    condition = "left_table.a = right_table.d OR left_table.b = right_table.b2 AND left_table.c = right_table.c2 OR left_table.c = right_table.rid"
    ways = [[("a", "d")], [("b", "b2"), ("c", "c2")], [("c", "rid")]]
    assert conditions.disjunction(condition) == ways
    joined = disjunctive_join(ldf, rdf, ways, how, max_broadcast_bytes=max_bytes)
    same_as_spark(joined, ldf, rdf, condition, how)
    same_as_spark(conditional_join(ldf, rdf, condition, how=how, max_broadcast_bytes=max_bytes), ldf, rdf, condition, how)


OPS = [">=", "<=", ">", "<"]


@pytest.mark.parametrize("op", OPS)
@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
@pytest.mark.parametrize("keyed", [True, False])
def test_range_semi_anti_left(spark, op, how, keyed):
    rng = random.Random(6)
    value = lambda: rng.choice([None, NAN, INF, *[rng.randint(-9, 9) * 1.0 for _ in range(20)]])
    left = [(i, rng.choice([0, 0, 1, 2, None]), value()) for i in range(90)]
    right = [(i, rng.choice([0, 1, 3, None]), value()) for i in range(40)]
    for rows in (right, [r for r in right if r[2] is None]) if op == ">=" else (right,):
        ldf = spark.createDataFrame(left, "lid int, k int, x double")
        rdf = spark.createDataFrame(rows, "rid int, j int, y double")
        keys = [("k", "j")] if keyed else None
        joined = range_join(ldf, rdf, "x", "y", op, join_keys=keys, how=how, max_broadcast_bytes=0)
        condition = f"left_table.x {op} right_table.y" + (" AND left_table.k = right_table.j" if keyed else "")
        expected = ldf.alias("left_table").join(rdf.alias("right_table"), F.expr(condition), how)
        assert joined.columns == expected.columns and sorted_rows(joined) == sorted_rows(expected)


def test_range_semi_makes_no_pairs(spark):
    """A hot key with a third of both sides: one aggregated row per key meets the left rows."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    semi = range_join(rows, rows, "v", "v", ">", join_keys=["k"], how="left_semi", max_broadcast_bytes=0)
    assert semi.count() == 9_999
    plan = final_plan_text(semi)
    assert plan.count("HashAggregate") >= 2 and "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("condition", [
    "left_table.ls <= right_table.re AND left_table.le >= right_table.rs",
    "(right_table.re > left_table.ls) AND (right_table.rs < left_table.le) AND left_table.lid = right_table.rid",
    "left_table.ls BETWEEN right_table.rs - 2 AND right_table.rs + 0.5",
    "left_table.ls >= right_table.rs AND left_table.ls <= right_table.rs + 3",
    "right_table.rs BETWEEN left_table.ls - 1.5 AND left_table.ls + 2",
    "abs(right_table.rs - left_table.le) <= 1.25",
    "(left_table.lid = right_table.rid) OR (left_table.ls = right_table.rs)",
])
@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_condition_text_is_planned(spark, condition, how):
    rng = random.Random(13)
    half = lambda x: round(x * 2) / 2
    ldf, rdf = frames(spark, ranges(rng, 80, [0, 4], make=half, hi=60), ranges(rng, 50, [1, 9], make=half, hi=60), "double")
    same_as_spark(conditional_join(ldf, rdf, condition, how=how, max_broadcast_bytes=0), ldf, rdf, condition, how)


@pytest.mark.parametrize("condition", [
    "left_table.a <= right_table.b",
    "left_table.a <= right_table.b AND left_table.c > right_table.d",
    "left_table.a <= right_table.b AND left_table.c <= right_table.d",
    "left_table.a = right_table.b OR left_table.c < right_table.d",
    "NOT (left_table.a = right_table.b OR left_table.c = right_table.d)",
    "left_table.a BETWEEN right_table.b + 1 AND right_table.b + 3",
    "left_table.a BETWEEN right_table.b - 1 AND right_table.c + 3",
    "abs(left_table.a - left_table.b) <= 3",
    "left_table.a = right_table.b",
])
def test_other_text_stays_as_written(condition):
    assert conditions.overlap(condition) is None and conditions.band(condition) is None and conditions.disjunction(condition) is None


def test_dispatch(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.5, 3.0), (3, 9.0, 9.5)], "id int, s double, e double")
    advanced = lambda **kw: join_data(df, df, strategy="advanced", **kw)
    assert advanced(left_start="s", left_end="e", right_start="s", right_end="e").count() == 5
    assert advanced(left_key="s", right_key="s", below=0.5).count() == 5
    assert advanced(alternatives=[[("id", "id")], [("s", "e")]]).count() == 3
    assert advanced(left_key="s", right_key="s", range_condition=">", join_type="left_anti").count() == 1


def test_hot_band_and_hot_alternative_are_split(spark):
    from tests.test_skew import hot_left, skew_conf

    hot = hot_left(spark).select(F.col("k").cast("double").alias("x"), F.col("k"), "lv")
    other = spark.range(0, 30_000, 10).select(F.col("id").cast("double").alias("y"), F.col("id").alias("j"), (F.col("id") + 1).alias("j2"))
    want = 10_000 + sum(1 for i in range(30_000) if i % 3 and min(i % 10, 10 - i % 10) <= 2 and i - i % 10 + 10 * (i % 10 > 5) < 30_000)
    with skew_conf(spark):
        joined = band_join(hot, other, "x", "y", 2, max_broadcast_bytes=0)
        assert "skew=true" in final_plan_text(joined)
        assert joined.count() == want
        either = disjunctive_join(hot, other, [[("k", "j")], [("k", "j2")]], max_broadcast_bytes=0)
        assert "skew=true" in final_plan_text(either)
        assert either.count() == 10_000 + sum(1 for i in range(30_000) if i % 3 and i % 10 in (0, 1))


@pytest.mark.parametrize("name", ["join_overlap", "join_band", "join_disjunction", "join_range_semi", "join_range_anti"])
def test_queries_plan_no_pairs(spark, name):
    plan = final_plan_text(w.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("kind", ["string", "int", "double"])
def test_few_keys_keep_many_tasks_busy(spark, monkeypatch, kind):
    """The pairs of a hot key are dealt to cells, and each pair still comes exactly once."""
    import importlib

    monkeypatch.setattr(importlib.import_module("tableworks.operators.joins"), "PAIRS_PER_CELL", 500)
    rng = random.Random(8)
    make = {"string": str, "int": int, "double": lambda k: NAN if k == 2 else -0.0 if k == 1 else float(k)}[kind]

    def rows(n):
        keys = [None if rng.random() < 0.1 else make(rng.choice([0, 0, 0, 0, 1, 2])) for _ in range(n)]
        return [(i // 2, k, None if rng.random() < 0.1 else rng.choice([NAN, INF, rng.uniform(0, 50)])) for i, k in enumerate(keys)]

    ldf = spark.createDataFrame(rows(130), f"lid int, k {kind}, x double").coalesce(1)
    rdf = spark.createDataFrame(rows(90) + [(900, make(5), 1.0)], f"rid int, k {'long' if kind == 'int' else kind}, y double").coalesce(1)
    ldf = ldf.unionByName(ldf.limit(40)).coalesce(1)  # exact copies
    for op in (">=", "<"):
        joined = range_join(ldf, rdf, "x", "y", op, join_keys=["k"])
        same_as_spark(joined, ldf, rdf, f"left_table.k = right_table.k AND left_table.x {op} right_table.y", "inner")
        busy = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert busy > 8, busy
    mine = range_join(ldf, ldf, "x", "x", ">", ["left_table.lid", "right_table.lid AS other"], join_keys=["k"])
    assert mine.count() == ldf.alias("a").join(ldf.alias("b"), F.expr("a.k = b.k AND a.x > b.x")).count()
