"""Keys with a third of all rows: found by the sketch, joined and written apart; merging many frames; load locks."""

import os
import random
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tableworks import TableLockedError, bucketed_join, coalesce_join, coalesce_many, equi_join, hot_keys, load_data, load_lock, write_bucketed
from tableworks.operators.hot_keys import dealt_to_buckets, full_outer_hot
from tableworks.sources.locks import lock_path
from tests.plans import final_plan_text, shuffled_rows
from tests.test_skew import N, expected_counts, hot_left, right_side, skew_conf


def rows(df):
    return sorted(tuple(map(repr, r)) for r in df.collect())


def test_sketch_finds_hot_keys_only(spark):
    found, n = hot_keys(hot_left(spark), ["k"])
    assert n == N and list(found.values()) == [N // 3]
    assert hot_keys(right_side(spark), ["k"])[0] == {}
    nulls = hot_left(spark).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    assert hot_keys(nulls, ["k"])[0] == {}  # a NULL key is no key
    assert hot_keys(hot_left(spark).limit(0), ["k"]) == ({}, 0)
    assert hot_keys(spark.range(5), ["id"])[0] == {} and len(hot_keys(spark.range(5), ["id"], least=0)[0]) == 5


def test_full_outer_moves_every_row_once(spark):
    left, right = hot_left(spark), right_side(spark)
    with skew_conf(spark):
        joined = equi_join(left, right, ["k"], "full_outer")
        assert "skew=true" in final_plan_text(joined)
        assert joined.count() == expected_counts("full_outer")
        # both sides once, and the distinct hot keys
        assert shuffled_rows(equi_join(left, right, ["k"], "full_outer")) <= N + N // 2 + 20
        assert rows(joined) == rows(equi_join(left, right, ["k"], "full_outer", split_full_outer=False))


@pytest.mark.parametrize("keys", [["k"], [("k", "j")], [("k", "j"), ("a", "b")]])
@pytest.mark.parametrize("share", [0.01, 0.2, 0.9])
def test_full_outer_with_hot_keys_on_both_sides(spark, keys, share):
    rng = random.Random(2)
    pick = lambda: rng.choice([0, 0, 0, 1, 2, 3, None, 7, 7])
    left = spark.createDataFrame([(pick(), rng.choice("xy"), f"l{i}") for i in range(60)], "k int, a string, lv string")
    right = spark.createDataFrame([(rng.choice([0, 7, 7, 9, None]), rng.choice("xyz"), f"r{i}") for i in range(40)], "k int, b string, rv string")
    if keys != ["k"]:
        right = right.withColumnRenamed("k", "j")
    got = full_outer_hot(left, right, keys, share=share, least=0)
    want = equi_join(left, right, keys, "full_outer", split_full_outer=False)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(equi_join(left, right, keys, "full_outer")) == rows(want)
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        assert rows(equi_join(a, b, keys, "full_outer")) == rows(equi_join(a, b, keys, "full_outer", split_full_outer=False))


def test_keys_that_hashes_cannot_tell(spark):
    left = spark.createDataFrame([(0.0, 1), (-0.0, 2), (1.0, 3)], "k double, l int")
    right = spark.createDataFrame([(-0.0, 4), (2.0, 5)], "k double, r int")
    assert full_outer_hot(left, right, ["k"]) is None
    assert equi_join(left, right, ["k"], "full_outer").count() == 4
    assert equi_join(left, right.withColumn("k", F.col("k").cast("int")), ["k"], "full_outer").count() == 4


def test_bucket_writes_spread_a_hot_key(spark, fresh):
    files = 8
    df = hot_left(spark).withColumn("note", F.concat(F.lit("n"), "lv"))
    sizes = [r["count"] for r in dealt_to_buckets(df, ["k"], 4, files).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == N and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    alone = [r["count"] for r in df.repartition(4 * files, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert max(alone) > 10 * sorted(alone)[len(alone) // 2]
    names = fresh("hot"), fresh("dim")
    write_bucketed(df, names[0], ["k"], 4, files_per_bucket=files)
    write_bucketed(right_side(spark), names[1], ["k"], 4)
    stored = spark.table(names[0])
    assert rows(stored) == rows(df)
    # the file's bucket id is that of its rows
    place = F.pmod(F.hash("k"), F.lit(4))
    wrong = stored.where(F.regexp_extract(F.input_file_name(), r"_(\d+)\.c\d+", 1).cast("int") != place)
    assert wrong.count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bucketed_join(spark, *names, ["k"])
        assert "Exchange" not in final_plan_text(joined)
        assert joined.count() == expected_counts("inner")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_coalesce_many(spark):
    rng = random.Random(7)
    frames, data = [], []
    for i, cols in enumerate((["a", "b"], ["b", "c"], ["a", "c", "d"])):
        some = [(k, *[rng.choice([None, f"{c}{i}{k}"]) for c in cols]) for k in rng.sample(range(30), 15)]
        some += [(None, *[f"null{i}"] * len(cols))]
        data.append([dict(zip(["k", *cols], r)) for r in some])
        frames.append(spark.createDataFrame(some, "k int, " + ", ".join(f"{c} string" for c in cols)))
    want = [tuple(r.get(c) for c in "kabcd") for d in data for r in d if r["k"] is None]
    for k in range(30):
        mine = [r for d in data for r in d if r["k"] == k]
        if mine:
            want.append((k, *[next((r[c] for r in mine if r.get(c) is not None), None) for c in "abcd"]))
    got = coalesce_many(frames, ["k"])
    assert got.columns == ["k", "a", "b", "c", "d"]
    assert rows(got) == sorted(tuple(map(repr, r)) for r in want)
    plan = final_plan_text(got)
    assert "Join" not in plan and plan.split("Initial Plan")[0].split("\n\n")[0].count(" Exchange") == 1
    # two frames are a coalescing join
    pair = coalesce_join(frames[0], frames[1], ["k"], {})
    assert rows(coalesce_many(frames[:2], ["k"])) == rows(pair.select("k", "a", "b", "c"))
    assert coalesce_many(frames, ["k"], ["d"]).columns == ["k", "d"]
    with pytest.raises(Exception, match="more than one row"):
        coalesce_many([frames[0], frames[1].unionByName(frames[1].where("k IS NOT NULL").limit(1))], ["k"]).collect()
    for bad in (([], ["k"]), (frames, []), (frames, ["k"], ["nope"])):
        with pytest.raises(ValueError):
            coalesce_many(*bad)


def test_second_loader_is_refused(spark):
    name = f"t_lock_{uuid.uuid4().hex[:8]}"
    df = spark.range(10).withColumn("v", F.lit(1))
    held, go, seen = threading.Event(), threading.Event(), []

    def first():
        with load_lock(spark, name):
            held.set()
            go.wait(30)

    t = threading.Thread(target=first)
    t.start()
    assert held.wait(30)
    with pytest.raises(TableLockedError, match="being loaded"):
        load_data(df, name)
    waiter = threading.Thread(target=lambda: seen.append(load_data(df, name, lock_wait=60.0).count()))
    waiter.start()
    time.sleep(0.5)
    assert not seen
    go.set()
    t.join(30)
    waiter.join(60)
    assert seen == [10]
    assert load_data(df, name).count() == 10  # the lock is free again
    assert load_data(df, name, "merge_upsert", merge_keys=["id"], lock=False).count() == 10


@pytest.mark.parametrize("stale", [True, False])
def test_lock_has_one_owner_at_a_time(spark, stale):
    """Many threads, a stale lock or none: each gets the lock in turn, never two at once."""
    name = f"t_turns_{uuid.uuid4().hex[:8]}"
    inside, most, turns, barrier = [], [], [], threading.Barrier(8)
    dead = load_lock(spark, name, ttl=0.05)
    if stale:
        dead.__enter__()
        time.sleep(0.2)

    def take():
        barrier.wait(60)
        for _ in range(5):
            with load_lock(spark, name, wait=120.0) as owner:
                inside.append(owner)
                most.append(len(inside))
                time.sleep(0.005)
                inside.remove(owner)
                turns.append(owner)

    threads = [threading.Thread(target=take) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(240)
    assert len(turns) == 40 and max(most) == 1
    if stale:
        dead.__exit__(None, None, None)  # its lock went to others long ago
    with load_lock(spark, name), pytest.raises(TableLockedError), load_lock(spark, name):
        pass
    assert lock_path(spark, f"spark_catalog.default.{name}") == lock_path(spark, name)


def test_half_written_and_left_files(spark):
    """An empty lock file blocks until it is old; a guard left behind is cleared when it is old."""
    name = f"t_left_{uuid.uuid4().hex[:8]}"
    path = lock_path(spark, name).removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    open(path, "w").close()
    with pytest.raises(TableLockedError), load_lock(spark, name):
        pass
    open(f"{path}.guard", "w").close()
    for f in (path, f"{path}.guard"):
        os.utime(f, (time.time() - 3600,) * 2)
    with load_lock(spark, name):
        assert os.path.exists(path)
    assert not os.path.exists(path) and not os.path.exists(f"{path}.guard")


def test_lock_is_released_after_a_failed_load(spark):
    name = f"t_fail_{uuid.uuid4().hex[:8]}"
    load_data(spark.range(2).withColumn("v", F.lit(0)), name)
    bad = spark.range(3).withColumn("v", F.when(F.col("id") >= 0, F.raise_error(F.lit("no value"))).cast("int"))
    with pytest.raises(Exception, match="no value"):
        load_data(bad, name)
    assert load_data(spark.range(3).withColumn("v", F.lit(1)), name).count() == 3
