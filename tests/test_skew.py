"""A key holding a third of all rows: the joins the library builds are split
by adaptive execution, and results stay whole and exact."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tableworks import check_unique_keys, equi_join, interval_join, merge_upsert
from tableworks.plans.inspect import plan_text
from tests.plans import final_plan_text

N = 30_000

# Thresholds scaled down to the test size: a partition counts as skewed when it
# is over 1 KB and twice the median (on a cluster: 256 MB and five times).
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_left(spark):
    """Key 0 holds every third row."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("lv")
    )


def right_side(spark, step=2):
    return spark.range(0, N, step).select(F.col("id").alias("k"), (F.col("id") * 2).alias("rv"))


def expected_counts(how):
    hot = len(range(0, N, 3))
    cold_keys = [i for i in range(N) if i % 3 != 0]
    matched_cold = sum(1 for i in cold_keys if i % 2 == 0)
    right_keys = set(range(0, N, 2))
    if how == "inner":
        return hot + matched_cold
    if how == "left_anti":
        return len(cold_keys) - matched_cold
    # full outer: matched + unmatched left + unmatched right
    left_keys = set(cold_keys) | {0}
    return hot + matched_cold + (len(cold_keys) - matched_cold) + len(right_keys - left_keys)


@pytest.mark.parametrize("how", ["inner", "left_anti", "full_outer"])
def test_hot_key_join_is_split_and_exact(spark, how):
    with skew_conf(spark):
        joined = equi_join(hot_left(spark), right_side(spark), ["k"], how)
        text = final_plan_text(joined)
        assert "skew=true" in text
        assert joined.count() == expected_counts(how)


def test_upsert_anti_join_splits_hot_target_key(spark):
    target = hot_left(spark).withColumnRenamed("lv", "v")
    source = right_side(spark, 5).withColumnRenamed("rv", "v")
    with skew_conf(spark):
        merged = merge_upsert(target, source, ["k"], max_broadcast_bytes=0)  # a small source would be broadcast
        assert "skew=true" in final_plan_text(merged)
        # target rows whose key is not in the source, plus every source row
        kept = sum(1 for i in range(N) if (0 if i % 3 == 0 else i) % 5 != 0)
        assert merged.count() == kept + len(range(0, N, 5))


def test_interval_join_hot_bin_is_split(spark):
    points = hot_left(spark).select(F.col("k").cast("double").alias("p"), "lv")
    ranges = spark.range(0, N, 10).select(
        F.col("id").alias("rid"), F.col("id").cast("double").alias("s"), (F.col("id") + 4).cast("double").alias("e")
    )
    with skew_conf(spark):
        joined = interval_join(points, ranges, "p", "s", "e", max_broadcast_bytes=0)
        assert "skew=true" in final_plan_text(joined)
        # p lies in [10j, 10j + 4] for exactly one j when p % 10 <= 4
        expected = sum(1 for i in range(N) if (0 if i % 3 == 0 else i) % 10 <= 4)
        assert joined.count() == expected


def test_unique_key_check_combines_map_side(spark):
    """The hot key reaches the shuffle as one partial count per task."""
    src = hot_left(spark)
    agg = src.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    tree = plan_text(agg).split("\n\n")[0]  # the operator tree, root first
    lines = tree.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    partial = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert len(partial) == 2 and partial[0] < exchange < partial[1]
    with pytest.raises(ValueError, match="unique"):
        check_unique_keys(src, ["k"])
