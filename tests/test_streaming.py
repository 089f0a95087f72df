"""Loading strategies driven by a file stream of the test tables."""

import os
import tempfile

from pyspark.sql import functions as F

from tableworks.plans import workloads as w
from tableworks.streaming import stream_load
from tests.conftest import SF_SMALL


def _customer_stream(spark):
    schema = w.table(spark, SF_SMALL, "customer").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "customer.parquet")
        .option("maxFilesPerTrigger", 1)
        .parquet(SF_SMALL)
    )


def test_stream_upsert_loads_every_row_once(spark, fresh):
    name = fresh("stream_upsert")
    ckpt = tempfile.mkdtemp(prefix="tw-stream-", dir="/tmp")
    q = stream_load(_customer_stream(spark), name, "merge_upsert", os.path.join(ckpt, "c"),
                    trigger={"availableNow": True}, merge_keys=["c_custkey"])
    q.awaitTermination(120)
    got = spark.table(name)
    customer = w.table(spark, SF_SMALL, "customer")
    assert got.count() == customer.count()
    assert got.exceptAll(customer).count() == 0

    # restarting from the same checkpoint replays nothing; reloading the same rows changes nothing
    q = stream_load(_customer_stream(spark), name, "merge_upsert", os.path.join(ckpt, "c"),
                    trigger={"availableNow": True}, merge_keys=["c_custkey"])
    q.awaitTermination(120)
    assert spark.table(name).count() == customer.count()


def test_stream_scd2_is_idempotent_per_batch(spark, fresh):
    name = fresh("stream_scd2")
    ckpt = tempfile.mkdtemp(prefix="tw-stream-", dir="/tmp")
    for sub in ("a", "b"):  # the same file through two checkpoints = one batch replayed
        q = stream_load(_customer_stream(spark), name, "scd_type2", os.path.join(ckpt, sub),
                        trigger={"availableNow": True}, business_keys=["c_custkey"])
        q.awaitTermination(120)
    hist = spark.table(name)
    assert hist.count() == w.table(spark, SF_SMALL, "customer").count()
    assert hist.where(~F.col("is_current")).count() == 0


def test_stream_upsert_into_partitioned_table(spark, fresh):
    """Each micro-batch rewrites only the partitions it touches; replays change nothing."""
    from tableworks import create_table

    customer = w.table(spark, SF_SMALL, "customer")
    name = fresh("stream_part")
    seed = customer.where(F.col("c_mktsegment") == "AUTOMOBILE")
    create_table(seed, name, partition_by=["c_mktsegment"])
    ckpt = tempfile.mkdtemp(prefix="tw-stream-", dir="/tmp")
    for sub in ("a", "b"):
        q = stream_load(_customer_stream(spark), name, "merge_upsert", os.path.join(ckpt, sub),
                        trigger={"availableNow": True}, merge_keys=["c_mktsegment", "c_custkey"])
        q.awaitTermination(120)
    got = spark.table(name)
    assert got.count() == customer.count()
    assert got.select(*customer.columns).exceptAll(customer).count() == 0


def test_latest_row_of_a_key_wins_within_a_batch(spark, fresh):
    name, folder = fresh("stream_latest"), tempfile.mkdtemp(prefix="tw-stream-", dir="/tmp")
    rows = [(1, "a", 1), (1, "c", 3), (1, "b", 2), (2, "x", 1)]
    spark.createDataFrame(rows, "k int, v string, at int").coalesce(1).write.parquet(os.path.join(folder, "in"))
    stream = spark.readStream.schema("k int, v string, at int").parquet(os.path.join(folder, "in"))
    q = stream_load(stream, name, "merge_upsert", os.path.join(folder, "c"), trigger={"availableNow": True},
                    merge_keys=["k"], latest_by="at")
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "c", 3), (2, "x", 1)]
