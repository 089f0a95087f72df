"""Loading strategies as a Structured Streaming sink.

``stream_load`` applies one of the loading strategies to every micro-batch
through ``foreachBatch``.  The three strategies are idempotent (running the
same batch twice gives the same table: upsert and delete+insert replace the
same rows, SCD type 2 sees no change the second time), so a micro-batch that
Spark replays after a failure does not duplicate or lose rows.  Progress is
recorded in the checkpoint folder, which must be on storage the cluster shares.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tableworks.operators.loads import LOAD_STRATEGIES, load_data


def stream_load(
    stream: DataFrame,
    target_table: str,
    strategy: str = "merge_upsert",
    checkpoint_location: str | None = None,
    target_catalog: str | None = None,
    trigger: dict[str, Any] | None = None,
    query_name: str | None = None,
    latest_by: str | None = None,
    **load_kwargs: Any,
) -> StreamingQuery:
    """Start a streaming query that loads each micro-batch into ``target_table``.

    ``checkpoint_location`` defaults to the session's
    ``spark.sql.streaming.checkpointLocation`` (Spark's own fallback).
    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "1 minute"}``).
    ``load_kwargs`` go to ``load_data`` (``merge_keys``, ``business_keys``,
    ``filter_condition``, ...).  An SCD type 2 stream without an explicit
    ``effective_date`` stamps each batch with the time it is loaded.

    An upsert or SCD type 2 load takes each key once per micro-batch.  With
    ``latest_by`` the row with the largest value of that column stands for its
    key (combined before the shuffle); without it a key that occurs twice in a
    micro-batch fails the load, which stops the query.  A delete+insert without
    a condition replaces the whole table with every micro-batch.
    """
    keys = list(load_kwargs.get("merge_keys") or load_kwargs.get("business_keys") or [])
    if latest_by is not None and not keys:
        raise ValueError("latest_by needs merge_keys or business_keys")
    if not stream.isStreaming:
        raise ValueError("stream_load needs a streaming DataFrame (spark.readStream...)")
    if strategy not in LOAD_STRATEGIES:
        raise ValueError(f"unknown loading strategy {strategy!r}; use one of {LOAD_STRATEGIES}")

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # The load reads the batch several times (key check, partitions, write):
        # keep it on the executors for that, instead of re-reading the source.
        if latest_by is not None:
            row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
            best = F.max_by(row, F.struct(F.col(f"`{latest_by}`"), F.xxhash64(*[F.col(f"`{c}`") for c in batch.columns])))
            batch = batch.groupBy(*keys).agg(best.alias("__tw_row")).select("__tw_row.*")
        batch.persist()
        try:
            load_data(batch, target_table, strategy, target_catalog, **load_kwargs)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(load_batch)
    if checkpoint_location:
        writer = writer.option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
