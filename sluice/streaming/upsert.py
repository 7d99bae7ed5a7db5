"""Observations as a stream: replays change nothing, corrections win however late, inserts can be deduplicated."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sluice.operators.dedup import keep_last
from sluice.plans.publish import Parts, Warehouse


def upsert_stream(stream: DataFrame, warehouse: Warehouse, dataset: str, table: str, keys: Sequence[str], checkpoint: str, order: str, *, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, parts: Parts = Parts(), **trigger) -> StreamingQuery:
    """Merges each micro-batch by key. No watermark: a correction must not be dropped for being late.

    A batch that runs again after a failure merges to the same table, and writes the ``parts`` that it touches.
    """

    def load(batch: DataFrame, _: int) -> None:
        batch = prepare(batch)
        if not batch.isEmpty():
            warehouse.upsert(dataset, {table: batch}, {table: keys}, order=order, parts={table: parts})

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def insert_only(stream: DataFrame, keys: Sequence[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """First arrivals of each key within the watermark; the state is bounded by it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, time: str, by: Sequence[str], width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Counts and sums of ``value`` in tumbling windows; each is final once its watermark has passed."""
    grouped = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *by)
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def replay(batches: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table that a stream of these batches ends in."""
    numbered = [b.withColumn("_batch", F.lit(i)) for i, b in enumerate(batches)]
    whole = numbered[0]
    for b in numbered[1:]:
        whole = whole.unionByName(b, allowMissingColumns=True)
    return keep_last(whole, keys, [F.col("_batch"), *map(F.col, order)], null_keys="group").drop("_batch")
