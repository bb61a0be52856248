"""Streaming queries that also keep the position log, and runs up to the head of a feed."""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from changefeed import storage
from changefeed.operators import position_log
from changefeed.operators.lineage import require_closed_parents
from changefeed.operators.progress import ITERATOR_POSITION, ITERATOR_TYPE, METADATA, previous_positions
from changefeed.schema import DEFAULT_CAP, POSITIONS, SHARD_END, SHARD_KEY, TRIM_HORIZON
from changefeed.sources import options as opts
from changefeed.sources.store import Heads, append_feed, measure, read_catalogue
from changefeed.sources.stream import FORMAT, register


def read_stream(spark: SparkSession, path: str, stream_name: str, **options: str) -> DataFrame:
    """A stored feed as a streaming DataFrame."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("streamName", stream_name)
    return reader.options(**options).load(storage.qualified(spark, path))


def read_table(spark: SparkSession, path: str, stream_name: str, **options: str) -> DataFrame:
    """A stored feed as a batch DataFrame; options choose the records, and with them the files to open."""
    register(spark)
    reader = spark.read.format(FORMAT).option("streamName", stream_name)
    return reader.options(**options).load(storage.qualified(spark, path))


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, name: str, page: int = DEFAULT_CAP, files: int | None = None
) -> DataStreamWriter:
    """A writer that appends a stream (envelope and ``shardId``) to a stored feed.

    Each batch is one append, laid out by shard and sequence number. The append is
    named after the writer and the batch id, and its page listing is its commit, so a
    batch that fails half way is not seen and one that is replayed counts once. Give
    writers to one feed names of their own. A batch without records appends nothing.
    Records are read from the source once and kept while their batch is written; if an
    executor is lost with them, they are read again.
    """

    heads, session = Heads(), stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            measured = measure(batch)
            if measured:
                append_feed(batch, path, page, files, f"{name}.{batch_id}", heads, measured, session)
        finally:
            batch.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)


def drain(writer: Callable[[], DataStreamWriter]) -> int:
    """Run a limited stream batch after batch until it stands at the head of its feed.

    With ``availableNow`` one run makes one batch, as the limit of a batch is the
    source's own. So that tells whether there is anything to read, and one query goes on
    from there, which starts once however many batches there are. ``writer`` gives the same
    query, with its checkpoint, each time. Returns the number of batches.
    """
    query = writer().trigger(availableNow=True).start()
    query.awaitTermination()
    first = query.recentProgress
    if not any(p["numInputRows"] for p in first):
        return 0
    query = writer().trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        more = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    # Batches are numbered one by one, and all but a run's last one have records.
    return 1 + (more[-1] - first[-1]["batchId"] if more else 0)


def write_with_log(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    feed_path: str,
    log_path: str | None,
    stream_name: str,
    checkpoint: str,
    min_batches_to_retain: int | None = None,
    options: dict[str, str] | None = None,
) -> DataStreamWriter:
    """A writer that gives each batch to ``sink``, then logs where each shard stands.

    What is logged is the end of the batch as the query's checkpoint has it, so a
    shard without records stands after the head it was pinned to; shards that are
    listed and have no record yet are read from their beginning. The log is
    written only after the sink succeeded; a replayed batch writes the same
    entries again. A batch whose predecessor the log has lost fails. Batches older
    than ``min_batches_to_retain`` (Spark's own setting by default) are purged.
    ``options``, those of the stream, name the log if ``log_path`` does not.
    """
    log_kind, named = opts.log_settings(options or {})
    log_path = log_path or named
    if not log_path:
        raise ValueError("no place for the position log was given")
    position_log.check_log_path(log_kind, log_path)
    spark = stream.sparkSession
    if min_batches_to_retain is None:
        min_batches_to_retain = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain", "100"))
    position_log.retention_threshold(0, min_batches_to_retain)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id:
            before = position_log.log_read(session, log_path)
            previous_positions(before, batch_id - 1).write.format("noop").mode("overwrite").save()
        sink(batch, batch_id)
        end = batch_end(session, checkpoint, batch_id, stream_name)
        catalogue = read_catalogue(session, feed_path)
        if catalogue is not None:
            listed = require_closed_parents(catalogue.filter(F.col("streamName") == stream_name))
            waiting = listed.select(*SHARD_KEY).join(end, SHARD_KEY, "left_anti")
            end = end.unionByName(
                waiting.select(
                    *SHARD_KEY,
                    F.lit(TRIM_HORIZON).alias("iteratorType"),
                    F.lit("").alias("iteratorPosition"),
                )
            )
        position_log.log_add(end, log_path, batch_id)
        position_log.log_retain(session, log_path, batch_id, min_batches_to_retain)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)


def batch_end(spark: SparkSession, checkpoint: str, batch_id: int, stream_name: str) -> DataFrame:
    """Where each shard stands at the end of a batch, from the query's offset log."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}").collect()
    offsets = [json.loads(r[0]) for r in lines if r[0].startswith("{")]
    mine = [o for o in offsets if o.get(METADATA, {}).get("streamName") == stream_name]
    if len(mine) != 1:
        raise ValueError(f"batch {batch_id} has no offset of stream {stream_name} under {checkpoint}")
    rows = [
        (stream_name, shard, at[ITERATOR_TYPE], "" if at[ITERATOR_TYPE] == SHARD_END else at[ITERATOR_POSITION])
        for shard, at in mine[0].items()
        if shard != METADATA
    ]
    return spark.createDataFrame(rows, POSITIONS)
