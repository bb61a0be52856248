"""Keyed and windowed state over a feed; the same functions on streams and on tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changefeed.functions.sequence import norm_seq
from changefeed.schema import SHARD_KEY

ARRIVAL = "approximateArrivalTimestamp"
# Fixed value: what a change that deletes its item is called.
REMOVE = "REMOVE"
SHUFFLE = "spark.sql.shuffle.partitions"
# Keys that a partition of state may hold.
_STATE_KEYS = 1_000_000


def partitions(spark: SparkSession, records: int) -> int:
    """How many partitions to start a stream with whose state has a row per key, of so many records.

    Each batch writes a file or two for each of them, however few of its keys are there,
    so a limited stream gets one per core, and more only if the keys of that many records
    could be over a million each; never more than shuffle partitions.
    """
    cores = spark.sparkContext.defaultParallelism
    return min(int(spark.conf.get(SHUFFLE)), max(cores, -(-records // _STATE_KEYS)))


def current_images(rows: DataFrame, keys: list[str], image: Column, kind: Column) -> DataFrame:
    """The newest image of each key: ``keys, sequenceNumber, image, removed``.

    The record of the highest sequence number wins, whatever order records come in,
    and of parts of one record the last one. The state of a stream is one row per key.
    A key whose newest record is a removal stays, marked ``removed`` and without an
    image, so that a sink can delete it and an older record that comes late does not
    bring it back. On a stream use update mode: a batch gives the keys it changed.
    """
    part = F.col("subSequence") if "subSequence" in rows.columns else F.lit(0)
    gone = F.coalesce(kind == REMOVE, F.lit(False))
    newest = F.max_by(
        F.struct("sequenceNumber", F.when(~gone, image).alias("image"), gone.alias("removed")),
        F.struct(norm_seq("sequenceNumber").alias("at"), part.alias("part")),
    )
    return rows.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*")


def window_counts(rows: DataFrame, width: str, lateness: str, slide: str | None = None) -> DataFrame:
    """Records per shard and window of arrival: shard key, ``start, end, records``.

    On a stream the state of a window is dropped once the newest arrival seen is
    ``lateness`` past its end; a record that comes for it after that is not counted.
    """
    window = F.window(ARRIVAL, width, slide or width)
    return (
        rows.withWatermark(ARRIVAL, lateness)
        .groupBy(*SHARD_KEY, window.alias("window"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select(*SHARD_KEY, "window.start", "window.end", "records")
    )


def sessions(rows: DataFrame, gap: str, lateness: str, keys: tuple[str, ...] = ("streamName", "partitionKey")) -> DataFrame:
    """Runs of records of a key with less than ``gap`` between them: ``keys, first, last, records``.

    Records that join two sessions merge them. On a stream use append mode: a session
    comes out once the newest arrival is ``lateness`` past its end.
    """
    return (
        rows.withWatermark(ARRIVAL, lateness)
        .groupBy(*keys, F.session_window(ARRIVAL, gap).alias("session"))
        .agg(F.min(ARRIVAL).alias("first"), F.max(ARRIVAL).alias("last"), F.count(F.lit(1)).alias("records"))
        .select(*keys, "first", "last", "records")
    )


def interval_join(left: DataFrame, right: DataFrame, key: str, upto: str, lateness: str) -> DataFrame:
    """Pairs of records of one key where the right one arrives up to ``upto`` after the left one.

    Columns of the right side have ``right_`` before their names. On streams both
    sides are kept as long as a partner can come: the left one for ``upto`` and
    ``lateness``, the right one for ``lateness``.
    """
    left, right = left.withWatermark(ARRIVAL, lateness), right.withWatermark(ARRIVAL, lateness)
    right = right.withColumnsRenamed({c: f"right_{c}" for c in right.columns})
    near = (
        (F.col(key) == F.col(f"right_{key}"))
        & (F.col(f"right_{ARRIVAL}") >= F.col(ARRIVAL))
        & (F.col(f"right_{ARRIVAL}") <= F.col(ARRIVAL) + F.expr(f"INTERVAL {upto}"))
    )
    return left.join(right, near)
