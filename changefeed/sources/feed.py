"""The envelope and the shard catalogue as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.functions.sequence import norm_seq
from changefeed.functions.times import arrival_timestamp
from changefeed.schema import ENVELOPE, SHARD_KEY


def envelope(
    rows: DataFrame,
    *,
    data: Column,
    stream: Column | str,
    partition_key: Column,
    sequence_number: Column,
    arrival: Column | None = None,
    arrival_ms: Column | None = None,
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """Project records onto the five envelope columns.

    ``stream`` is the stream's name, or a column when many streams are read at
    once. ``keep`` adds columns after them, such as a shard id.
    """
    name = F.lit(stream) if isinstance(stream, str) else stream
    when = arrival if arrival is not None else arrival_timestamp(arrival_ms)
    values = [data, name, partition_key, sequence_number, when]
    return rows.select(
        *[v.cast(f.dataType).alias(f.name) for v, f in zip(values, ENVELOPE.fields)], *keep
    )


def shard_ranges(feed: DataFrame) -> DataFrame:
    """First and last sequence number and number of records of each shard."""
    seq = norm_seq("sequenceNumber")
    return feed.groupBy(*SHARD_KEY).agg(
        F.min_by("sequenceNumber", seq).alias("startSeq"),
        F.max_by("sequenceNumber", seq).alias("headSeq"),
        F.count(F.lit(1)).alias("records"),
    )


def shard_catalogue(ranges: DataFrame, lineage: DataFrame) -> DataFrame:
    """Shard listing: ranges joined with lineage.

    ``lineage`` has ``parentShardId``, ``adjacentParentShardId`` and ``closed``
    per shard; a shard that is not closed has no ``endSeq``.
    """
    return ranges.join(lineage, SHARD_KEY, "left").select(
        *SHARD_KEY,
        "parentShardId",
        "adjacentParentShardId",
        "startSeq",
        F.when(F.col("closed"), F.col("headSeq")).alias("endSeq"),
    )
