"""Record numbers inside a shard, without putting a shard into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from changefeed.functions.sequence import norm_seq
from changefeed.schema import SHARD_KEY
from changefeed.storage import materialise

# monotonically_increasing_id() keeps the partition above this bit and the row below it.
_ROW_BITS = 33


def with_shard_ordinal(
    rows: DataFrame, into: str = "ordinal", tie_break: tuple[str, ...] = ()
) -> DataFrame:
    """Number the records of each shard from 1 in sequence order.

    A window per shard would sort a whole shard in one task. Here the rows are
    range-partitioned on shard and sequence, so a hot shard spans many sorted
    partitions; the numbers come from a row id written with the sorted rows plus
    the count of the shard's rows in earlier partitions. That second table has
    one row per shard and partition it touches, however many records there are.
    """
    placed = materialise(
        rows.withColumn("_seq", norm_seq("sequenceNumber"))
        .repartitionByRange(*SHARD_KEY, "_seq", *tie_break)
        .sortWithinPartitions(*SHARD_KEY, "_seq", *tie_break)
        .drop("_seq")
        .withColumn("_id", F.monotonically_increasing_id()),
        "placed",
    ).withColumn("_piece", F.shiftright("_id", _ROW_BITS))
    pieces = placed.groupBy(*SHARD_KEY, "_piece").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = (
        Window.partitionBy(*SHARD_KEY)
        .orderBy("_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = materialise(
        pieces.select(
            *SHARD_KEY,
            "_piece",
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_shift"),
        ),
        "pieces",
    )
    return placed.join(pieces, [*SHARD_KEY, "_piece"]).select(
        *rows.columns, (F.col("_id") + F.col("_shift")).alias(into)
    )
