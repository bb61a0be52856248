"""Positions: where each shard is read from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.functions.sequence import norm_seq
from changefeed.schema import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    LATEST,
    SHARD_END,
    SHARD_KEY,
    TRIM_HORIZON,
)

# What a user may ask for, any case, blanks around it ignored.
STARTING_POSITIONS = {"latest": LATEST, "trim_horizon": TRIM_HORIZON}

# Blanks and control characters, as a character class.
_BLANKS = "^[\\x00-\\x20]+|[\\x00-\\x20]+$"


def parse_starting_position(text: Column) -> Column:
    """Starting position of a stream; absent means latest, anything unknown fails."""
    wanted = F.lower(F.regexp_replace(text, _BLANKS, ""))
    parsed = F.when(text.isNull(), F.lit(LATEST))
    for name, kind in STARTING_POSITIONS.items():
        parsed = parsed.when(wanted == name, F.lit(kind))
    message = F.concat(
        F.lit("startingPosition must be one of latest, trim_horizon; got: "), text
    )
    return parsed.otherwise(F.raise_error(message).cast("string"))


def checked_kind(kind: Column, position: Column) -> Column:
    """The kind of a position; one that is unknown, or cannot be read, fails."""
    sound = (
        kind.isin(TRIM_HORIZON, LATEST, SHARD_END)
        | ((kind == AT_TIMESTAMP) & position.try_cast("bigint").isNotNull())
        | (kind.isin(AFTER_SEQUENCE_NUMBER, AT_SEQUENCE_NUMBER) & position.isNotNull())
    )
    message = F.concat_ws(" ", F.lit("not a position that can be read:"), kind, position)
    return F.when(F.coalesce(sound, F.lit(False)), kind).otherwise(F.raise_error(message).cast("string"))


def reached(kind: Column, position: Column, seq: Column, arrival: Column) -> Column:
    """Is a record at or past a position?

    ``LATEST`` holds for nothing here: only records that arrive after planning
    count, see :func:`pin_latest`.
    """
    return (
        F.when(kind == TRIM_HORIZON, F.lit(True))
        .when(
            kind == AT_TIMESTAMP,
            arrival >= F.timestamp_millis(position.try_cast("bigint")),
        )
        .when(kind == AFTER_SEQUENCE_NUMBER, norm_seq(seq) > norm_seq(position))
        .when(kind == AT_SEQUENCE_NUMBER, norm_seq(seq) >= norm_seq(position))
        .otherwise(F.lit(False))
    )


def read_from(feed: DataFrame, kind: str, position: str = "") -> DataFrame:
    """Rows of a feed from one position on, as a plain filter that reaches the scan."""
    if kind == TRIM_HORIZON:
        return feed
    if kind in (LATEST, SHARD_END):
        return feed.filter(F.lit(False))
    if kind == AT_TIMESTAMP:
        start = F.timestamp_millis(F.lit(int(position)))
        return feed.filter(F.col("approximateArrivalTimestamp") >= start)
    # A stored feed keeps the padded number as a column, which the scan can use.
    seq = F.col("seqKey") if "seqKey" in feed.columns else norm_seq("sequenceNumber")
    bound = norm_seq(F.lit(position))
    if kind == AFTER_SEQUENCE_NUMBER:
        return feed.filter(seq > bound)
    if kind == AT_SEQUENCE_NUMBER:
        return feed.filter(seq >= bound)
    raise ValueError(f"unknown position: {kind}")


def live_positions(positions: DataFrame) -> DataFrame:
    """Positions of shards still to be read."""
    return positions.filter(checked_kind(F.col("iteratorType"), F.col("iteratorPosition")) != SHARD_END)


def pin_latest(positions: DataFrame, heads: DataFrame) -> DataFrame:
    """Turn ``LATEST`` into "after the head known at planning time".

    ``heads`` has one row per shard with column ``headSeq``. A listed shard that
    had no record yet is read from its beginning.
    """
    latest = F.col("iteratorType") == LATEST
    return positions.join(heads.select(*SHARD_KEY, "headSeq"), SHARD_KEY, "left").select(
        *SHARD_KEY,
        F.when(latest & F.col("headSeq").isNotNull(), F.lit(AFTER_SEQUENCE_NUMBER))
        .when(latest, F.lit(TRIM_HORIZON))
        .otherwise(F.col("iteratorType"))
        .alias("iteratorType"),
        F.when(latest, F.coalesce(F.col("headSeq"), F.lit("")))
        .otherwise(F.col("iteratorPosition"))
        .alias("iteratorPosition"),
    )


def apply_positions(feed: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows of each shard from that shard's own position on.

    Pass stored positions (a position log, or ``materialise``): their real size
    then decides between a broadcast and a shuffle join, whose hot shards the
    adaptive skew join splits. Shards that can give no row drop out before the
    join, and the feed keeps only its own columns. A position of an unknown kind,
    or one whose time or number cannot be read, fails.
    """
    live = positions.select(
        *SHARD_KEY,
        checked_kind(F.col("iteratorType"), F.col("iteratorPosition")).alias("_kind"),
        F.col("iteratorPosition").alias("_from"),
    ).filter(~F.col("_kind").isin(SHARD_END, LATEST))
    past = reached(
        F.col("_kind"),
        F.col("_from"),
        F.col("sequenceNumber"),
        F.col("approximateArrivalTimestamp"),
    )
    return feed.join(live, SHARD_KEY).filter(past).select(*feed.columns)
