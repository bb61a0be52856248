"""Batch limits: pages and the soft cap per shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changefeed.functions.sequence import norm_seq
from changefeed.operators.ordinal import with_shard_ordinal
from changefeed.operators.positions import apply_positions
from changefeed.schema import DEFAULT_CAP, DEFAULT_PAGE, SHARD_KEY
from changefeed.storage import materialise, materialise_counted

# Numbers the parts of an unpacked record, which share one sequence number.
SUB_SEQUENCE = "subSequence"


def batch_limit(page: int = DEFAULT_PAGE, cap: int = DEFAULT_CAP) -> int:
    """Most rows of a shard in one batch.

    The cap is soft: reading stops at the first page end past the cap.
    """
    if page < 1 or cap < 0:
        raise ValueError("page must be positive and cap must not be negative")
    return (cap // page + 1) * page


def page_of(ordinal: str, page: int) -> Column:
    """The page, from 0, of a record's number in its shard, from 1."""
    if page < 1:
        raise ValueError("page must be positive")
    return F.floor((F.col(ordinal) - 1) / page)


def page_numbers(rows: DataFrame, page: int = DEFAULT_PAGE) -> DataFrame:
    """Add ``pageNumber``: which read call, from 0, would have returned the row."""
    numbered = with_shard_ordinal(rows)
    return numbered.select(*rows.columns, page_of("ordinal", page).alias("pageNumber"))


def cap_per_shard(
    rows: DataFrame, page: int = DEFAULT_PAGE, cap: int = DEFAULT_CAP
) -> DataFrame:
    """The first rows of each shard, up to :func:`batch_limit`.

    ``(shard, sequenceNumber)``, with ``subSequence`` if there is one, tells rows
    apart. Only shards with more rows than the limit are cut: their keys are
    numbered, and full rows are filtered by that one bound per shard, so payloads
    are not shuffled. Keys are written once, to be counted and numbered from there.
    """
    limit = batch_limit(page, cap)
    keys = materialise(rows.select(*SHARD_KEY, "sequenceNumber", *_tie(rows)), "keys")
    large, shards = materialise_counted(
        keys.groupBy(*SHARD_KEY)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > limit)
        .select(*SHARD_KEY),
        "large",
    )
    return cut_large(rows, large, limit, keys) if shards else rows


def _tie(rows: DataFrame) -> list[str]:
    return [SUB_SEQUENCE] if SUB_SEQUENCE in rows.columns else []


def cut_large(rows: DataFrame, large: DataFrame, limit: int, keys: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` rows of each shard in ``large``, and all rows of other shards.

    ``keys`` are those of the rows, if they are stored already.
    """
    tie = _tie(rows)
    keys = rows.select(*SHARD_KEY, "sequenceNumber", *tie) if keys is None else keys
    keys = keys.join(large, SHARD_KEY, "left_semi")
    place = F.struct(norm_seq("sequenceNumber"), *tie)
    bounds = materialise(
        with_shard_ordinal(keys, tie_break=tuple(tie))
        .filter(F.col("ordinal") == limit)
        .select(*SHARD_KEY, place.alias("_last")),
        "bounds",
    )
    inside = F.col("_last").isNull() | (place <= F.col("_last"))
    return rows.join(bounds, SHARD_KEY, "left").filter(inside).select(*rows.columns)


def batch_slice(
    feed: DataFrame,
    positions: DataFrame,
    page: int = DEFAULT_PAGE,
    cap: int = DEFAULT_CAP,
) -> DataFrame:
    """The rows of one batch: each shard from its position, up to the limit."""
    return cap_per_shard(apply_positions(feed, positions), page, cap)
