"""As-of join: each row with the entry that was valid at its time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from changefeed.storage import materialise

# Rows of one key and bucket that are matched in one task.
ROWS_PER_PART = 1_000_000


def asof_join(
    rows: DataFrame,
    entries: DataFrame,
    keys: list[str],
    time: str,
    valid_from: str,
    width_seconds: int,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """All ``rows``, with the newest entry of their key that is not later than ``time``.

    Time is cut into buckets. A small table of one row per key and bucket carries the
    last entry of earlier buckets into each, and knows how many rows it has; then
    rows meet only entries of their own bucket and the one carried in. A bucket with
    more than ``rows_per_part`` rows is dealt to several tasks by a hash of the row,
    each with its own copy of the bucket's entries, so a hot key or hour is split.
    Choose the width so that a bucket holds a moderate number of entries.

    Rows before the first entry, without a time or with a null key get nulls. Entries
    without a time are left out; of entries of one time the greatest by its other
    columns counts. Columns of ``entries`` other than the keys are added, and must
    have names that ``rows`` does not have.
    """
    added = [c for c in entries.columns if c not in keys]
    clash = set(added) & set(rows.columns)
    if clash:
        raise ValueError(f"rows and entries both have columns {sorted(clash)}")
    place = [*keys, "_bucket"]
    group = [*place, "_part"]
    dated = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*keys, time]])
    whole = F.struct(*rows.columns)
    placed = rows.filter(dated).select(
        *keys, _bucket(time, width_seconds), F.col(time).cast("timestamp").alias("_at"), whole.alias("_row")
    )
    valid = F.col(valid_from).isNotNull()
    known = entries.filter(valid).select(
        *keys,
        _bucket(valid_from, width_seconds),
        F.col(valid_from).cast("timestamp").alias("_at"),
        F.struct(valid_from, *[c for c in added if c != valid_from]).alias("_entry"),
    )
    buckets = materialise(_buckets(placed, known, keys, rows_per_part), "buckets")

    none = F.lit(None).cast(known.schema["_entry"].dataType)
    no_row = F.lit(None).cast(placed.schema["_row"].dataType)
    parts = buckets.select(*place, "_parts")
    each = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part")
    wanted = placed.join(parts, place).select(
        *place,
        F.pmod(F.xxhash64(F.to_json("_row")), F.col("_parts")).cast("int").alias("_part"),
        "_at",
        none.alias("_entry"),
        "_row",
    )
    inside = known.join(parts.filter(F.col("_parts") > 0), place).select(*place, each, "_at", "_entry", no_row.alias("_row"))
    carried = buckets.filter((F.col("_parts") > 0) & F.col("_carried").isNotNull()).select(
        *place, each, F.lit(None).cast("timestamp").alias("_at"), F.col("_carried").alias("_entry"), no_row.alias("_row")
    )
    # The carried entry has no time and comes first; at one time entries come before rows.
    order = [F.col("_at").asc_nulls_first(), F.col("_row").isNotNull(), "_entry"]
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        wanted.unionByName(inside)
        .unionByName(carried)
        .withColumn("_found", F.last("_entry", ignorenulls=True).over(upto))
        .filter(F.col("_row").isNotNull())
        .select("_row.*", *[F.col("_found")[c].alias(c) for c in added])
    )
    rest = rows.filter(~dated)
    return found.unionByName(rest.select("*", *[F.lit(None).cast(entries.schema[c].dataType).alias(c) for c in added]))


def _bucket(time: str, width_seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (width_seconds * 1_000_000)).alias("_bucket")


def _buckets(placed: DataFrame, known: DataFrame, keys: list[str], rows_per_part: int) -> DataFrame:
    """Per key and bucket: into how many parts its rows go, and the last entry before it.

    The window runs over a key's buckets, not over its rows.
    """
    place = [*keys, "_bucket"]
    counted = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    newest = known.groupBy(*place).agg(F.max(F.struct("_at", "_entry"))["_entry"].alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counted.join(newest, place, "full")
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
        .select(*place, F.ceil(F.coalesce("_n", F.lit(0)) / rows_per_part).cast("int").alias("_parts"), "_carried")
    )
