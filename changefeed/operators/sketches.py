"""Mergeable summaries of arrival lag and of distinct keys.

A summary is one row of bounded size per group: how many records, how many of them
fall into each range of lag (ranges grow by a fixed factor, so a quantile is known to
that factor), and a sketch of the distinct keys. Summaries of a shard and hour add up
to those of a day or a stream without a look at the records.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Ratio of the ends of a range of lag: a quantile is off by less than this factor.
GROWTH = 1.02
# Logarithm of the size of the sketch of keys: a standard error of some 1.6 percent.
KEY_BITS = 12


def lag_range(lag_ms: Column) -> Column:
    """The range that holds a lag, from 0 (a millisecond or less); null for null."""
    return F.ceil(F.log(F.greatest(lag_ms, F.lit(1)).cast("double")) / math.log(GROWTH)).cast("int")


def summarise(records: DataFrame, groups: list[str], lag_ms: Column, key: Column) -> DataFrame:
    """One summary per group: ``groups, records, lags, keys``.

    A record without a lag counts among the records and keys, not among the lags; a
    null key is no key. Records are aggregated before the shuffle.
    """
    parts = (
        records.select(*groups, F.when(lag_ms.isNotNull(), lag_range(lag_ms)).alias("_range"), key.alias("_key"))
        .groupBy(*groups, "_range")
        .agg(F.count(F.lit(1)).alias("_n"), F.hll_sketch_agg("_key", KEY_BITS).alias("_keys"))
    )
    return _gather(parts, groups)


def roll_up(summaries: DataFrame, groups: list[str]) -> DataFrame:
    """The summaries of coarser groups, from those of finer ones alone."""
    # The sketch and the records without a lag travel with one row of each summary.
    lost = F.col("records") - F.aggregate("lags", F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    none = F.struct(F.lit(None).cast("int").alias("range"), lost.alias("n"))
    parts = summaries.select(
        *groups, F.explode(F.concat(F.array(none), "lags")).alias("_x"), "keys"
    ).select(
        *groups,
        F.col("_x.range").alias("_range"),
        F.col("_x.n").alias("_n"),
        F.when(F.col("_x.range").isNull(), F.col("keys")).alias("_keys"),
    )
    merged = parts.groupBy(*groups, "_range").agg(F.sum("_n").alias("_n"), F.hll_union_agg("_keys").alias("_keys"))
    return _gather(merged, groups)


def _gather(parts: DataFrame, groups: list[str]) -> DataFrame:
    # A list has one entry per range of lag, some two thousand for any 64-bit number.
    entry = F.when(F.col("_range").isNotNull(), F.struct(F.col("_range").alias("range"), F.col("_n").alias("n")))
    return parts.groupBy(*groups).agg(
        F.sum("_n").alias("records"),
        F.sort_array(F.collect_list(entry)).alias("lags"),
        F.hll_union_agg("_keys").alias("keys"),
    )


def lag_quantile(lags: str, share: float) -> Column:
    """The lag in milliseconds that ``share`` of the records do not exceed: the end of its range."""
    total = F.aggregate(lags, F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    wanted = F.greatest(F.ceil(total * share), F.lit(1))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("int").alias("range"))
    found = F.aggregate(
        lags,
        start,
        lambda at, x: F.struct(
            (at["n"] + x["n"]).alias("n"),
            F.when(at["n"] < wanted, x["range"]).otherwise(at["range"]).alias("range"),
        ),
    )["range"]
    return F.round(F.pow(F.lit(GROWTH), found)).cast("bigint")


def distinct_keys(keys: str) -> Column:
    """How many distinct keys a summary has seen, estimated."""
    return F.hll_sketch_estimate(keys)
