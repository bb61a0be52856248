"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from changefeed.storage import materialise

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: Hexadecimal digits of a document's hash: in all, and those that one level sorts out.
HASH_DIGITS, LEVEL_DIGITS = 9, 3
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text_col: str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, source_col: str, size_col: str, weights: Sequence[int], most: int
) -> DataFrame:
    """``(source, source_size, target)``, one row per source.

    Sources in code point order, null last, take the weights in turn. They share
    the sum of all sizes by weight; none gets more than ``most`` times its size,
    and what that leaves over is shared by weight among the others. With sources
    in order of ``size / weight``, those that stop at their bound come first, so
    one running sum finds them all. Works on one row per source.
    """
    totals = sizes.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(size_col).alias("source_size")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    shared = (
        totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn % len(weights) + 1))
        .withColumn("left_words", F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(onward))
        .withColumn("stops", F.expr(f"{most} * source_size / weight <= left_words / left_weight"))
    )
    ends = F.struct("left_words", "left_weight")
    level = F.first(F.when(~F.col("stops"), ends), True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return shared.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("stops"), (most * F.col("source_size")).cast("double"))
        .otherwise(F.col("weight") * F.col("level.left_words") / F.col("level.left_weight"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """``(id_col, size, source_size, target, taken)`` for every row of ``docs``.

    A source that wants ``r`` times its words takes every document floor(r) times,
    and once more those whose hash is below a threshold. The threshold comes from
    nested histograms: words by source and leading hash digits; the bucket in
    which the running sum passes the budget is the boundary, and only its
    documents are looked at by their next digits. Nothing is sorted. Documents at
    the last boundary share what is left in proportion to their size, each taking
    its first words, so a source misses its target by a word per such document.

    The hash is that of the id, so reruns agree, and rows with one id are treated
    alike. A null or blank text has size 0 and takes 0; a null source is a source,
    last in order; null ids share a hash. An empty table gives no rows.
    """
    sized = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(text_col).alias("size"),
            _hash(id_col).alias("hash"),
        ),
        "sized",
    )
    found = thresholds(sized, weights, most)
    return sized.join(found, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "size", "source_size", "target", _taken("size", "hash").alias("taken")
    )


def repeat_mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`mix` takes it.

    A document taken in part comes whole if that part is half or more. A text
    without a word adds nothing to a mix and is not taken. Columns stay.
    """
    sized = materialise(
        docs.select(
            F.col(source_col).alias("source"), word_count(text_col).alias("size"), _hash(id_col).alias("hash")
        ),
        "sized",
    )
    found = thresholds(sized, weights, most)
    found = found.select(*(F.col(c).alias(f"__{c}") for c in found.columns))
    counted = docs.withColumns({"__size": word_count(text_col), "__hash": _hash(id_col)})
    times = F.round(_taken("__size", "__hash", "__") / F.col("__size")).cast("int")
    return (
        counted.where("__size > 0")
        .join(found, docs[source_col].eqNullSafe(F.col("__of")))
        .withColumn("__times", times)
        .where("__times > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        .select(*(docs[c] for c in docs.columns))
    )


def _hash(id_col: str) -> Column:
    digits = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.substring(digits, 1, HASH_DIGITS)


def _taken(size: str, hashed: str, mark: str = "") -> Column:
    """Words taken of a document beside its source's thresholds, whose names begin with ``mark``."""
    full, prefix, rest, inside = (F.col(f"{mark}{name}") for name in ("full", "prefix", "rest", "inside"))
    share = (
        F.when(F.col(hashed) < prefix, F.col(size))
        .when((F.col(hashed) == prefix) & (inside > 0), F.floor(F.col(size) * rest / inside))
        .otherwise(0)
    )
    return (full * F.col(size) + share).cast("bigint")


def thresholds(sized: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """How much of each source is taken, one row per source: ``of``, ``source_size``,
    ``target``, ``full`` times, and of the last time all below the hash ``prefix``
    and ``rest`` of the ``inside`` words at it. ``sized`` has source, size and hash.
    """
    targets = source_targets(sized, "source", "size", weights, most)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    bound = materialise(
        targets.withColumn("full", F.floor(times))
        .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
        .withColumn("prefix", F.lit("")),
        "budget",
    )
    for _ in range(HASH_DIGITS // LEVEL_DIGITS):
        bound = materialise(_refine(sized, bound), "bounds")
    return bound.select(F.col("source").alias("of"), "source_size", "target", "full", "rest", "inside", "prefix")


def _refine(sized: DataFrame, bound: DataFrame) -> DataFrame:
    """The boundaries of all sources, by some more digits of the hash.

    ``rest`` becomes what the boundary bucket must still give, ``inside`` what it
    holds. The bucket is the first whose running sum passes the rest; if none
    does, the last one, which then is taken whole.
    """
    held = bound.select(F.col("source").alias("of"), "prefix", "rest")
    digits = F.length("prefix")
    buckets = (
        sized.join(
            held,
            F.col("source").eqNullSafe(F.col("of"))
            & (F.substring("hash", F.lit(1), digits) == F.col("prefix")),
        )
        .groupBy("of", F.substring("hash", F.lit(1), digits + LEVEL_DIGITS).alias("bucket"))
        .agg(F.sum("size").alias("words"), F.first("rest").alias("budget"))
    )
    up_to = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = buckets.withColumn("sum", F.sum("words").over(up_to))
    passed = F.struct("bucket", "words", (F.col("budget") - F.col("sum") + F.col("words")).alias("rest"))
    edge = summed.groupBy("of").agg(
        F.coalesce(
            F.min(F.when(F.col("sum") > F.col("budget"), passed)), F.max(passed)
        ).alias("edge")
    )
    return (
        bound.drop("prefix", "rest", "inside")
        .join(edge, F.col("source").eqNullSafe(F.col("of")))
        .select(
            *(c for c in bound.columns if c not in ("prefix", "rest", "inside")),
            F.col("edge.bucket").alias("prefix"),
            F.col("edge.rest").alias("rest"),
            F.col("edge.words").alias("inside"),
        )
    )
