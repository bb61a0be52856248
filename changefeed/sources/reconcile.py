"""Where two stored copies of a feed differ, found by digests of ranges.

``<path>/digests``  per run of :func:`write_digests` and level: count and digest of the
                    records of each range, for the appends that had none yet

A range is what sequence keys have in common without their last digits, so both
copies have the same ranges whatever their files are; cutting more digits gives the
range above, up to the whole shard. Digests of a range add up from those below.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from changefeed import storage
from changefeed.schema import ENVELOPE, SHARD_KEY
from changefeed.sources.store import complete, read_feed, read_pages

# Digits cut from a sequence key by level, finest first; the last level is a shard.
CUTS = (3, 5, 7)

_NODE = [*SHARD_KEY, "node"]
_SUM = T.DecimalType(38, 0)
_DIGESTS = T.StructType(
    [
        T.StructField("append", T.StringType()),
        T.StructField("streamName", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("digest", _SUM),
        T.StructField("level", T.IntegerType()),
    ]
)
MISSING, ADDED, CHANGED = "missing", "added", "changed"


def write_digests(spark: SparkSession, path: str) -> None:
    """Bring the digests of a stored feed up to date; only appends without any are read.

    Complete runs count. If two runs take the same append, their equal rows count once.
    """
    root = f"{path.rstrip('/')}/digests"
    known = {r["append"] for r in _stored(spark, path, len(CUTS)).select("append").distinct().collect()}
    new = [name.removeprefix("append=") for name in complete(spark, path.rstrip("/"), "pages")]
    new = [name for name in new if name not in known]
    if not new:
        return
    rows = read_feed(spark, path).filter(F.col("append").isin(new))
    finest = storage.materialise(
        rows.groupBy("append", *SHARD_KEY, _node("seqKey", CUTS[0]).alias("node")).agg(*_digest()), "digests"
    )
    levels = finest.withColumn("level", F.lit(0))
    for level in range(1, len(CUTS) + 1):
        above = F.lit("") if level == len(CUTS) else _node("node", CUTS[level] - CUTS[0])
        levels = levels.unionByName(
            finest.groupBy("append", *SHARD_KEY, above.alias("node"))
            .agg(F.sum("records").alias("records"), F.sum("digest").cast(_SUM).alias("digest"))
            .withColumn("level", F.lit(level))
        )
    levels.write.partitionBy("level").parquet(f"{root}/run={uuid.uuid4().hex}")


def _node(key: str, cut: int) -> Column:
    return F.expr(f"left({key}, greatest(length({key}) - {cut}, 0))")


def _digest() -> list[Column]:
    # The hash passes over nulls, so which columns are null goes in as well.
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in ENVELOPE.names])
    value = F.xxhash64(*ENVELOPE.names, nulls).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("records"), F.sum(value).cast(_SUM).alias("digest")]


def _stored(spark: SparkSession, path: str, level: int) -> DataFrame:
    """The digests of one level, by append; the folders of other levels are not read."""
    root = f"{path.rstrip('/')}/digests"
    runs = complete(spark, path.rstrip("/"), "digests")
    if not runs:
        return spark.createDataFrame([], _DIGESTS)
    found = [spark.read.schema(_DIGESTS).parquet(f"{root}/{run}").filter(F.col("level") == level) for run in runs]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.distinct() if len(runs) > 1 else rows


def differing_ranges(spark: SparkSession, first: str, second: str) -> DataFrame:
    """The finest ranges whose records differ: shard key, ``node``. Reads digests alone.

    Level by level from the shards down, only ranges inside differing ones are
    compared. Equal digests are taken for equal records: sums of 64-bit hashes.
    """
    bad = None
    for level in range(len(CUTS), -1, -1):
        sides = []
        for path in (first, second):
            rows = _stored(spark, path, level)
            if bad is not None:
                up = F.lit("") if level + 1 == len(CUTS) else _node("node", CUTS[level + 1] - CUTS[level])
                above = bad.withColumnRenamed("node", "_above")
                rows = rows.withColumn("_above", up).join(above, [*SHARD_KEY, "_above"], "left_semi")
            sides.append(rows.groupBy(*_NODE).agg(F.struct(F.sum("records"), F.sum("digest")).alias("_sum")))
        here, there = sides
        bad = storage.materialise(
            here.join(there.withColumnRenamed("_sum", "_other"), _NODE, "full")
            .filter(~F.col("_sum").eqNullSafe(F.col("_other")))
            .select(*_NODE),
            "differing",
        )
    return bad


def _files(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """The files that hold records of the ranges: ``append, part``, shard key.

    A page is needed if there are more ranges up to its last key than before its
    first one; a running count per shard over ranges and pages tells, without a
    join of all pages with all ranges.
    """
    page = ["append", "part", "firstKey"]
    pages = read_pages(spark, path).select(*SHARD_KEY, *page, "lastKey")
    none = [F.lit(None).cast(pages.schema[c].dataType).alias(c) for c in page]
    marks = ranges.select(*SHARD_KEY, *none, F.col("node").alias("_at"), F.lit(1).alias("_turn"))
    for key, turn in (("firstKey", 0), ("lastKey", 2)):
        marks = marks.unionByName(
            pages.select(*SHARD_KEY, *page, _node(key, CUTS[0]).alias("_at"), F.lit(turn).alias("_turn"))
        )
    upto = Window.partitionBy(*SHARD_KEY).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    return (
        marks.withColumn("_ranges", F.count(F.when(F.col("_turn") == 1, 1)).over(upto))
        .filter(F.col("_turn") != 1)
        .groupBy(*SHARD_KEY, *page)
        .agg((F.max("_ranges") - F.min("_ranges")).alias("_inside"))
        .filter(F.col("_inside") > 0)
        .select("append", "part", *SHARD_KEY)
        .distinct()
    )


def rows_in_ranges(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """The records of some ranges, read from the files that can hold them."""
    files = storage.materialise(_files(spark, path, ranges), "files")
    feed = read_feed(spark, path)
    # A comparison, unlike "is not null", lets Spark prune partitions by this side.
    return (
        feed.join(files.filter(F.col("append") > ""), ["append", "part", *SHARD_KEY])
        .withColumn("node", _node("seqKey", CUTS[0]))
        .join(ranges, _NODE, "left_semi")
        .select(*feed.columns)
    )


def reconcile(spark: SparkSession, first: str, second: str) -> DataFrame:
    """How the second copy differs from the first: shard key, ``seqKey, difference``.

    ``missing`` records are in the first copy only, ``added`` ones in the second only;
    ``changed`` are those of one number that are not the same in content or in how
    often they come. The order of equal numbers does not count. Only files that hold
    records of differing ranges are read, and no record is shuffled but those of such
    ranges, as a hash. Digests of both copies are brought up to date first.
    """
    for path in (first, second):
        write_digests(spark, path)
    ranges = differing_ranges(spark, first, second)
    place = [*SHARD_KEY, "seqKey"]

    def side(path: str, name: str) -> DataFrame:
        hashed = rows_in_ranges(spark, path, ranges).groupBy(*place).agg(*_digest())
        return hashed.select(*place, F.struct("records", "digest").alias(name))

    both = side(first, "_first").join(side(second, "_second"), place, "full")
    kind = (
        F.when(F.col("_second").isNull(), MISSING).when(F.col("_first").isNull(), ADDED).otherwise(CHANGED)
    )
    return both.filter(~F.col("_first").eqNullSafe(F.col("_second"))).select(*place, kind.alias("difference"))
