"""Shard lineage over a catalogue of shards (splits and merges)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from changefeed.functions.sequence import norm_seq
from changefeed.schema import SHARD_KEY
from changefeed.storage import materialise, materialise_counted, scratch_path

# Generations that a frontier moves before what it has reached is written.
_GENERATIONS = 8
# Generations after which rows of the same shard are merged.
_UNMERGED = 4

_REACHED = T.StructType(
    [
        T.StructField("streamName", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("round", T.IntegerType()),
    ]
)


def open_shards(catalogue: DataFrame) -> DataFrame:
    """Shards that still take records."""
    return catalogue.filter(F.col("endSeq").isNull())


def closed_shards(catalogue: DataFrame) -> DataFrame:
    """Shards that were split, merged or ended."""
    return catalogue.filter(F.col("endSeq").isNotNull())


def shard_parents(catalogue: DataFrame) -> DataFrame:
    """(shard, parent) pairs; only parents that are listed themselves."""
    both = F.array_distinct(F.array("parentShardId", "adjacentParentShardId"))
    named = catalogue.select(*SHARD_KEY, F.explode(both).alias("parentId")).filter(
        F.col("parentId").isNotNull()
    )
    listed = catalogue.select("streamName", F.col("shardId").alias("parentId"))
    return named.join(listed, ["streamName", "parentId"], "left_semi").select(
        *SHARD_KEY, "parentId"
    )


def shard_children(catalogue: DataFrame) -> DataFrame:
    """Each parent with the sorted list of its children.

    A list is as long as one split is wide; :func:`shard_parents` gives the same
    pairs as rows.
    """
    return (
        shard_parents(catalogue)
        .groupBy("streamName", "parentId")
        .agg(F.sort_array(F.collect_list("shardId")).alias("children"))
    )


def open_parent_violations(catalogue: DataFrame) -> DataFrame:
    """Open shards that already have children: listing raced with a reshard."""
    parents = shard_parents(catalogue).select("streamName", F.col("parentId").alias("shardId"))
    return open_shards(catalogue).select(*SHARD_KEY).join(parents, SHARD_KEY, "left_semi")


def require_closed_parents(catalogue: DataFrame) -> DataFrame:
    """The catalogue itself; reading it fails if a parent is still open."""
    bad = open_parent_violations(catalogue).withColumn("_open", F.lit(True))
    message = F.concat(
        F.lit("shard "),
        F.col("shardId"),
        F.lit(" has children but is not closed; the listing raced with a reshard"),
    )
    checked = F.when(F.col("_open"), F.raise_error(message).cast("string")).otherwise(
        F.col("shardId")
    )
    return (
        catalogue.join(bad, SHARD_KEY, "left")
        .withColumn("shardId", checked)
        .select(*catalogue.columns)
    )


def with_ancestors(shards: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The given shards and all their listed ancestors, each once.

    A frontier of shards not reached before moves some generations a round, and what
    a round reaches is written to the shared folder. A shard has one row after every
    generation, however many paths lead to it, so nothing is larger than the
    catalogue. A lineage that leads back to itself fails.
    """
    spark = catalogue.sparkSession
    parents = materialise(shard_parents(catalogue).withColumnRenamed("parentId", "next"), "parents")
    place = scratch_path(spark, "reached")
    frontier = shards.select(*SHARD_KEY).distinct().withColumn("age", F.lit(0))
    frontier.write.parquet(f"{place}/round=0")
    rounds = 0
    while True:
        reached = spark.read.schema(_REACHED).parquet(place)
        last = F.col("age") == rounds * _GENERATIONS
        moved = reached.filter((F.col("round") == rounds) & last).drop("round")
        moved = _moved(moved, parents, rounds * _GENERATIONS, F.min)
        rounds += 1
        seen = Observation()
        (
            moved.join(reached.select(*SHARD_KEY), SHARD_KEY, "left_anti")
            .observe(seen, F.count(F.when(F.col("age") == rounds * _GENERATIONS, 1)).alias("rows"))
            .write.parquet(f"{place}/round={rounds}")
        )
        if not seen.get["rows"]:
            break
    reached = spark.read.schema(_REACHED).parquet(place).select(*SHARD_KEY)
    _require_no_cycle(reached, parents.withColumnRenamed("next", "parentId"), catalogue)
    return reached


def _moved(rows: DataFrame, edges: DataFrame, age: int, keep: Callable[[str], Column]) -> DataFrame:
    """Rows of an age moved some generations along the edges, each shard once.

    ``keep`` tells which age a shard has that is reached in several ways. A shard has
    two parents at most, so between two merges of equal shards no more than
    ``2 ** _UNMERGED`` ways meet in one.
    """
    for step in range(_GENERATIONS):
        rows = _further(rows, edges, age + step)
        if (step + 1) % _UNMERGED == 0:
            rows = rows.groupBy(*SHARD_KEY).agg(keep("age").alias("age"))
    return rows


def _further(rows: DataFrame, edges: DataFrame, age: int) -> DataFrame:
    """All rows, and for those of an age one more at the end of each edge, one older."""
    step = edges.select(F.col("streamName").alias("_stream"), F.col("shardId").alias("_of"), "next")
    newest = F.when(F.col("age") == age, F.col("shardId"))
    itself, on = F.struct("shardId", "age"), F.struct(F.col("next").alias("shardId"), F.lit(age + 1).alias("age"))
    return (
        rows.join(step, (F.col("streamName") == F.col("_stream")) & (newest == F.col("_of")), "left")
        .select(
            "streamName",
            F.explode(F.when(F.col("_of").isNull(), F.array(itself)).otherwise(F.array(itself, on))).alias("_s"),
        )
        .select("streamName", "_s.*")
    )


def shard_levels(catalogue: DataFrame) -> DataFrame:
    """How many generations a shard has before it, by the longest way: shard key, ``level``.

    A shard is on level 0 if it has no listed parent, else one above its highest
    parent, so all shards of one level can be read at once, after those of the levels
    below. The shards of a level move their children up, some generations a round; a
    shard reached again from a higher level is raised. One row per shard is all that
    is ever built. A lineage that leads back to itself fails.
    """
    parents = materialise(shard_parents(catalogue), "parents")
    shards = catalogue.select(*SHARD_KEY).distinct()
    _require_no_cycle(shards, parents, catalogue)
    children = materialise(
        parents.select("streamName", F.col("parentId").alias("shardId"), F.col("shardId").alias("next")), "children"
    )
    levels = materialise(shards.join(parents, SHARD_KEY, "left_anti").withColumn("age", F.lit(0)), "levels")
    top = 0
    while True:
        levels = _moved(levels, children, top, F.max)
        top += _GENERATIONS
        seen = Observation()
        on_top = F.count(F.when(F.col("age") == top, 1)).alias("rows")
        levels = materialise(levels.observe(seen, on_top), "levels")
        if not seen.get["rows"]:
            return levels.withColumnRenamed("age", "level")


def shard_ancestors(shards: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The listed ancestors of the given shards, each once, without these shards."""
    return with_ancestors(shards, catalogue).join(shards, SHARD_KEY, "left_anti")


def _require_no_cycle(reached: DataFrame, parents: DataFrame, catalogue: DataFrame) -> None:
    # A cycle has a parent that does not start before its child. Only if there is
    # one are childless shards taken away, until none is left or all have children.
    start = catalogue.select(*SHARD_KEY, norm_seq("startSeq").alias("_start"))
    before = start.select("streamName", F.col("shardId").alias("parentId"), F.col("_start").alias("_before"))
    edges = parents.join(reached, SHARD_KEY)
    late = edges.join(start, SHARD_KEY).join(before, ["streamName", "parentId"])
    if late.filter(~F.coalesce(F.col("_before") < F.col("_start"), F.lit(False))).isEmpty():
        return
    left, count = materialise_counted(edges, "edges")
    while count:
        parent = left.select("streamName", F.col("parentId").alias("shardId")).distinct()
        left, fewer = materialise_counted(left.join(parent, SHARD_KEY, "left_semi"), "edges")
        if fewer == count:
            raise ValueError("shard lineage has a cycle")
        count = fewer


def latest_positions(
    catalogue: DataFrame, previous: DataFrame, start: str, start_position: str = ""
) -> DataFrame:
    """Positions for the next batch.

    Previous ones stay as they are. Open shards not seen before, and those of
    their ancestors not seen before, join at the initial position.
    """
    known = previous.select(*SHARD_KEY)
    new = open_shards(catalogue).select(*SHARD_KEY).join(known, SHARD_KEY, "left_anti")
    if new.isEmpty():
        return previous.select(*SHARD_KEY, "iteratorType", "iteratorPosition")
    added = with_ancestors(new, catalogue).join(known, SHARD_KEY, "left_anti")
    return previous.select(*SHARD_KEY, "iteratorType", "iteratorPosition").unionByName(
        added.select(
            *SHARD_KEY,
            F.lit(start).alias("iteratorType"),
            F.lit(start_position).alias("iteratorPosition"),
        )
    )
