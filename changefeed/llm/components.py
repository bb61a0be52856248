"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changefeed.storage import delete_dir, scratch_path


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node.

    ``component`` is the smallest node reachable. Edges have no direction; null
    ends, loops and repeats are ignored; no edge gives no row. Each round joins
    every node with the smallest of its neighbours and is written to the shared
    folder, so neither a deep lineage nor a component is ever held in one place.
    A hub is a skewed join key, which the adaptive join splits.
    """
    spark = edges.sparkSession
    ends = edges.select(
        F.greatest(left, right).alias("high"), F.least(left, right).alias("low"), left, right
    ).where(f"`{left}` is not null and `{right}` is not null and high <> low")
    path, state = _write(ends.select("high", "low").distinct())
    while True:
        links = spark.read.parquet(path)
        following, after = _write(_small_star(_large_star(links)))
        delete_dir(spark, path)
        path, done = following, after == state
        if done:
            break
        state = after
    stars = spark.read.parquet(path)
    return stars.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        stars.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )


def _write(links: DataFrame) -> tuple[str, tuple]:
    """Store the links; their path, and what tells one set of links from another."""
    spark = links.sparkSession
    path = scratch_path(spark, "links")
    links.write.parquet(path)
    row = spark.read.schema(links.schema).parquet(path).agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))
    )
    return path, tuple(row.first())


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbourhood."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.join(least, "node")
        .where("other > node")
        .select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    joined = links.join(least, "high")
    return (
        joined.where("low <> least")
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .unionByName(least.select("high", F.col("least").alias("low")))
        .distinct()
    )
