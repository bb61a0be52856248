"""Summaries of lag and keys against exact numbers."""

import random

import pytest
from pyspark.sql import functions as F

from changefeed.operators import sketches

GROUPS = ["stream", "shard"]


@pytest.fixture(scope="module")
def rows(spark):
    # A third of the records are of one shard; some lags and keys are null.
    rng = random.Random(5)
    made = []
    for i in range(6_000):
        shard = "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"
        lag = None if i % 50 == 0 else int(rng.lognormvariate(8, 2)) - 5
        made.append(("x", shard, lag, None if i % 41 == 0 else f"k{rng.randrange(2_500)}"))
    return spark.createDataFrame(made, "stream string, shard string, lag bigint, key string")


def check(found, exact):
    assert found["records"] == len(exact)
    lags = sorted(max(r["lag"], 1) for r in exact if r["lag"] is not None)
    for share, name in ((0.5, "half"), (0.99, "most")):
        true = lags[max(-(-len(lags) * int(share * 100) // 100), 1) - 1]
        assert true - 1 <= found[name] <= true * sketches.GROWTH + 1
    users = len({r["key"] for r in exact} - {None})
    assert abs(found["users"] - users) <= 1 + 0.08 * users


def read(summaries, groups):
    return summaries.select(
        *groups,
        "records",
        sketches.lag_quantile("lags", 0.5).alias("half"),
        sketches.lag_quantile("lags", 0.99).alias("most"),
        sketches.distinct_keys("keys").alias("users"),
    ).collect()


def test_bounds_and_roll_up(spark, rows):
    exact = rows.collect()
    shards = sketches.summarise(rows, GROUPS, F.col("lag"), F.col("key"))
    for found in read(shards, GROUPS):
        check(found, [r for r in exact if r["shard"] == found["shard"]])
    rolled = sketches.roll_up(shards, ["stream"])
    check(read(rolled, ["stream"])[0], exact)
    # The same as a summary of all records at once, whatever the way there.
    whole = sketches.summarise(rows, ["stream"], F.col("lag"), F.col("key"))
    assert read(rolled, ["stream"]) == read(whole, ["stream"])
    assert rolled.select("lags").head() == whole.select("lags").head()


def test_group_without_lags_or_keys(spark):
    bare = spark.createDataFrame([("x", "a", None, None)] * 3, "stream string, shard string, lag bigint, key string")
    shards = sketches.summarise(bare, GROUPS, F.col("lag"), F.col("key"))
    for summaries, groups in ((shards, GROUPS), (sketches.roll_up(shards, ["stream"]), ["stream"])):
        (found,) = read(summaries, groups)
        assert (found["records"], found["half"], found["users"]) == (3, None, 0)
    assert sketches.summarise(bare.limit(0), GROUPS, F.col("lag"), F.col("key")).collect() == []
