"""Small feeds and catalogues for tests."""

from datetime import datetime, timedelta

from changefeed.schema import CATALOGUE, ENVELOPE, POSITIONS
from pyspark.sql import types as T

FEED = T.StructType([*ENVELOPE.fields, T.StructField("shardId", T.StringType())])
START = datetime(2024, 1, 1)


def feed_of(spark, counts, stream="s", first=1, width=21, data=b"{}"):
    """A feed with ``counts[shard]`` records per shard; numbers run on over shards."""
    rows, seq = [], first
    for shard, count in counts.items():
        for _ in range(count):
            at = START + timedelta(seconds=seq)
            rows.append((data, stream, "k", str(seq).zfill(width), at, shard))
            seq += 1
    return spark.createDataFrame(rows, FEED)


def catalogue_of(spark, shards, stream="s"):
    """``shards``: id -> (parent, adjacent parent, start, end)."""
    return spark.createDataFrame([(stream, s, *rest) for s, rest in shards.items()], CATALOGUE)


def positions_of(spark, at, stream="s"):
    """``at``: id -> (type, position)."""
    return spark.createDataFrame([(stream, s, *p) for s, p in at.items()], POSITIONS)


def as_dict(positions):
    return {
        r["shardId"]: (r["iteratorType"], r["iteratorPosition"]) for r in positions.collect()
    }


def seqs(rows):
    return sorted((r["shardId"], r["sequenceNumber"]) for r in rows.select("shardId", "sequenceNumber").collect())
