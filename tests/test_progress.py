import json

import pytest
from helpers import as_dict, catalogue_of, feed_of, positions_of
from pyspark.sql import functions as F

from changefeed.operators import progress


def test_next_positions(spark):
    feed = feed_of(spark, {"part": 3, "drained": 3, "open": 3}, width=1)
    cat = catalogue_of(
        spark,
        {
            "part": (None, None, "1", "100"),
            "drained": (None, None, "4", "6"),
            "open": (None, None, "7", None),
            "idle": (None, None, "1", None),
            "ended": (None, None, "1", "2"),
            "resumed": (None, None, "1", "00020"),
            "behind": (None, None, "1", "20"),
        },
    )
    horizon = ("TRIM_HORIZON", "")
    before = {
        "part": horizon,
        "drained": horizon,
        "open": horizon,
        "idle": ("LATEST", ""),
        "ended": ("SHARD_END", ""),
        "resumed": ("AFTER_SEQUENCE_NUMBER", "20"),
        "behind": ("AFTER_SEQUENCE_NUMBER", "3"),
        "unlisted": ("AT_TIMESTAMP", "5"),
    }
    assert as_dict(progress.next_positions(feed, positions_of(spark, before), cat)) == {
        "part": ("AFTER_SEQUENCE_NUMBER", "3"),
        "drained": ("SHARD_END", ""),
        "open": ("AFTER_SEQUENCE_NUMBER", "9"),
        "idle": ("LATEST", ""),
        "ended": ("SHARD_END", ""),
        "resumed": ("SHARD_END", ""),
        "behind": ("AFTER_SEQUENCE_NUMBER", "3"),
        "unlisted": ("AT_TIMESTAMP", "5"),
    }


def test_next_batch_ids(spark):
    streams = spark.createDataFrame([("new",), ("old",), ("idle",), ("never",)], "streamName string")
    log = spark.createDataFrame([("old", 4), ("old", 3), ("idle", 7)], "streamName string, batch_id bigint")
    shards = spark.createDataFrame([("new",), ("old",), ("old",)], "streamName string")
    got = progress.next_batch_ids(streams, log, shards).collect()
    assert {r.streamName: (r.batchId, r.isNew) for r in got} == {
        "new": (0, True),
        "old": (5, True),
        "idle": (7, False),
        "never": (-1, False),
    }


AT = {"shard-2": ("TRIM_HORIZON", ""), "shard-1": ("AFTER_SEQUENCE_NUMBER", "0001")}


def test_offset_document(spark):
    document = progress.offset_encode(positions_of(spark, AT).withColumn("batchId", F.lit(3))).first()
    assert document.part == 0
    assert json.loads(document.offset) == {
        "metadata": {"batchId": "3", "streamName": "s"},
        "shard-1": {"iteratorType": "AFTER_SEQUENCE_NUMBER", "iteratorPosition": "0001"},
        "shard-2": {"iteratorType": "TRIM_HORIZON", "iteratorPosition": ""},
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_offset_round_trip(spark, parts):
    at = {f"shard-{i}": ("AFTER_SEQUENCE_NUMBER", str(i)) for i in range(60)}
    rows = positions_of(spark, at).withColumn("batchId", F.lit(9))
    documents = progress.offset_encode(rows, parts)
    assert documents.count() == parts
    decoded = progress.offset_decode(documents)
    assert as_dict(decoded) == at
    assert decoded.count() == len(at)
    assert decoded.select("streamName", "batchId").distinct().collect() == [("s", 9)]


@pytest.mark.parametrize(
    "text",
    [
        "not json",
        None,
        "{}",
        '{"a": 1}',
        '{"metadata": {"batchId": "x", "streamName": "s"}, "a": {"iteratorType": "LATEST", "iteratorPosition": ""}}',
        '{"metadata": {"batchId": "1"}, "a": {"iteratorType": "LATEST", "iteratorPosition": ""}}',
        '{"metadata": {"batchId": "1", "streamName": "s"}, "a": {"iteratorType": "LATEST"}}',
    ],
)
def test_bad_offset_fails(spark, text):
    with pytest.raises(Exception, match="not an offset document"):
        progress.offset_decode(spark.createDataFrame([(text,)], "offset string")).collect()


def test_previous_positions(spark):
    log = positions_of(spark, AT).withColumn("batch_id", F.lit(2))
    assert as_dict(progress.previous_positions(log, 2)) == AT
    assert progress.previous_positions(log, -1).collect() == []
    with pytest.raises(Exception, match="the position log has no batch 3"):
        progress.previous_positions(log, 3).collect()
