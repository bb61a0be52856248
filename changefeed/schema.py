"""Schemas and fixed names shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The record envelope every feed has.
ENVELOPE = T.StructType(
    [
        T.StructField("data", T.BinaryType()),
        T.StructField("streamName", T.StringType()),
        T.StructField("partitionKey", T.StringType()),
        T.StructField("sequenceNumber", T.StringType()),
        T.StructField("approximateArrivalTimestamp", T.TimestampType()),
    ]
)

# The six kinds of position.
TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"
AT_TIMESTAMP = "AT_TIMESTAMP"
AFTER_SEQUENCE_NUMBER = "AFTER_SEQUENCE_NUMBER"
AT_SEQUENCE_NUMBER = "AT_SEQUENCE_NUMBER"
SHARD_END = "SHARD_END"

# A shard is named by its stream and its id; several streams may share a table.
SHARD_KEY = ["streamName", "shardId"]

POSITIONS = T.StructType(
    [
        T.StructField("streamName", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("iteratorType", T.StringType()),
        T.StructField("iteratorPosition", T.StringType()),
    ]
)

CATALOGUE = T.StructType(
    [
        T.StructField("streamName", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("parentShardId", T.StringType()),
        T.StructField("adjacentParentShardId", T.StringType()),
        T.StructField("startSeq", T.StringType()),
        T.StructField("endSeq", T.StringType()),
    ]
)

# Soft limits of one batch.
DEFAULT_PAGE = 10_000
DEFAULT_CAP = 100_000


def _tagged(attributes: dict[str, str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, T.StructType([T.StructField(tag, T.StringType())]))
            for name, tag in attributes.items()
        ]
    )


def event_schema(
    image: dict[str, str], keys: dict[str, str], body: str = "change"
) -> T.StructType:
    """Schema of the JSON document inside ``data``.

    ``image`` and ``keys`` map attribute names to their type tag (``"N"`` or
    ``"S"``); ``body`` is the name the producer gives the change struct.
    """
    change = T.StructType(
        [
            T.StructField("ApproximateCreationDateTime", T.LongType()),
            T.StructField("Keys", _tagged(keys)),
            T.StructField("NewImage", _tagged(image)),
            T.StructField("SequenceNumber", T.StringType()),
            T.StructField("SizeBytes", T.LongType()),
            T.StructField("StreamViewType", T.StringType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("awsRegion", T.StringType()),
            T.StructField(body, change),
            T.StructField("eventID", T.StringType()),
            T.StructField("eventName", T.StringType()),
            T.StructField("eventSource", T.StringType()),
            T.StructField("eventVersion", T.StringType()),
        ]
    )
