"""Progress: next positions, next batch ids and offset documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changefeed.functions.sequence import norm_seq
from changefeed.schema import AFTER_SEQUENCE_NUMBER, SHARD_END, SHARD_KEY

# Names inside an offset document.
METADATA = "metadata"
BATCH_ID = "batchId"
STREAM_NAME = "streamName"
ITERATOR_TYPE = "iteratorType"
ITERATOR_POSITION = "iteratorPosition"


def next_positions(
    slice_: DataFrame, positions: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """Where each shard stands after a slice was read.

    Closed and read to its end: ``SHARD_END``. Some rows read: after the last
    one. No rows: unchanged.
    """
    read = slice_.groupBy(*SHARD_KEY).agg(
        F.max_by("sequenceNumber", norm_seq("sequenceNumber")).alias("_last")
    )
    ends = catalogue.select(*SHARD_KEY, "endSeq")
    was_after = F.when(
        F.col("iteratorType") == AFTER_SEQUENCE_NUMBER, F.col("iteratorPosition")
    )
    stands = norm_seq(F.coalesce(F.col("_last"), was_after))
    done = (F.col("iteratorType") == SHARD_END) | F.coalesce(
        stands >= norm_seq("endSeq"), F.lit(False)
    )
    return (
        positions.join(read, SHARD_KEY, "left")
        .join(ends, SHARD_KEY, "left")
        .select(
            *SHARD_KEY,
            F.when(done, F.lit(SHARD_END))
            .when(F.col("_last").isNotNull(), F.lit(AFTER_SEQUENCE_NUMBER))
            .otherwise(F.col("iteratorType"))
            .alias("iteratorType"),
            F.when(done, F.lit(""))
            .when(F.col("_last").isNotNull(), F.col("_last"))
            .otherwise(F.col("iteratorPosition"))
            .alias("iteratorPosition"),
        )
    )


def next_batch_ids(streams: DataFrame, log: DataFrame, positions: DataFrame) -> DataFrame:
    """The next batch id of every stream: ``streamName, batchId, isNew``.

    One more than the last one (-1 before the first) if the stream has any
    shard; a stream without shards stays where it was and makes no batch.
    """
    last = log.groupBy("streamName").agg(F.max("batch_id").alias("_last"))
    seen = positions.select("streamName").distinct().withColumn("_seen", F.lit(True))
    previous = F.coalesce(F.col("_last"), F.lit(-1)).cast("bigint")
    has_shards = F.coalesce(F.col("_seen"), F.lit(False))
    return (
        streams.select("streamName")
        .distinct()
        .join(last, "streamName", "left")
        .join(seen, "streamName", "left")
        .select(
            "streamName",
            F.when(has_shards, previous + 1).otherwise(previous).alias("batchId"),
            has_shards.alias("isNew"),
        )
    )


def previous_positions(log: DataFrame, batch_id: int) -> DataFrame:
    """Positions that batch ``batch_id`` wrote; none before the first batch.

    A missing batch fails when the result is read: going on would skip records.
    """
    found = log.filter(F.col("batch_id") == batch_id).select(
        *SHARD_KEY, "iteratorType", "iteratorPosition"
    )
    if batch_id < 0:
        return found.filter(F.lit(False))
    message = (
        f"the position log has no batch {batch_id}; going on would skip its records"
    )
    present = found.select(F.count(F.lit(1))).scalar()
    # The empty case has no row to fail on, so it gets one that fails.
    missing = found.sparkSession.range(1).filter(present == 0).select(
        *[
            F.raise_error(F.lit(message)).cast("string").alias(c)
            for c in [*SHARD_KEY, "iteratorType", "iteratorPosition"]
        ]
    )
    return found.unionByName(missing)


def offset_encode(positions: DataFrame, parts: int = 1) -> DataFrame:
    """Positions with a ``batchId`` column to offset documents (JSON).

    ``parts`` documents at most per stream and batch, each complete in itself:
    ``streamName, batchId, part, offset``. A shard goes to a part by its id; ask
    for more parts where a stream has more shards than one task should hold.
    """
    if parts < 1:
        raise ValueError("an offset needs one part at least")
    key = ["streamName", "batchId"]
    entry = F.struct(
        "shardId",
        F.coalesce("iteratorType", F.lit("")).alias("kind"),
        F.coalesce("iteratorPosition", F.lit("")).alias("position"),
    )
    documents = (
        positions.withColumn("part", F.pmod(F.xxhash64("shardId"), F.lit(parts)).cast("int"))
        .groupBy(*key, "part")
        .agg(F.sort_array(F.collect_list(entry)).alias("_shards"))
    )
    shards = F.map_from_entries(
        F.transform(
            "_shards",
            lambda s: F.struct(
                s["shardId"],
                F.create_map(
                    F.lit(ITERATOR_TYPE), s["kind"], F.lit(ITERATOR_POSITION), s["position"]
                ),
            ),
        )
    )
    metadata = F.create_map(
        F.lit(METADATA),
        F.create_map(
            F.lit(BATCH_ID),
            F.col("batchId").cast("string"),
            F.lit(STREAM_NAME),
            F.col("streamName"),
        ),
    )
    return documents.select(*key, "part", F.to_json(F.map_concat(metadata, shards)).alias("offset"))


def offset_decode(offsets: DataFrame, offset: str = "offset") -> DataFrame:
    """Offset documents to rows ``streamName, batchId, shardId, iteratorType, iteratorPosition``.

    Text that is not an offset document fails.
    """
    kind = "map<string,map<string,string>>"
    text, doc = F.col(offset), F.col("_doc")
    meta = doc[METADATA]
    shards = F.map_filter(doc, lambda k, _: k != METADATA)
    complete = F.forall(
        F.map_values(shards),
        lambda at: at[ITERATOR_TYPE].isNotNull() & at[ITERATOR_POSITION].isNotNull(),
    )
    batch_id = meta[BATCH_ID].try_cast("bigint")
    valid = F.coalesce(
        meta[STREAM_NAME].isNotNull() & batch_id.isNotNull() & complete, F.lit(False)
    )
    message = F.concat(F.lit("not an offset document: "), F.coalesce(text, F.lit("null")))
    # Checked before the explode, which would drop a document without shards.
    checked = F.when(valid, shards).otherwise(F.raise_error(message).cast(kind))
    return (
        offsets.withColumn("_doc", F.from_json(text, kind))
        .select(
            meta[STREAM_NAME].alias("streamName"),
            batch_id.alias("batchId"),
            F.explode(checked).alias("shardId", "_at"),
        )
        .select(
            "streamName",
            "batchId",
            "shardId",
            F.col("_at")[ITERATOR_TYPE].alias("iteratorType"),
            F.col("_at")[ITERATOR_POSITION].alias("iteratorPosition"),
        )
    )
