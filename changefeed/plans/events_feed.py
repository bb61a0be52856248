"""The ``events`` table as a change feed, with its catalogue and positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changefeed.functions.payload import payload_text
from changefeed.operators.position_log import log_add, log_read
from changefeed.schema import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    LATEST,
    SHARD_END,
    TRIM_HORIZON,
    event_schema,
)
from changefeed.sources.feed import envelope, shard_catalogue, shard_ranges
from changefeed.sources.store import append_feed, read_feed, read_pages, stored_ranges
from changefeed.storage import materialise, scratch_path

STREAM = "events"
FIRST_DAY = "2024-01-01"
BUCKETS = 8
# Records a listed page has, so that shards of the small test tables have several.
PAGE = 5
# Where the feed of mixed lengths is read from.
MIXED_START = "5" + "0" * 24

EVENT = event_schema(image={"id": "N", "n": "S", "value": "N", "k": "N"}, keys={"id": "N"})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _day() -> Column:
    return F.datediff(F.col("ts"), F.lit(FIRST_DAY).cast("date"))


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def shard_id(day: Column, bucket: Column) -> Column:
    return F.concat(F.lit("shardId-"), _padded(day, 5), F.lit("-"), _padded(bucket, 2))


def sequence_number() -> Column:
    return _padded(F.col("event_id") + 1, 21)


def arrival() -> Column:
    return F.col("ts").cast("timestamp")


def _tag(value: Column, tag: str) -> Column:
    return F.struct(value.cast("string").alias(tag))


def document() -> Column:
    """One event as the JSON text its producer would have sent."""
    change = F.struct(
        F.unix_seconds(arrival()).alias("ApproximateCreationDateTime"),
        F.struct(_tag(F.col("event_id"), "N").alias("id")).alias("Keys"),
        F.struct(
            _tag(F.col("event_id"), "N").alias("id"),
            _tag(F.col("event_type"), "S").alias("n"),
            _tag(F.col("value"), "N").alias("value"),
            _tag(F.get_json_object("props", "$.k"), "N").alias("k"),
        ).alias("NewImage"),
        sequence_number().alias("SequenceNumber"),
        F.length("props").cast("bigint").alias("SizeBytes"),
        F.lit("NEW_AND_OLD_IMAGES").alias("StreamViewType"),
    )
    return F.to_json(
        F.struct(
            F.lit("local").alias("awsRegion"),
            change.alias("change"),
            F.col("event_id").cast("string").alias("eventID"),
            F.lit("INSERT").alias("eventName"),
            F.lit("events").alias("eventSource"),
            F.lit("1.0").alias("eventVersion"),
        )
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``events`` as a feed: the envelope and the shard id."""
    return envelope(
        events(spark, sf_dir),
        data=F.encode(document(), "UTF-8"),
        stream=STREAM,
        partition_key=F.col("user_id").cast("string"),
        sequence_number=sequence_number(),
        arrival=arrival(),
        keep=(shard_id(_day(), F.col("user_id") % BUCKETS).alias("shardId"),),
    )


def mixed_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with sequence numbers of very different lengths, some with zeros in front."""
    number = F.col("sequenceNumber").cast("bigint")
    zeros = F.repeat(F.lit("0"), (number % 5 * 11).cast("int"))
    longer = F.concat(F.when(number % 3 == 0, F.lit("000")).otherwise(F.lit("")), number.cast("string"), zeros)
    return feed(spark, sf_dir).withColumn("sequenceNumber", longer)


def shard_day() -> Column:
    return F.substring("shardId", 9, 5).cast("int")


def shard_bucket() -> Column:
    return F.substring("shardId", 15, 2).cast("int")


def lineage_of(ranges: DataFrame, last_day: Column) -> DataFrame:
    """Each day's shard follows the day before's; every tenth day buckets merge."""
    day, bucket = shard_day(), shard_bucket()
    merged = (day > 0) & (day % 10 == 0) & (bucket % 2 == 0)
    return ranges.select(
        "streamName",
        "shardId",
        F.when(day > 0, shard_id(day - 1, bucket)).alias("parentShardId"),
        F.when(merged, shard_id(day - 1, bucket + 1)).alias("adjacentParentShardId"),
        (day < last_day).alias("closed"),
    )


@dataclass(frozen=True)
class Stored:
    """What a running engine keeps as tables."""

    feed_path: str
    ranges: DataFrame
    catalogue: DataFrame
    positions: DataFrame
    log_path: str

    @property
    def spark(self) -> SparkSession:
        return self.catalogue.sparkSession

    @property
    def feed(self) -> DataFrame:
        return read_feed(self.spark, self.feed_path)

    @property
    def log(self) -> DataFrame:
        return log_read(self.spark, self.log_path)


_stored: dict[tuple[str, str], Stored] = {}


def stored(spark: SparkSession, sf_dir: str) -> Stored:
    """The feed, its catalogue, mixed positions and a position log; once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = scratch_path(spark, "feed")
        append_feed(feed(spark, sf_dir), path, page=PAGE)
        ranges = materialise(stored_ranges(read_pages(spark, path)), "ranges")
        last_day = ranges.select(F.max(shard_day())).scalar()
        catalogue = materialise(
            shard_catalogue(ranges, lineage_of(ranges, last_day)), "catalogue"
        )
        log_path = scratch_path(spark, "log")
        write_log(ranges, log_path)
        _stored[key] = Stored(
            path, ranges, catalogue, materialise(mixed_positions(catalogue), "positions"), log_path
        )
    return _stored[key]


def mixed_positions(catalogue: DataFrame) -> DataFrame:
    """Positions of all six kinds, turn by turn over the shards."""
    turn = (shard_day() * BUCKETS + shard_bucket()) % 6
    noon = F.unix_millis(
        F.date_add(F.lit(FIRST_DAY).cast("date"), shard_day()).cast("timestamp")
        + F.expr("INTERVAL 12 HOURS")
    ).cast("string")
    kinds = [
        (TRIM_HORIZON, F.lit("")),
        (LATEST, F.lit("")),
        (AT_TIMESTAMP, noon),
        (AFTER_SEQUENCE_NUMBER, F.col("startSeq")),
        (AT_SEQUENCE_NUMBER, F.col("startSeq")),
        (SHARD_END, F.lit("")),
    ]
    kind = F.element_at(F.array(*[F.lit(k) for k, _ in kinds]), turn + 1)
    position = F.element_at(F.array(*[p for _, p in kinds]), turn + 1)
    return catalogue.select(
        "streamName",
        "shardId",
        kind.alias("iteratorType"),
        position.alias("iteratorPosition"),
    )


def earlier_positions(catalogue: DataFrame, days: int = 28) -> DataFrame:
    """Positions of a batch that ran before the last days' shards appeared."""
    return catalogue.filter(shard_day() < days).select(
        "streamName",
        "shardId",
        F.lit(AFTER_SEQUENCE_NUMBER).alias("iteratorType"),
        F.col("endSeq").alias("iteratorPosition"),
    )


def write_log(ranges: DataFrame, path: str) -> None:
    """A position log with one batch per day.

    A shard is under way in its own day's batch and at its end in the next one.
    The odd buckets' tasks of the first batch were retried further on.
    """
    day = shard_day().cast("bigint")
    after = F.lit(AFTER_SEQUENCE_NUMBER).alias("iteratorType")
    first = ranges.select(
        "streamName", "shardId", after, F.col("startSeq").alias("iteratorPosition"),
        day.alias("batch_id"),
    )
    ended = ranges.select(
        "streamName", "shardId", F.lit(SHARD_END).alias("iteratorType"),
        F.lit("").alias("iteratorPosition"), (day + 1).alias("batch_id"),
    )
    retried = ranges.filter(shard_bucket() % 2 == 1).select(
        "streamName", "shardId", after, F.col("headSeq").alias("iteratorPosition"),
        day.alias("batch_id"),
    )
    log_add(first.unionByName(ended), path)
    log_add(retried, path)


def morning_heads(rows: DataFrame) -> DataFrame:
    """Head of each shard as a planner at noon of its day would have seen it."""
    at = F.col("approximateArrivalTimestamp")
    return shard_ranges(rows.filter(F.hour(at) < 12))


def raced_catalogue(ranges: DataFrame, lineage: DataFrame, rows: DataFrame) -> DataFrame:
    """A listing taken too early: a shard written to in its last half hour is open."""
    late = (F.hour("approximateArrivalTimestamp") == 23) & (
        F.minute("approximateArrivalTimestamp") >= 30
    )
    busy = rows.groupBy("streamName", "shardId").agg(F.max(late).alias("_busy"))
    early = lineage.join(busy, ["streamName", "shardId"], "left").withColumn(
        "closed", F.col("closed") & ~F.coalesce(F.col("_busy"), F.lit(False))
    )
    return shard_catalogue(ranges, early)


def packed(rows: DataFrame) -> DataFrame:
    """A feed with every third record packed: an array of its document and a twin."""
    text = payload_text("data")
    both = F.concat(F.lit("["), text, F.lit(","), text, F.lit("]"))
    third = F.col("sequenceNumber").cast("bigint") % 3 == 1
    return rows.withColumn("data", F.encode(F.when(third, both).otherwise(text), "UTF-8"))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream, of orders; a shard per year and customer bucket."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return envelope(
        rows,
        data=F.encode(F.to_json(F.struct("o_orderkey", "o_orderstatus")), "UTF-8"),
        stream="orders",
        partition_key=F.col("o_custkey").cast("string"),
        sequence_number=_padded(F.col("o_orderkey") + 1, 21),
        arrival=F.col("o_orderdate").cast("timestamp"),
        keep=(
            shard_id(F.year("o_orderdate") - 1990, F.col("o_custkey") % BUCKETS).alias("shardId"),
        ),
    )
