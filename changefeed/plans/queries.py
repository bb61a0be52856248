"""One query per operator; each takes a session and a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from changefeed.functions.payload import (
    decode_event,
    new_image,
    payload_text,
    typed_attribute,
    unpack_records,
)
from changefeed.functions.sequence import norm_seq
from changefeed.functions.times import arrival_epoch, arrival_timestamp
from changefeed.operators import lineage, limits, position_log, positions, progress, sketches
from changefeed.operators.asof import asof_join
from changefeed.plans import events_feed as ef
from changefeed.schema import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    ENVELOPE,
    LATEST,
    SHARD_KEY,
    TRIM_HORIZON,
)
from changefeed.sources.feed import shard_catalogue, shard_ranges
from changefeed.sources.reconcile import reconcile
from changefeed.sources.store import (
    append_feed,
    read_pages,
    stored_from,
    stored_ordinal,
    stored_ranges,
    stored_slice,
    write_catalogue,
)
from changefeed.storage import materialise, scratch_path, session_conf
from changefeed.streaming import state
from changefeed.streaming.state import SHUFFLE
from changefeed.streaming.runner import append_stream, drain, read_stream, read_table, write_with_log

Query = Callable[[SparkSession, str], DataFrame]

# Page and cap small enough to cut the shards of the small test tables.
PAGE, CAP = 5, 12
# Larger ones for a stream, which then takes a few batches at most scales.
STREAM_PAGE, STREAM_CAP = 10, 45
# A limit over a thousand rows, and how many shards are thrown together to exceed it.
LARGE_PAGE, LARGE_CAP, FEW_SHARDS = 100, 1_050, 3
LOG_COLUMNS = ["batch_id", "shardId", "iteratorType", "iteratorPosition"]
POSITION_COLUMNS = ["shardId", "iteratorType", "iteratorPosition"]

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    # A trailing underscore keeps a query apart from the function it shows.
    _registry[fn.__name__.rstrip("_")] = fn
    return fn


def queries() -> dict[str, Query]:
    return {name: _in_utc(fn) for name, fn in _registry.items()}


def _in_utc(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def _arrived() -> Column:
    return F.col("approximateArrivalTimestamp").cast("timestamp_ntz").alias(
        "approximateArrivalTimestamp"
    )


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select("shardId", "sequenceNumber", "partitionKey", _arrived())


# Sources


@query
def envelope_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ef.feed(spark, sf_dir).select(*ENVELOPE.names)
    kinds = [F.typeof(c).alias(c) for c in ENVELOPE.names]
    return rows.groupBy(*kinds).agg(F.count(F.lit(1)).alias("records"))


@query
def stream_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = read_stream(
        spark, ef.stored(spark, sf_dir).feed_path, ef.STREAM, startingPosition="TRIM_HORIZON"
    )
    out = scratch_path(spark, "scan")
    drain(lambda: _to_files(stream, out))
    return spark.read.schema(ENVELOPE).parquet(f"{out}/rows").select(
        payload_text("data").alias("data"),
        "streamName",
        "partitionKey",
        "sequenceNumber",
        _arrived(),
    )


@query
def batch_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All records of a range of time; the page listing chooses the files to open.
    path = ef.stored(spark, sf_dir).feed_path
    wanted = {"fromTime": "2024-01-09T06:00:00", "toTime": "2024-01-12"}
    rows = read_table(spark, path, ef.STREAM, includeShardId="true", includeSequenceKey="true", **wanted)
    return rows.select("seqKey", *_KEY_COLUMNS, _arrived(), payload_text("data").alias("data"))


@query
def stream_feed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Batches of a limited stream, appended to another feed; the pages they make there.
    place = scratch_path(spark, "copied")
    stream = _limited(spark, sf_dir)
    drain(lambda: append_stream(stream, f"{place}/feed", f"{place}/checkpoint", "copy", page=PAGE))
    return stored_ordinal(spark, f"{place}/feed").select(*_KEY_COLUMNS, "ordinal", payload_text("data").alias("data"))


_KEY_COLUMNS = ["shardId", "sequenceNumber", "partitionKey"]


def _limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits_of = {"executor.maxRecordPerRead": str(STREAM_PAGE), "executor.maxFetchRecordsPerShard": str(STREAM_CAP)}
    path = ef.stored(spark, sf_dir).feed_path
    return read_stream(spark, path, ef.STREAM, startingPosition="TRIM_HORIZON", includeShardId="true", **limits_of)


def _latest_of_batches(stream: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """A stream in update mode, run up to its head; of each key what its last batch gave.

    ``partitions`` is how many its state has, by default as many as shuffle partitions.
    """
    spark, place = stream.sparkSession, scratch_path(stream.sparkSession, "updates")

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/rows/batch={n}")

    # A query takes this over as it starts, and goes on with what its checkpoint has.
    with session_conf(spark, SHUFFLE, str(partitions or spark.conf.get(SHUFFLE))):
        drain(
            lambda: stream.writeStream.outputMode("update")
            .option("checkpointLocation", f"{place}/checkpoint")
            .foreachBatch(keep)
        )
    rows = spark.read.schema(stream.schema.add("batch", T.LongType())).parquet(f"{place}/rows")
    newest = F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "batch").alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*")


@query
def stream_current_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode_event(_limited(spark, sf_dir), ef.EVENT)
    image = F.struct(typed_attribute("id", "N", "bigint").alias("id"), new_image("n", "S").alias("n"))
    images = state.current_images(rows, ["partitionKey"], image, F.col("event.eventName"))
    records = ef.stored(spark, sf_dir).ranges.select(F.sum("records")).first()[0] or 0
    return _latest_of_batches(images, ["partitionKey"], state.partitions(spark, records)).select(
        "partitionKey", "sequenceNumber", "image.id", "image.n", "removed"
    )


@query
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ef.stored(spark, sf_dir).feed_path
    stream = read_stream(spark, path, ef.STREAM, startingPosition="TRIM_HORIZON", includeShardId="true")
    counts = state.window_counts(stream, "6 hours", "1 day")
    found = _latest_of_batches(counts, [*SHARD_KEY, "start"])
    return found.select("shardId", F.col("start").cast("timestamp_ntz").alias("start"), "records")


@query
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Purchases up to two hours after a view of the same user.
    path = ef.stored(spark, sf_dir).feed_path

    def of(kind: str) -> DataFrame:
        rows = decode_event(read_stream(spark, path, ef.STREAM, startingPosition="TRIM_HORIZON"), ef.EVENT)
        return rows.filter(new_image("n", "S") == kind).select("partitionKey", "sequenceNumber", state.ARRIVAL)

    joined = state.interval_join(of("view"), of("purchase"), "partitionKey", "2 HOURS", "1 day")
    out = scratch_path(spark, "joined")
    drain(lambda: _to_files(joined, out))
    return spark.read.schema(joined.schema).parquet(f"{out}/rows").select(
        "partitionKey", F.col("sequenceNumber").alias("viewed"), F.col("right_sequenceNumber").alias("purchased")
    )


@query
def session_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state.sessions(ef.stored(spark, sf_dir).feed, "12 hours", "1 day")
    ends = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("first", "last")]
    return found.select("partitionKey", *ends, "records")


@query
def asof_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The position in force when a record arrived; a day's batch logs its positions at noon.
    s = ef.stored(spark, sf_dir)
    noon = F.timestamp_add("DAY", F.col("batch_id").cast("int"), F.lit(f"{ef.FIRST_DAY} 12:00:00").cast("timestamp"))
    logged = s.log.select(*SHARD_KEY, noon.alias("validFrom"), "batch_id", "iteratorType", "iteratorPosition")
    rows = s.feed.select(*SHARD_KEY, "sequenceNumber", state.ARRIVAL)
    found = asof_join(rows, logged, SHARD_KEY, state.ARRIVAL, "validFrom", 3600)
    return found.select("shardId", "sequenceNumber", "batch_id", "iteratorType", "iteratorPosition")


@query
def feed_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two copies in files of their own: some records lost in either, some changed.
    rows, place = ef.feed(spark, sf_dir), scratch_path(spark, "copies")
    number = F.col("sequenceNumber").cast("bigint")
    damaged = rows.withColumn("partitionKey", F.when(number % 17 == 0, F.lit("?")).otherwise(F.col("partitionKey")))
    third, fifth = ef.shard_bucket() == 3, ef.shard_bucket() == 5
    append_feed(rows.filter(~(fifth & (number % 13 == 0))), f"{place}/first", page=PAGE)
    second = rows.filter(~third).unionByName(damaged.filter(third & (number % 11 != 0)))
    append_feed(second, f"{place}/second", page=PAGE, files=3)
    return reconcile(spark, f"{place}/first", f"{place}/second").select("shardId", "seqKey", "difference")


@query
def shard_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.shard_levels(ef.stored(spark, sf_dir).catalogue).select("shardId", "level")


@query
def lag_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # How long records wait for the batch that reads them at the end of their day, and
    # whose they are, per shard, and from these summaries per day and stream.
    rows = ef.stored(spark, sf_dir).feed
    arrival = F.col(state.ARRIVAL)
    waits = F.unix_millis(F.date_add(arrival, 1).cast("timestamp")) - F.unix_millis(arrival)
    shards = materialise(sketches.summarise(rows, SHARD_KEY, waits, F.col("partitionKey")), "summaries")
    days = sketches.roll_up(shards.withColumn("day", ef.shard_day()), ["streamName", "day"])
    streams = sketches.roll_up(days, ["streamName"])
    # Exact numbers, to hold the sketches against.
    exact = rows.select(*SHARD_KEY, ef.shard_day().alias("day"), "partitionKey").distinct()
    found = []
    for level, groups, summaries in (("shard", SHARD_KEY, shards), ("day", ["streamName", "day"], days), ("stream", ["streamName"], streams)):
        users = exact.groupBy(*groups).agg(F.count_distinct("partitionKey").alias("users"))
        off = F.abs(sketches.distinct_keys("keys") - F.col("users"))
        found.append(
            summaries.join(users, groups).select(
                F.lit(level).alias("level"),
                F.col(groups[-1]).cast("string").alias("name"),
                "records",
                sketches.lag_quantile("lags", 0.5).alias("median_ms"),
                sketches.lag_quantile("lags", 0.99).alias("most_ms"),
                (off <= 1 + 0.08 * F.col("users")).alias("keys_close"),
            )
        )
    return found[0].unionByName(found[1]).unionByName(found[2])


def _to_files(stream: DataFrame, place: str) -> DataStreamWriter:
    return (
        stream.writeStream.format("parquet")
        .option("path", f"{place}/rows")
        .option("checkpointLocation", f"{place}/checkpoint")
    )


@query
def stream_capped_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which batch of a capped stream brought each record.
    stream = read_stream(
        spark,
        ef.stored(spark, sf_dir).feed_path,
        ef.STREAM,
        startingPosition="TRIM_HORIZON",
        includeShardId="true",
        **{"executor.maxRecordPerRead": str(STREAM_PAGE), "executor.maxFetchRecordsPerShard": str(STREAM_CAP)},
    )
    place = scratch_path(spark, "capped")

    def keep(batch: DataFrame, n: int) -> None:
        batch.select("shardId", "sequenceNumber").write.mode("overwrite").parquet(f"{place}/rows/batch={n}")

    drain(lambda: stream.writeStream.option("checkpointLocation", f"{place}/checkpoint").foreachBatch(keep))
    return spark.read.schema("shardId string, sequenceNumber string, batch bigint").parquet(f"{place}/rows")


@query
def shard_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_ranges(ef.stored(spark, sf_dir).feed).select(
        "shardId", "startSeq", "headSeq", "records"
    )


@query
def shard_ranges_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, ef.stored(spark, sf_dir).feed_path)
    return stored_ranges(pages).select("shardId", "startSeq", "headSeq", "records")


@query
def shard_read_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = "501".rjust(21, "0")
    rows = positions.read_from(ef.stored(spark, sf_dir).feed, AFTER_SEQUENCE_NUMBER, start)
    return _keys(rows.sortWithinPartitions("shardId", norm_seq("sequenceNumber")))


@query
def shard_catalogue_(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = shard_ranges(ef.feed(spark, sf_dir))
    last_day = ranges.select(F.max(ef.shard_day())).scalar()
    listed = shard_catalogue(ranges, ef.lineage_of(ranges, last_day))
    return listed.drop("streamName")


@query
def many_streams_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Several streams in one table; the orders' shards bear ids of the events' kind.
    both = ef.feed(spark, sf_dir).unionByName(ef.orders_feed(spark, sf_dir))
    return shard_ranges(both)


# Projections and decoding


@query
def envelope_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ef.feed(spark, sf_dir).select(
        payload_text("data").alias("data"),
        "streamName",
        "partitionKey",
        "sequenceNumber",
        _arrived(),
    )


@query
def arrival_timestamp_(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = ef.events(spark, sf_dir).select(
        "event_id", F.unix_millis(ef.arrival()).alias("arrival_ms")
    )
    return millis.select(
        "event_id",
        "arrival_ms",
        arrival_timestamp("arrival_ms").cast("timestamp_ntz").alias("arrived"),
    )


@query
def payload_text_(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ef.stored(spark, sf_dir).feed
    return rows.select("sequenceNumber", payload_text("data").alias("payload"))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_event(ef.stored(spark, sf_dir).feed, ef.EVENT)


@query
def decode_event_(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = "event.change."
    return _decoded(spark, sf_dir).select(
        F.col("event.awsRegion").alias("aws_region"),
        F.col("event.eventID").alias("event_id"),
        F.col("event.eventName").alias("event_name"),
        F.col("event.eventSource").alias("event_source"),
        F.col("event.eventVersion").alias("event_version"),
        F.col(change + "ApproximateCreationDateTime").alias("created"),
        F.col(change + "Keys.id.N").alias("key_id"),
        F.col(change + "SequenceNumber").alias("sequence_number"),
        F.col(change + "SizeBytes").alias("size_bytes"),
        F.col(change + "StreamViewType").alias("view_type"),
    )


@query
def new_image_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select("sequenceNumber", new_image("n", "S").alias("n"))


@query
def typed_attribute_(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No event type is a number, so the text attribute read as one is null.
    return _decoded(spark, sf_dir).select(
        typed_attribute("id", "N", "bigint").alias("id"),
        typed_attribute("value", "N", "double").alias("value"),
        typed_attribute("k", "N", "bigint").alias("k"),
        typed_attribute("n", "S", "bigint").isNotNull().alias("n_is_number"),
    )


@query
def arrival_epoch_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ef.feed(spark, sf_dir).select(
        "sequenceNumber", arrival_epoch("approximateArrivalTimestamp").alias("arrival_epoch")
    )


@query
def unpack_records_(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unpack_records(ef.packed(ef.stored(spark, sf_dir).feed))
    return rows.select(
        "shardId", "sequenceNumber", "subSequence", payload_text("data").alias("payload")
    )


# Positions


@query
def position_trim_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(positions.read_from(ef.stored(spark, sf_dir).feed, TRIM_HORIZON))


@query
def position_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    heads = ef.morning_heads(s.feed)
    waiting = heads.select(
        *SHARD_KEY, F.lit(LATEST).alias("iteratorType"), F.lit("").alias("iteratorPosition")
    )
    pinned = materialise(positions.pin_latest(waiting, heads), "pinned")
    return _keys(positions.apply_positions(s.feed, pinned))


@query
def position_at_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    noon_of_day_15 = 1_705_320_000_000
    return _keys(
        positions.read_from(ef.stored(spark, sf_dir).feed, AT_TIMESTAMP, str(noon_of_day_15))
    )


@query
def position_after_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(
        positions.read_from(ef.stored(spark, sf_dir).feed, AFTER_SEQUENCE_NUMBER, "251")
    )


@query
def position_at_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(positions.read_from(ef.stored(spark, sf_dir).feed, AT_SEQUENCE_NUMBER, "251"))


@query
def position_shard_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.live_positions(ef.stored(spark, sf_dir).positions).select(*POSITION_COLUMNS)


@query
def parse_starting_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = (
        F.when(F.col("event_type") == "click", F.lit(" latest "))
        .when(F.col("event_type") == "view", F.lit("LATEST"))
        .when(F.col("event_type") == "error", F.lit("Trim_Horizon\t"))
        .when(F.col("event_type") == "purchase", F.lit("TRIM_HORIZON"))
    )
    return ef.events(spark, sf_dir).select(
        "event_id", positions.parse_starting_position(asked).alias("iterator_type")
    )


@query
def apply_positions_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    return _keys(stored_from(spark, s.feed_path, s.positions))


@query
def apply_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    return _keys(positions.apply_positions(s.feed, s.positions))


# Limits


@query
def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ef.stored(spark, sf_dir).feed.select(*SHARD_KEY, "sequenceNumber")
    return limits.page_numbers(rows, PAGE).select("shardId", "sequenceNumber", "pageNumber")


@query
def page_numbers_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_ordinal(spark, ef.stored(spark, sf_dir).feed_path)
    page = limits.page_of("ordinal", PAGE).alias("pageNumber")
    return rows.select("shardId", "sequenceNumber", page)


@query
def cap_per_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(limits.cap_per_shard(ef.stored(spark, sf_dir).feed, PAGE, CAP))


@query
def cap_per_shard_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(limits.cap_per_shard(ef.stored(spark, sf_dir).feed))


@query
def cap_per_shard_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Few shards, each over a limit of many pages.
    bucket = F.col("sequenceNumber").cast("bigint") % FEW_SHARDS
    rows = ef.feed(spark, sf_dir).withColumn("shardId", bucket.cast("string"))
    return _keys(limits.cap_per_shard(rows, LARGE_PAGE, LARGE_CAP))


@query
def cap_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The cap counts the parts of packed records, not the packs.
    parts = unpack_records(ef.packed(ef.stored(spark, sf_dir).feed))
    return limits.cap_per_shard(parts, PAGE, CAP).select("shardId", "sequenceNumber", "subSequence")


@query
def mixed_length_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Numbers of up to 52 digits: order and position turn on their lengths.
    return _keys(positions.read_from(ef.mixed_lengths(spark, sf_dir), AFTER_SEQUENCE_NUMBER, ef.MIXED_START))


@query
def mixed_length_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mixed")
    append_feed(ef.mixed_lengths(spark, sf_dir), path)
    return stored_ranges(read_pages(spark, path)).select("shardId", "startSeq", "headSeq", "records")


@query
def batch_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    return _keys(limits.batch_slice(s.feed, s.positions, PAGE, CAP))


@query
def batch_slice_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    return _keys(stored_slice(spark, s.feed_path, s.positions, PAGE, CAP))


# Progress


@query
def next_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    read = limits.batch_slice(s.feed, s.positions, PAGE, CAP)
    return progress.next_positions(read, s.positions, s.catalogue).select(*POSITION_COLUMNS)


@query
def next_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every event type is a stream with shards, every order priority one without.
    rows = ef.events(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    log = rows.select(
        F.col("event_type").alias("streamName"), F.dayofmonth("ts").alias("batch_id")
    ).unionByName(
        orders.select(
            F.col("o_orderpriority").alias("streamName"),
            (F.year("o_orderdate") - 1990).alias("batch_id"),
        )
    )
    shards = rows.select(F.col("event_type").alias("streamName"))
    return progress.next_batch_ids(log, log, shards).select(
        F.col("streamName").alias("stream_name"),
        F.col("batchId").alias("batch_id"),
        F.col("isNew").alias("is_new"),
    )


def _by_batch(s: ef.Stored) -> DataFrame:
    return s.log.withColumnRenamed("batch_id", "batchId")


@query
def offset_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.offset_encode(_by_batch(ef.stored(spark, sf_dir))).select(
        F.col("batchId").alias("batch_id"), "offset"
    )


@query
def many_streams_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = ef.feed(spark, sf_dir).unionByName(ef.orders_feed(spark, sf_dir))
    heads = shard_ranges(both).select(
        *SHARD_KEY,
        F.lit(AFTER_SEQUENCE_NUMBER).alias("iteratorType"),
        F.col("headSeq").alias("iteratorPosition"),
        F.lit(7).alias("batchId"),
    )
    return progress.offset_encode(heads).select("streamName", "offset")


@query
def offset_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = progress.offset_encode(_by_batch(ef.stored(spark, sf_dir)), parts=3)
    return progress.offset_decode(documents).withColumnRenamed("batchId", "batch_id").select(
        "streamName", *LOG_COLUMNS
    )


@query
def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The offsets of a stream's own checkpoint, decoded.
    feed_path = ef.stored(spark, sf_dir).feed_path
    stream = read_stream(spark, feed_path, ef.STREAM, startingPosition="TRIM_HORIZON")
    place = scratch_path(spark, "offsets")
    drain(lambda: _to_files(stream, place))
    lines = spark.read.text(f"{place}/checkpoint/offsets").filter(F.col("value").contains(f'"{progress.METADATA}"'))
    return progress.offset_decode(lines, "value").withColumnRenamed("batchId", "batch_id").select(
        "streamName", *LOG_COLUMNS
    )


@query
def previous_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ef.stored(spark, sf_dir).log
    return progress.previous_positions(log, 15).select(*POSITION_COLUMNS)


@query
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two runs of one query, the second after half of the feed was appended.
    rows = ef.feed(spark, sf_dir)
    number = F.col("sequenceNumber").cast("double")
    middle = rows.select(F.max(number)).scalar()
    half = number * 2 <= middle
    place = scratch_path(spark, "resume")
    for part in (rows.filter(half), rows.filter(~half)):
        append_feed(part, f"{place}/feed")
        stream = read_stream(
            spark, f"{place}/feed", ef.STREAM, startingPosition="trim_horizon"
        )
        drain(lambda: _to_files(stream, place))
    return (
        spark.read.schema(ENVELOPE)
        .parquet(f"{place}/rows")
        .groupBy("sequenceNumber")
        .agg(F.count(F.lit(1)).alias("times"))
    )


@query
def stream_position_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream from the latest records on: a first batch without records pins all
    # shards, and those of odd buckets, idle after it, stay after their heads.
    s = ef.stored(spark, sf_dir)
    place = scratch_path(spark, "logged")
    rows = ef.feed(spark, sf_dir)
    late = (F.hour("approximateArrivalTimestamp") >= 12) & (ef.shard_bucket() % 2 == 0)
    later = (F.hour("approximateArrivalTimestamp") >= 18) & late
    write_catalogue(s.catalogue, f"{place}/feed")

    def run() -> None:
        # One folder per batch, so that a replayed batch replaces itself.
        stream = read_stream(spark, f"{place}/feed", ef.STREAM, includeShardId="true")
        writer = write_with_log(
            stream,
            lambda batch, n: batch.write.mode("overwrite").parquet(f"{place}/rows/batch={n}"),
            f"{place}/feed",
            f"{place}/log",
            ef.STREAM,
            f"{place}/checkpoint",
        )
        writer.trigger(availableNow=True).start().awaitTermination()

    for part in (rows.filter(~late), rows.filter(late & ~later), rows.filter(later)):
        append_feed(part, f"{place}/feed")
        run()
    return position_log.log_read(spark, f"{place}/log").select(*LOG_COLUMNS)


# Lineage


@query
def open_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.open_shards(ef.stored(spark, sf_dir).catalogue).select("shardId", "startSeq")


@query
def closed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.closed_shards(ef.stored(spark, sf_dir).catalogue).select(
        "shardId", "startSeq", "endSeq"
    )


@query
def shard_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.shard_parents(ef.stored(spark, sf_dir).catalogue).select("shardId", "parentId")


@query
def shard_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    children = lineage.shard_children(ef.stored(spark, sf_dir).catalogue)
    return children.select("parentId", F.array_join("children", ",").alias("children"))


@query
def open_parent_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ef.stored(spark, sf_dir)
    rows, ranges = s.feed, s.ranges
    last_day = ranges.select(F.max(ef.shard_day())).scalar()
    raced = ef.raced_catalogue(ranges, ef.lineage_of(ranges, last_day), rows)
    return lineage.open_parent_violations(raced).select("shardId")


@query
def shard_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ancestors of open shards that a batch before has not seen.
    catalogue = ef.stored(spark, sf_dir).catalogue
    opened = lineage.open_shards(catalogue).select(*SHARD_KEY)
    seen = ef.earlier_positions(catalogue).select(*SHARD_KEY)
    found = lineage.shard_ancestors(opened, catalogue)
    return found.select("shardId", F.lit(True).alias("listed")).join(
        seen.select("shardId", F.lit(True).alias("seen")), "shardId", "left"
    ).select("shardId", F.coalesce("seen", F.lit(False)).alias("seen"))


@query
def latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = ef.stored(spark, sf_dir).catalogue
    return lineage.latest_positions(
        catalogue, ef.earlier_positions(catalogue), TRIM_HORIZON
    ).select(*POSITION_COLUMNS)


# Position log


@query
def position_log_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = ef.stored(spark, sf_dir).ranges
    place = scratch_path(spark, "added")
    ef.write_log(ranges, place)
    return position_log.log_read(spark, place).select(*LOG_COLUMNS)


@query
def position_log_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = ef.stored(spark, sf_dir).log_path
    return position_log.log_get(spark, place, 15).select(*LOG_COLUMNS)


@query
def position_log_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_path(spark, "purged")
    ef.write_log(ef.stored(spark, sf_dir).ranges, place)
    position_log.log_purge(spark, place, 10)
    return position_log.log_read(spark, place).select(*LOG_COLUMNS)


@query
def position_log_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_path(spark, "kept")
    ef.write_log(ef.stored(spark, sf_dir).ranges, place)
    current = position_log.log_batch_ids(spark, place)[-1]
    position_log.log_retain(spark, place, current, 12)
    return position_log.log_read(spark, place).select(*LOG_COLUMNS)


@query
def position_log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A folder with batches of the log and others beside them.
    place = scratch_path(spark, "names")
    ef.write_log(ef.stored(spark, sf_dir).ranges, place)
    names = ef.events(spark, sf_dir).select(F.concat(F.lit("tmp-"), "event_type").alias("batch_id"), "event_id")
    names.write.mode("append").partitionBy("batch_id").parquet(f"{place}/{position_log.LOG_DIR}")
    found = position_log.log_batch_ids(spark, place)
    return spark.createDataFrame([(n,) for n in found], "batch_id bigint")
