"""A feed as a Parquet table, laid out for reading shards from a position.

``<path>/data``    the records, range-clustered by shard and sequence number, so
                   file statistics prune reads and a hot shard fills many files;
                   a partition per append and part, with one file each
``<path>/pages``   per append and file: the pages (runs of records) of each shard
``<path>/shards``  the shard catalogue, a new version per write (optional)

An append counts once its page listing is complete. The listing answers what a
shard holds, and what part of the feed a batch needs, without reading records.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from changefeed import storage
from changefeed.functions.sequence import norm_seq
from changefeed.operators.limits import batch_limit, cut_large
from changefeed.operators.positions import checked_kind, reached
from changefeed.schema import (
    AFTER_SEQUENCE_NUMBER,
    AT_SEQUENCE_NUMBER,
    AT_TIMESTAMP,
    CATALOGUE,
    DEFAULT_CAP,
    DEFAULT_PAGE,
    ENVELOPE,
    LATEST,
    SHARD_END,
    SHARD_KEY,
)

_TIMESTAMP_TYPE = "spark.sql.parquet.outputTimestampType"
# A row group is what a read of some records of a shard decodes; small ones keep that small.
_ROW_GROUP_BYTES = 1 << 20
_FILE_BYTES = 128 << 20
# What one task sorts about as fast as several tasks agree on where to cut.
_SMALL_BYTES = 16 << 20
_MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"

# Partition columns: which append a row came with, and in which of its files.
_APPEND = T.StructField("append", T.StringType())
_PART = T.StructField("part", T.IntegerType())

_FEED = T.StructType(
    [
        *ENVELOPE.fields,
        T.StructField("shardId", T.StringType()),
        T.StructField("seqKey", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("streamName", T.StringType()),
        T.StructField("shardId", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("firstKey", T.StringType()),
        T.StructField("lastKey", T.StringType()),
        T.StructField("firstSeq", T.StringType()),
        T.StructField("lastSeq", T.StringType()),
        T.StructField("firstArrival", T.TimestampType()),
        T.StructField("lastArrival", T.TimestampType()),
        T.StructField("firstRow", T.LongType()),
        T.StructField("records", T.LongType()),
    ]
)

# The catalogue as stored: shards that are gone stay, marked as not listed.
_LISTING = T.StructType([*CATALOGUE.fields, T.StructField("listed", T.BooleanType())])


def _ticket() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _size() -> Column:
    """Bytes of a record's text and payload, and some for what a row takes besides."""
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in (*ENVELOPE.names[:4], "shardId")]
    return sum(sizes, F.lit(64)).cast("bigint")


def _bytes(feed: DataFrame) -> int:
    return feed.select(F.sum(_size())).first()[0] or 0


def measure(feed: DataFrame) -> list[Row]:
    """Of each shard in a batch the first and the last key, and the bytes of its records; see ``_ends``."""
    ends = F.struct(norm_seq("sequenceNumber").alias("firstKey"), F.col("sequenceNumber").alias("firstSeq"))
    return (
        feed.select(*SHARD_KEY, ends.alias("_ends"), _size().alias("_bytes"))
        .groupBy(*SHARD_KEY)
        .agg(F.min("_ends").alias("_first"), F.max("_ends.firstKey").alias("_last"), F.sum("_bytes").alias("_bytes"))
        .collect()
    )


class Heads:
    """The highest key of each shard in the appends that one writer has seen.

    Only listings that it has not seen are read for the next append, so that
    many appends in a row do not read all listings before them each time. The
    driver holds a key per shard, as it does for the offset of a stream.
    """

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.last: dict[tuple[str, str], str] = {}

    def unseen(self, spark: SparkSession, path: str) -> list[str]:
        """Complete listings that the writer has not taken in yet."""
        if not self.seen:
            return complete(spark, path, "pages")
        names = set(storage.child_names(spark, f"{path}/pages"))
        if not self.seen <= names:
            self.seen, self.last = set(), {}
        return [n for n in sorted(names - self.seen) if storage.exists(spark, f"{path}/pages/{n}/_SUCCESS")]

    def take(self, pages: DataFrame, names: list[str]) -> None:
        """Take in some listings."""
        self.add(names, {_shard(r): r["_before"] for r in _heads(pages).collect()} if names else {})

    def add(self, names: list[str], last: dict[tuple[str, str], str]) -> None:
        for shard, key in last.items():
            if key is not None:
                self.last[shard] = max(key, self.last.get(shard, key))
        self.seen.update(names)

    def require_later(self, ends: list[Row]) -> dict[tuple[str, str], str]:
        """The last keys of an append; it fails if a shard has records as late as that."""
        last = {}
        for row in ends:
            first, before = row["_first"], self.last.get(_shard(row))
            if None not in (*_shard(row), before, first["firstKey"]) and first["firstKey"] <= before:
                raise _late(row["shardId"], before, first["firstSeq"])
            last[_shard(row)] = row["_last"]
        return last


def _shard(row: Row) -> tuple[str, str]:
    return row["streamName"], row["shardId"]


def _heads(pages: DataFrame) -> DataFrame:
    return pages.groupBy(*SHARD_KEY).agg(F.max("lastKey").alias("_before"))


def _ends(pages: DataFrame) -> DataFrame:
    return pages.groupBy(*SHARD_KEY).agg(
        F.min(F.struct("firstKey", "firstSeq")).alias("_first"),
        F.max("lastKey").alias("_last"),
    )


def _late(shard: str, before: str, first: str) -> ValueError:
    return ValueError(
        f"shard {shard} already has records up to {before}; an append from {first} would be out of sequence"
    )


def _require_later(pages: DataFrame, before: DataFrame) -> None:
    """Fails if a shard of an append has records as late as it in the listings before."""
    behind = F.col("_first.firstKey") <= F.col("_before")
    for row in _ends(pages).join(_heads(before), SHARD_KEY).filter(behind).head(1):
        raise _late(row["shardId"], row["_before"], row["_first"]["firstSeq"])


def append_feed(
    feed: DataFrame,
    path: str,
    page: int = DEFAULT_CAP,
    files: int | None = None,
    once: str | None = None,
    heads: Heads | None = None,
    measured: list[Row] | None = None,
    session: SparkSession | None = None,
) -> None:
    """Append records (envelope plus ``shardId``) to a stored feed.

    ``page`` is the most records one listed page has, the grain of a capped
    stream. Within a shard, later appends hold later sequence numbers; an append
    that does not is refused and removed. ``files`` is how many to write, and more if
    they would hold over 128 MB of records each, as a task sorts one file; by default
    at most as many as shuffle partitions, so have these follow the data. ``once`` names
    the append: if one of that name is complete, nothing is written. A writer of many
    appends hands its ``heads`` to each, and what it ``measured`` of the records: a small
    append is then one file, without a look at its records for where to cut. ``session``
    reads what was written, by default that of the feed.
    """
    spark = session or feed.sparkSession
    path = path.rstrip("/")
    ticket = _ticket()
    listed = complete(spark, path, "pages") if heads is None else heads.unseen(spark, path)
    if once is not None:
        if not re.fullmatch(r"[A-Za-z0-9_.]+", once):
            raise ValueError(f"an append is named by letters, digits, dots and underscores, not {once!r}")
        if any(name.endswith(f"-{once}") for name in (*listed, *(heads.seen if heads else ()))):
            return
        ticket = f"{ticket}-{once}"
    name = f"append={ticket}"
    data, listing = f"{path}/data/{name}", f"{path}/pages/{name}"
    size = None if measured is None else sum(row["_bytes"] for row in measured)
    if files:
        files = max(files, -(-(_bytes(feed) if size is None else size) // _FILE_BYTES))
    elif size is not None and size <= _SMALL_BYTES:
        files = 1
    before = _read(spark, path, "pages", PAGES, listed) if heads is not None or listed else None
    if heads is not None:
        heads.take(before, listed)
    last = heads.require_later(measured) if heads is not None and measured is not None else None
    laid_out = (
        feed.select(*ENVELOPE.names, "shardId", norm_seq("sequenceNumber").alias("seqKey"))
        .repartitionByRange(*([files] if files else []), *SHARD_KEY, "seqKey")
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions("part", *SHARD_KEY, "seqKey")
    )
    # Unlike the default type, this one has statistics that a filter on time can use.
    with storage.session_conf(feed.sparkSession, _TIMESTAMP_TYPE, "TIMESTAMP_MICROS"):
        laid_out.write.partitionBy("part").option("parquet.block.size", str(_ROW_GROUP_BYTES)).parquet(data)
    # The listing counts from its mark on, which it gets once it was checked.
    pages = _list_pages(spark, data, ticket, page, files == 1)
    pages.write.options(**{_MARKS: "false", "parquet.block.size": str(_ROW_GROUP_BYTES)}).parquet(listing)
    if before is not None and last is None:
        pages = spark.read.schema(PAGES).parquet(listing)
        try:
            if heads is None:
                _require_later(pages, before)
            else:
                last = heads.require_later(_ends(pages).collect())
        except ValueError:
            storage.delete_dir(spark, listing)
            storage.delete_dir(spark, data)
            raise
    storage.touch(spark, f"{listing}/_SUCCESS")
    if heads is not None:
        heads.add([name], last)


def _list_pages(spark: SparkSession, data: str, ticket: str, page: int, single: bool = False) -> DataFrame:
    # A file is sorted, so a page of a shard is what it has of so many rows of the
    # file, and its ends are at its lowest and highest row: one scan, no join, and
    # no shuffle of a single file.
    row = F.col("_row")
    ends = F.struct("seqKey", "sequenceNumber")
    rows = spark.read.schema(T.StructType([*_FEED.fields, _PART])).parquet(data)
    pages = (
        (rows.coalesce(1) if single else rows)
        .select(
            *SHARD_KEY,
            "part",
            "sequenceNumber",
            "seqKey",
            "approximateArrivalTimestamp",
            F.concat(
                F.lit(f"append={ticket}/part="), F.col("part"), F.lit("/"), F.col("_metadata.file_name")
            ).alias("file"),
            F.col("_metadata.row_index").alias("_row"),
        )
        .groupBy(*SHARD_KEY, "part", "file", F.floor(row / page))
        .agg(
            F.min_by(ends, row).alias("_first"),
            F.max_by(ends, row).alias("_last"),
            F.min("approximateArrivalTimestamp").alias("firstArrival"),
            F.max("approximateArrivalTimestamp").alias("lastArrival"),
            F.min(row).alias("firstRow"),
            F.count(F.lit(1)).alias("records"),
        )
        .select(
            *SHARD_KEY,
            "file",
            "part",
            F.col("_first.seqKey").alias("firstKey"),
            F.col("_last.seqKey").alias("lastKey"),
            F.col("_first.sequenceNumber").alias("firstSeq"),
            F.col("_last.sequenceNumber").alias("lastSeq"),
            "firstArrival",
            "lastArrival",
            "firstRow",
            "records",
        )
    )
    # In order, so that who plans from a listing finds the pages of a shard in few row groups.
    order = [*SHARD_KEY, "firstKey"]
    return (pages if single else pages.repartitionByRange(*order)).sortWithinPartitions(*order)


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """Store a shard listing; the newest one counts.

    Shards of the listing before that are not in this one are kept as gone, which
    tells them from shards that no listing has had yet.
    """
    path = path.rstrip("/")
    listing = catalogue.select(*CATALOGUE.names, F.lit(True).alias("listed"))
    before = _listing(catalogue.sparkSession, path)
    if before is not None:
        gone = before.join(catalogue.select(*SHARD_KEY), SHARD_KEY, "left_anti")
        listing = listing.unionByName(gone.withColumn("listed", F.lit(False)))
    listing.write.parquet(f"{path}/shards/version={_ticket()}")


def _listing(spark: SparkSession, path: str) -> DataFrame | None:
    versions = complete(spark, path, "shards")
    if not versions:
        return None
    return spark.read.schema(_LISTING).parquet(f"{path.rstrip('/')}/shards/{versions[-1]}")


def complete(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Names of the complete subdirectories, oldest first."""
    marks = storage.matching(spark, f"{path.rstrip('/')}/{kind}/*/_SUCCESS")
    return sorted(mark.split("/")[-2] for mark in marks)


def _read(
    spark: SparkSession, path: str, kind: str, schema: T.StructType, appends: list[str] | None = None
) -> DataFrame:
    root = f"{path.rstrip('/')}/{kind}"
    schema = T.StructType([*schema.fields, _APPEND])
    appends = complete(spark, path, "pages") if appends is None else appends
    if not appends:
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("basePath", root)
        .parquet(*[f"{root}/{name}" for name in appends])
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The stored records: envelope, ``shardId``, ``seqKey`` (see ``norm_seq``), ``append``, ``part``."""
    return _read(spark, path, "data", T.StructType([*_FEED.fields, _PART]))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page listing, one row per run of records of a shard."""
    return _read(spark, path, "pages", PAGES)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest stored shard listing, if there is one."""
    listing = _listing(spark, path)
    return None if listing is None else listing.filter("listed").select(*CATALOGUE.names)


def stored_ranges(pages: DataFrame) -> DataFrame:
    """What ``shard_ranges`` gives for the feed, from its page listing alone."""
    return pages.groupBy(*SHARD_KEY).agg(
        F.min_by("firstSeq", "firstKey").alias("startSeq"),
        F.max_by("lastSeq", "lastKey").alias("headSeq"),
        F.sum("records").alias("records"),
    )


def stored_ordinal(spark: SparkSession, path: str, into: str = "ordinal") -> DataFrame:
    """The stored records, those of each shard numbered from 1 in sequence order.

    Nothing is sorted or shuffled by record: a record's row number in its file and
    the number of the shard's records in earlier files add up to its place.
    """
    key = ["file", *SHARD_KEY]
    earlier = (
        Window.partitionBy(*SHARD_KEY).orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = storage.materialise(
        read_pages(spark, path)
        .groupBy(*key)
        .agg(
            F.min("firstKey").alias("_key"),
            F.min("firstRow").alias("_first"),
            F.sum("records").alias("_n"),
        )
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1 - F.col("_first"))
        .select(*key, "_shift"),
        "runs",
    )
    feed = read_feed(spark, path)
    file = F.concat(
        F.lit("append="), F.col("append"), F.lit("/part="), F.col("part"), F.lit("/"), F.col("_metadata.file_name")
    )
    return (
        feed.select(*feed.columns, file.alias("file"), F.col("_metadata.row_index").alias("_row"))
        .join(runs, key)
        .select(*feed.columns, (F.col("_row") + F.col("_shift")).alias(into))
    )


def _needed(pages: DataFrame, positions: DataFrame, limit: int | None) -> DataFrame:
    """The pages that a read from the positions can need, with these.

    A page wholly behind its shard's position drops out. So does, if there is a
    limit, one with so many records between the position and its start; only
    pages wholly past the position count there. The windows run over page
    listings, not over records.
    """
    kind, place = F.col("iteratorType"), F.col("iteratorPosition")
    at, start = norm_seq(place), F.timestamp_millis(place.try_cast("bigint"))

    def past(key: str, arrival: str) -> Column:
        return (
            F.when(kind == AFTER_SEQUENCE_NUMBER, F.col(key) > at)
            .when(kind == AT_SEQUENCE_NUMBER, F.col(key) >= at)
            .when(kind == AT_TIMESTAMP, F.col(arrival) >= start)
            .otherwise(F.lit(True))
        )

    shard = Window.partitionBy(*SHARD_KEY)
    earlier = shard.orderBy("firstKey").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.when(past("firstKey", "firstArrival"), F.col("records")).otherwise(0)
    needed = (
        pages.join(positions.filter(~checked_kind(kind, place).isin(SHARD_END, LATEST)), SHARD_KEY)
        .filter(past("lastKey", "lastArrival"))
        .withColumn("_before", F.coalesce(F.sum(whole).over(earlier), F.lit(0)))
    )
    if limit is not None:
        needed = needed.filter(F.col("_before") < limit)
    return needed.select(
        "append",
        "part",
        *SHARD_KEY,
        "lastKey",
        kind.alias("_kind"),
        place.alias("_from"),
        F.sum("records").over(shard).alias("_most"),
    )


def _rows_in(spark: SparkSession, path: str, needed: DataFrame) -> DataFrame:
    """Records past their shard's position in the needed pages, of the files that hold these."""
    feed = read_feed(spark, path)
    runs = needed.groupBy("append", "part", *SHARD_KEY, "_kind", "_from").agg(
        F.max("lastKey").alias("_upto")
    )
    past = reached(
        F.col("_kind"),
        F.col("_from"),
        F.col("sequenceNumber"),
        F.col("approximateArrivalTimestamp"),
    )
    # A comparison, unlike "is not null", lets Spark prune partitions by this side.
    return (
        feed.join(runs.filter(F.col("_upto") > ""), ["append", "part", *SHARD_KEY])
        .filter(past & (F.col("seqKey") <= F.col("_upto")))
        .select(*feed.columns)
    )


def stored_from(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """The same rows as ``apply_positions`` over the stored feed, without files behind the positions."""
    pages = _needed(read_pages(spark, path), positions, None)
    return _rows_in(spark, path, storage.materialise(pages, "needed"))


def stored_slice(
    spark: SparkSession,
    path: str,
    positions: DataFrame,
    page: int = DEFAULT_PAGE,
    cap: int = DEFAULT_CAP,
) -> DataFrame:
    """The same rows as ``batch_slice`` over the stored feed, reading far less of it.

    The page listing tells which files and which part of each shard the batch can
    need, and which shards cannot go over the limit; only the others are cut, by
    their keys. Files are pruned by the join with the listing, at any number.
    """
    limit = batch_limit(page, cap)
    needed = storage.materialise(_needed(read_pages(spark, path), positions, limit), "needed")
    rows = _rows_in(spark, path, needed)
    large, shards = storage.materialise_counted(
        needed.filter(F.col("_most") > limit).select(*SHARD_KEY).distinct(), "large"
    )
    return cut_large(rows, large, limit) if shards else rows
