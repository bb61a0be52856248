"""``spark.read.format("changefeed")``: a stored feed as a batch DataFrame.

Which shards, sequence numbers and arrival times are wanted is said by options, and
answered from the page listing first, so that only files with pages that can hold
such records are opened. They are options and not pushed filters, because Spark
4.1 keeps what one scan pushed to a Python source for the other scans of the same
DataFrame, which then miss rows. Filters on the result are Spark's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSourceReader, InputPartition

from changefeed.functions.sequence import sequence_key
from changefeed.sources.options import FeedOptions, Wanted

PAGE_COLUMNS = ["shardId", "file", "firstKey", "lastKey", "firstArrival", "lastArrival", "firstRow", "records"]


class FilePart(InputPartition):
    """One file, the shards wanted of it, and the runs of rows that their pages are."""

    def __init__(self, file: str, shards: list[str], runs: list[tuple[int, int]]):
        self.file = file
        self.shards = shards
        self.runs = runs


def _instant(text: str) -> datetime:
    at = datetime.fromisoformat(text)
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


class Bounds:
    """What is wanted, as bounds of keys and times that pages and records compare with."""

    def __init__(self, wanted: Wanted):
        self.shards = wanted.shards
        self.keys = [s if s is None else sequence_key(s) for s in (wanted.from_sequence, wanted.to_sequence)]
        self.times = [t if t is None else _instant(t) for t in (wanted.from_time, wanted.to_time)]

    def pages(self, pages: pd.DataFrame) -> pd.DataFrame:
        """The pages that can hold a wanted record."""
        for column in ("firstArrival", "lastArrival"):
            pages[column] = pd.to_datetime(pages[column], utc=True)
        kept = pd.Series(True, pages.index)
        if self.shards is not None:
            kept &= pages["shardId"].isin(self.shards)
        (low, high), (start, end) = self.keys, self.times
        if low is not None:
            kept &= pages["lastKey"] >= low
        if high is not None:
            kept &= pages["firstKey"] <= high
        if start is not None:
            kept &= pages["lastArrival"] >= start
        if end is not None:
            kept &= pages["firstArrival"] < end
        return pages[kept]

    def records(self) -> list[pc.Expression]:
        """The same, exactly, on records."""
        key, at = pc.field("seqKey"), pc.field("approximateArrivalTimestamp")
        (low, high), (start, end) = self.keys, self.times
        return [
            *([key >= low] if low is not None else []),
            *([key <= high] if high is not None else []),
            *([at >= pa.scalar(start, pa.timestamp("us", "UTC"))] if start is not None else []),
            *([at < pa.scalar(end, pa.timestamp("us", "UTC"))] if end is not None else []),
        ]


class ChangeFeedScan(DataSourceReader):
    """Plans a read of the stored records of a stream from its page listing.

    ``startingPosition`` and the limits of batches do not matter here.
    """

    def __init__(self, options: FeedOptions, schema: pa.Schema):
        self._options = options
        self._schema = schema

    def partitions(self) -> list[FilePart]:
        from changefeed.sources.stream import listed_pages, merged

        pages = Bounds(self._options.wanted).pages(listed_pages(self._options, PAGE_COLUMNS))
        pages["end"] = pages["firstRow"] + pages["records"]
        return [
            FilePart(file, sorted(of["shardId"].unique()), merged(list(zip(of["firstRow"].tolist(), of["end"].tolist()))))
            for file, of in pages.groupby("file", sort=True, observed=True)
        ]

    def read(self, partition: FilePart | None) -> Iterator[pa.RecordBatch]:
        from changefeed.sources.stream import open_path, stored_rows

        if partition is None:
            return
        fs, root = open_path(f"{self._options.path}/data")
        inside = (pc.field("streamName") == self._options.stream_name) & pc.field("shardId").isin(partition.shards)
        for each in Bounds(self._options.wanted).records():
            inside &= each
        columns = sorted({*self._schema.names, "streamName", "shardId", "seqKey", "approximateArrivalTimestamp"})
        for batch in stored_rows(fs, f"{root}/{partition.file}", columns, partition.runs):
            kept = batch.filter(inside)
            if kept.num_rows:
                yield kept.select(self._schema.names).cast(self._schema)
