"""``spark.readStream.format("changefeed")``: a stored feed as a stream.

Only page listings pass through the driver; records are read by the executors,
file by file, as Arrow batches.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import OrderedDict
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructType

from changefeed.functions.sequence import sequence_key
from changefeed.operators.limits import batch_limit
from changefeed.operators.progress import BATCH_ID, ITERATOR_POSITION, ITERATOR_TYPE, METADATA, STREAM_NAME
from changefeed.schema import (
    AFTER_SEQUENCE_NUMBER,
    ENVELOPE,
    LATEST,
    SHARD_END,
)
from changefeed.sources.options import FeedOptions, parse_options
from changefeed.sources.scan import ChangeFeedScan

FORMAT = "changefeed"
_ARROW_TYPES = {
    "data": pa.binary(),
    "streamName": pa.string(),
    "partitionKey": pa.string(),
    "sequenceNumber": pa.string(),
    "approximateArrivalTimestamp": pa.timestamp("us", "UTC"),
    "shardId": pa.string(),
    "seqKey": pa.string(),
}
_PAGES = pa.schema(
    [
        ("shardId", pa.large_string()),
        ("file", pa.dictionary(pa.int32(), pa.string())),
        ("firstKey", pa.large_string()),
        ("lastKey", pa.large_string()),
        ("lastSeq", pa.large_string()),
        ("firstRow", pa.int64()),
        ("records", pa.int64()),
    ]
)
_ORDER = [("shardId", "ascending"), ("firstKey", "ascending"), ("lastKey", "ascending"), ("firstRow", "ascending")]

# Rows and buffered bytes that a task holds of a file, and what the planner keeps of files.
_READ_ROWS, _READ_BYTES = 4_096, 1 << 20
_KEPT_FILES, _KEPT_BYTES = 64, 64 << 20
# What the planner holds of page listings: pages ahead of all shards, and bytes of row groups.
_NEAR_PAGES, _LISTED_BYTES = 500_000, 32 << 20
# Wanted rows up to which files share a task.
_TASK_ROWS = 1_000

# Where in a file a batch ended that stopped inside a page.
_FILE, _ROW = "file", "row"

# Names of file systems here, by the schemes that Hadoop knows them by.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file"}


def register(spark: SparkSession) -> None:
    """Make the format known to a session; workers need no installed package."""
    import changefeed

    cloudpickle.register_pickle_by_value(changefeed)
    spark.dataSource.register(ChangeFeedSource)


class ChangeFeedSource(DataSource):
    """A stored feed as a stream or as a table, with the fixed envelope schema."""

    def __init__(self, options):
        super().__init__(options)
        self._parsed = parse_options(dict(options))

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        schema = StructType(list(ENVELOPE.fields))
        for name in _columns(self._parsed)[len(ENVELOPE) :]:
            schema = schema.add(name, StringType())
        return schema

    def reader(self, schema: StructType) -> ChangeFeedScan:
        self._check(schema)
        return ChangeFeedScan(self._parsed, _arrow_schema(self._parsed))

    def streamReader(self, schema: StructType) -> "ChangeFeedReader":
        self._check(schema)
        return ChangeFeedReader(self._parsed)

    def _check(self, schema: StructType) -> None:
        if schema != self.schema():
            raise ValueError("a change feed has a fixed schema; do not set another one")


def _columns(options: FeedOptions) -> list[str]:
    more = {"shardId": options.include_shard_id, "seqKey": options.include_sequence_key}
    return [*ENVELOPE.names, *(name for name, wanted in more.items() if wanted)]


def _arrow_schema(options: FeedOptions) -> pa.Schema:
    return pa.schema([(name, _ARROW_TYPES[name]) for name in _columns(options)])


def listed_pages(options: FeedOptions, columns: list[str]) -> pd.DataFrame:
    """All listed pages of a stream."""
    planner = ChangeFeedReader(options)
    parts = [planner._rows(d, columns).to_pandas() for d in planner._new_directories("pages")]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=columns)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of rows (first, behind the last) in order, those that touch as one."""
    found = []
    for first, end in sorted(runs):
        if found and first <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((first, end))
    return found


def stored_rows(
    fs: pafs.FileSystem, path: str, columns: list[str], runs: list[tuple[int, int]]
) -> Iterator[pa.RecordBatch]:
    """Batches of a file that hold the rows of some merged runs.

    Row groups without such rows are not read, and of the others no more than some
    pages of a column and one batch are held, however large files and row groups are.
    """
    starts = [first for first, _ in runs]

    def end_before(first: int, end: int) -> int:
        """Where the last run ends that has rows in this range; ``first`` if there is none."""
        at = bisect_right(starts, end - 1) - 1
        return max(first, min(end, runs[at][1])) if at >= 0 else first

    with fs.open_input_file(path) as file:
        source, first = pq.ParquetFile(file, buffer_size=_READ_BYTES, pre_buffer=False), 0
        for group in range(source.num_row_groups):
            rows = source.metadata.row_group(group).num_rows
            at, end = first, end_before(first, first + rows)
            if at < end:
                for batch in source.iter_batches(_READ_ROWS, [group], columns, use_threads=False):
                    if end_before(at, at + batch.num_rows) > at:
                        yield batch
                    at += batch.num_rows
                    if at >= end:
                        break
            first += rows


class FileRanges(InputPartition):
    """What to read of one file: of each shard, records in (after, upto]; they lie in runs of rows.

    ``more`` are other files of which the same task reads a few rows.
    """

    def __init__(self, file: str, shards: list, after: list, upto: list, runs: list):
        self.file = file
        self.shards = shards
        self.after = after
        self.upto = upto
        self.runs = runs
        self.more: list[FileRanges] = []


def shared_tasks(parts: list[FileRanges]) -> list[FileRanges]:
    """Files with few wanted rows share a task, as starting one takes longer than to read these."""
    found, rows = [], 0
    for part in parts:
        size = sum(end - first for first, end in part.runs)
        if found and rows + size <= _TASK_ROWS:
            found[-1].more.append(part)
            rows += size
        else:
            found.append(part)
            rows = size
    return found


class Stretch:
    """Pages of a shard that are listed together: their ends, and the row groups of listings that have them."""

    __slots__ = ("first_key", "last_key", "last_seq", "groups")

    def __init__(self, first_key: str, last_key: str, last_seq: str, group: int):
        self.first_key, self.last_key, self.last_seq, self.groups = first_key, last_key, last_seq, [group]


class Pages:
    """Some pages in a row of a stretch, from its ``start`` on; ``whole`` is how many it has."""

    def __init__(self, table: pa.Table, start: int, end: int):
        self.start, self.whole = start, len(table)
        # A slice would keep all of the table.
        table = table.take(pa.array(range(start, min(end, len(table))), pa.int64())).combine_chunks()
        column = {name: table[name].combine_chunks() for name in table.column_names}
        self.first_key, self.last_key, self.last_seq = column["firstKey"], column["lastKey"], column["lastSeq"]
        self.first_row, self.records = column["firstRow"].to_numpy(), column["records"].to_numpy()
        self.file = column["file"].to_numpy()
        self.end = start + len(self.file)

    def behind(self, keys: pa.Array, key: str) -> int | None:
        """The first page of the stretch whose key is behind ``key``, if these pages tell."""
        at = bisect_right(range(len(keys)), key, key=lambda i: keys[i].as_py())
        told = (at or not self.start) and (at < len(keys) or self.end == self.whole)
        return self.start + at if told else None


class PageListing:
    """The pages of a stream, of each shard in order of their keys.

    Listings stay in their files. What is held is where the pages of each shard lie there:
    the ends of a stretch of them per shard and row group. Of what a batch needs some pages
    in a row are held for each shard, and the row groups that were read last. Pages without
    a shard are no part of a stream.
    """

    def __init__(self, stream_name: str):
        self._name = stream_name
        self._groups: list = []  # file system, path and number of each row group
        self.files: list[str] = []
        self._file_ids: dict[str, int] = {}
        self.shards: dict[str, list[Stretch]] = {}
        self._near: dict[str, tuple[Stretch, Pages]] = {}
        self._read: OrderedDict = OrderedDict()
        self._held = 0

    def load(self, fs: pafs.FileSystem, directory: str) -> None:
        """Take in the listing of an append."""
        found: dict[str, list[Stretch]] = {}
        listed = fs.get_file_info(pafs.FileSelector(directory, recursive=True))
        for path in sorted(i.path for i in listed if i.is_file and i.path.endswith(".parquet")):
            with fs.open_input_file(path) as file:
                source = pq.ParquetFile(file, read_dictionary=["file"], pre_buffer=False)
                for number in range(source.num_row_groups):
                    group = len(self._groups)
                    self._groups.append((fs, path, number))
                    table, shards = self._sorted(source, number)
                    for shard, (start, end) in shards.items():
                        ends = (table["firstKey"][start], table["lastKey"][end - 1], table["lastSeq"][end - 1])
                        found.setdefault(shard, []).append(Stretch(*(e.as_py() for e in ends), group))
        for shard, more in found.items():
            self.shards[shard] = _apart([*self.shards.get(shard, []), *more])
            self._near.pop(shard, None)

    def _sorted(self, source: pq.ParquetFile, number: int) -> tuple[pa.Table, dict]:
        """The pages of the stream in a row group, in order, and between which rows each shard has its own."""
        pages = source.read_row_group(number, ["streamName", *_PAGES.names])
        pages = pages.filter((pc.field("streamName") == self._name) & pc.is_valid(pc.field("shardId")))
        for key in ("firstKey", "lastKey"):  # a page may begin with records without a number
            pages = pages.set_column(pages.schema.get_field_index(key), key, pc.fill_null(pages[key], ""))
        named = pages["file"].combine_chunks()
        ids = [self._file_ids.setdefault(f, len(self._file_ids)) for f in named.dictionary.to_pylist()]
        self.files += [*self._file_ids][len(self.files) :]
        at = np.array(ids, np.int32)[named.indices.to_numpy()] if len(pages) else np.array([], np.int32)
        pages = pages.set_column(pages.schema.get_field_index("file"), "file", pa.array(at))
        pages = pages.select(_PAGES.names).combine_chunks()
        if not _in_order(pages):
            pages = pages.sort_by(_ORDER).combine_chunks()
        named = pages["shardId"].combine_chunks().dictionary_encode()
        starts = np.flatnonzero(np.diff(named.indices.to_numpy(), prepend=-1)).tolist()
        return pages, dict(zip(named.dictionary.to_pylist(), zip(starts, [*starts[1:], len(pages)])))

    def _group(self, group: int) -> tuple[pa.Table, dict]:
        if group in self._read:
            self._read.move_to_end(group)
            return self._read[group]
        fs, path, number = self._groups[group]
        with fs.open_input_file(path) as file:
            read = self._sorted(pq.ParquetFile(file, read_dictionary=["file"], pre_buffer=False), number)
        self._read[group] = read
        self._held += read[0].nbytes
        while len(self._read) > 1 and self._held > _LISTED_BYTES:
            self._held -= self._read.popitem(last=False)[1][0].nbytes
        return read

    def _pages(self, shard: str, of: Stretch) -> pa.Table:
        parts = [(table, *shards[shard]) for table, shards in map(self._group, of.groups)]
        tables = [table.slice(start, end - start) for table, start, end in parts]
        return tables[0] if len(tables) == 1 else pa.concat_tables(tables).sort_by(_ORDER).combine_chunks()

    def _at(self, shard: str, of: Stretch, page: int) -> Pages:
        """Pages of a stretch with this one among them."""
        held = self._near.get(shard)
        if held is None or held[0] is not of or not held[1].start <= page < held[1].end:
            self._near[shard] = held = of, self._some(self._pages(shard, of), page)
        return held[1]

    def _behind(self, shard: str, column: str, key: str) -> tuple[int, int]:
        """The first page of a shard with a key behind ``key``: its stretch, and its place there."""
        of = self.shards[shard]
        if column == "last_key":
            n = bisect_right(of, key, key=lambda s: s.last_key)
            if n == len(of) or of[n].first_key > key:
                return n, 0
        else:
            n = bisect_right(of, key, key=lambda s: s.first_key) - 1
            if n < 0 or of[n].last_key <= key:
                return n + 1, 0
        held = self._near.get(shard)
        page = held[1].behind(getattr(held[1], column), key) if held and held[0] is of[n] else None
        if page is None:
            table = self._pages(shard, of[n])
            keys = table["lastKey" if column == "last_key" else "firstKey"]
            page = bisect_right(range(len(keys)), key, key=lambda i: keys[i].as_py())
            if page < len(keys):
                self._near[shard] = of[n], self._some(table, page)
        return n, page

    def _some(self, table: pa.Table, page: int) -> Pages:
        """Pages from one on, with the one before, which tells that this is the first behind a key."""
        return Pages(table, max(0, page - 1), page + max(8, _NEAR_PAGES // len(self.shards)))

    def ahead(self, shard: str, key: str, most: int) -> Iterator[tuple[Pages, int, int]]:
        """Pages of a shard behind ``key``, ``most`` of them at most, as runs of held pages."""
        n, page = self._behind(shard, "last_key", key)
        while most > 0 and n < len(self.shards[shard]):
            pages = self._at(shard, self.shards[shard][n], page)
            end = min(pages.end, page + most)
            yield pages, page - pages.start, end - pages.start
            most -= end - page
            n, page = (n, end) if end < pages.whole else (n + 1, 0)

    def between(self, shard: str, after: str, upto: str) -> Iterator[tuple[str, tuple[int, int]]]:
        """Files of a shard's pages with records in (after, upto], and which run of rows these are there."""
        (n, page), last = self._behind(shard, "last_key", after), self._behind(shard, "first_key", upto)
        while (n, page) < last and n < len(self.shards[shard]):
            pages = self._at(shard, self.shards[shard][n], page)
            end = min(pages.end, last[1]) if n == last[0] else pages.end
            first, stop = page - pages.start, end - pages.start
            cuts = [0, *(np.flatnonzero(np.diff(pages.file[first:stop])) + 1).tolist(), stop - first]
            for a, b in zip(cuts, cuts[1:]):
                rows = slice(first + a, first + b)
                behind = pages.first_row[rows] + pages.records[rows]
                yield self.files[pages.file[first + a]], (int(pages.first_row[rows].min()), int(behind.max()))
            n, page = (n, end) if end < pages.whole else (n + 1, 0)

    def head(self, shard: str) -> str:
        """The last key of a shard's pages, empty if none is left."""
        of = self.shards.get(shard)
        return of[-1].last_key if of else ""

    def drop(self, shard: str, key: str) -> None:
        """Forget the stretches of a shard up to ``key``."""
        of = self.shards.get(shard, [])
        done = bisect_right(of, key, key=lambda s: s.last_key)
        if done:
            del of[:done]
            self._near.pop(shard, None)


def _in_order(pages: pa.Table) -> bool:
    """Whether pages certainly are in order: their shards, and in a shard the first keys, without ties."""
    shard, key = pages["shardId"].combine_chunks(), pages["firstKey"].combine_chunks()
    same = pc.equal(shard[1:], shard[:-1])
    later = pc.or_(pc.greater(shard[1:], shard[:-1]), pc.and_(same, pc.greater(key[1:], key[:-1])))
    return pc.all(later, min_count=0).as_py()


def _apart(stretches: list[Stretch]) -> list[Stretch]:
    """Stretches of a shard in order, those that overlap as one."""
    found: list[Stretch] = []
    for each in sorted(stretches, key=lambda s: (s.first_key, s.last_key)):
        if found and each.first_key <= found[-1].last_key:
            one = found[-1]
            one.groups = [*one.groups, *each.groups]
            if each.last_key >= one.last_key:
                one.last_key, one.last_seq = each.last_key, each.last_seq
        else:
            found.append(each)
    return found


def _kept(held: OrderedDict, key, make):
    """What ``held`` has under a key, made if it is not there, as the last that was asked for."""
    if key not in held:
        held[key] = make()
    held.move_to_end(key)
    return held[key]


def _after(seq: str) -> dict:
    return {ITERATOR_TYPE: AFTER_SEQUENCE_NUMBER, ITERATOR_POSITION: seq}


def _key(seq: str) -> str:
    return sequence_key(seq) if seq else ""


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for a plain path or any scheme that both sides know."""
    scheme, found, rest = path.partition(":")
    if not found or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme not in _SCHEMES:
        known = ", ".join(sorted(_SCHEMES))
        raise ValueError(f"a stream reads feeds on {known}; not on {scheme}: {path}")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:{rest}")


def check_offset(offset: dict) -> dict:
    """An offset is a dict of shard id to type and position; anything else fails."""
    fine = isinstance(offset, dict) and all(
        isinstance(at, dict)
        and (shard == METADATA or {ITERATOR_TYPE, ITERATOR_POSITION} <= at.keys())
        for shard, at in offset.items()
    )
    if not fine:
        raise ValueError(f"not an offset of a change feed: {offset!r}")
    return {shard: at for shard, at in offset.items() if shard != METADATA}


class ChangeFeedReader(DataSourceStreamReader):
    """Plans batches from the page listings and reads their files.

    Offsets name the last record of each shard in the batch, so a replayed batch
    holds the same rows. Each call moves every shard one batch ahead at most, to
    the very row where ``batch_slice`` ends.
    """

    def __init__(self, options: FeedOptions):
        self._options = options
        self._loaded: set = set()
        self._pages = PageListing(options.stream_name)
        self._files: OrderedDict = OrderedDict()
        self._columns: OrderedDict = OrderedDict()
        self._held = 0
        self._ends: dict | None = None
        self._gone: set = set()
        self._seen: dict = {}
        self._started: dict | None = None
        self._batch = -1

    # Planning, on the driver.

    def _new_directories(self, kind: str) -> list[str]:
        """Complete subdirectories not loaded yet, oldest first."""
        fs, root = open_path(f"{self._options.path}/{kind}")
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        dirs = sorted(i.path for i in found if i.type == pafs.FileType.Directory)
        dirs = [d for d in dirs if d not in self._loaded]
        marks = fs.get_file_info([f"{d}/_SUCCESS" for d in dirs]) if dirs else []
        return [d for d, m in zip(dirs, marks) if m.type == pafs.FileType.File]

    def _rows(self, directory: str, columns: list[str]) -> pa.Table:
        fs, _ = open_path(self._options.path)
        mine = pc.field("streamName") == self._options.stream_name
        kind = ds.ParquetFileFormat(dictionary_columns=["file"])
        return ds.dataset(directory, filesystem=fs, format=kind).to_table(columns, mine)

    def _refresh(self) -> None:
        new = self._new_directories("pages")
        if new:
            fs, _ = open_path(self._options.path)
            for directory in new:
                self._pages.load(fs, directory)
            self._loaded.update(new)
        listings = self._new_directories("shards")
        if listings:
            shards = self._rows(listings[-1], ["shardId", "endSeq", "listed"]).to_pandas()
            self._gone = set(shards["shardId"][~shards["listed"]])
            shards = shards[shards["listed"]]
            self._ends = dict(zip(shards["shardId"], shards["endSeq"]))
            self._loaded.update(listings)

    def _heads(self, progress: dict, limit: int | None) -> dict:
        """Where each shard stands when the next batch is done.

        All stored records are read, those of shards that a listing has dropped as well.
        """
        heads = dict(progress)
        for shard, stretches in sorted(self._pages.shards.items()):
            before = progress.get(shard, {})
            key = _key(before.get(ITERATOR_POSITION, ""))
            if not stretches or key >= stretches[-1].last_key:
                continue
            if limit is None:
                heads[shard] = _after(stretches[-1].last_seq)
                continue
            done, last = 0, None
            for pages, first, end in self._pages.ahead(shard, key, limit + 1):
                left = pages.records[first:end].copy()
                # A batch may have ended inside a page, which then has fewer rows left.
                read = 0
                file, begin = self._pages.files[pages.file[first]], int(pages.first_row[first])
                if last is None and before.get(_FILE) == file:
                    read = before[_ROW] + 1 - begin if begin <= before[_ROW] < begin + left[0] else 0
                    left[0] -= read
                upto = left.cumsum() + done
                n = min(int(np.searchsorted(upto, limit)), len(upto) - 1)
                last, done = pages.last_seq[first + n].as_py(), int(upto[n])
                if done >= limit:
                    break
            heads[shard] = _after(last)
            if done > limit:
                start = int(pages.first_row[first + n]) + (0 if n else read)
                row = start + limit - int(upto[n] - left[n]) - 1
                file = self._pages.files[pages.file[first + n]]
                heads[shard] |= {ITERATOR_POSITION: self._sequence_at(file, row), _FILE: file, _ROW: row}
        return heads

    def _sequence_at(self, file: str, row: int) -> str:
        """The sequence number in one row of a file; reads one column of one row group.

        The next batch of a shard mostly ends in the same row group, so the last ones are kept.
        """
        source, starts = _kept(self._files, file, lambda: self._open(file))
        while len(self._files) > _KEPT_FILES:
            self._files.popitem(last=False)[1][0].close(force=True)
        group = int(np.searchsorted(starts, row, "right")) - 1
        if row >= starts[-1]:
            raise ValueError(f"{file} has no such row")
        column = _kept(self._columns, (file, group), lambda: self._numbers(source, group))
        while len(self._columns) > 1 and self._held > _KEPT_BYTES:
            self._held -= self._columns.popitem(last=False)[1].nbytes
        return column[row - int(starts[group])].as_py()

    def _numbers(self, source: pq.ParquetFile, group: int) -> pa.Array:
        column = source.read_row_group(group, ["sequenceNumber"])["sequenceNumber"].combine_chunks()
        self._held += column.nbytes
        return column

    def _open(self, file: str) -> tuple[pq.ParquetFile, np.ndarray]:
        """A file, and the rows at which its row groups start, its end with them."""
        fs, root = open_path(f"{self._options.path}/data")
        source = pq.ParquetFile(fs.open_input_file(f"{root}/{file}"))
        rows = [source.metadata.row_group(i).num_rows for i in range(source.num_row_groups)]
        return source, np.cumsum([0, *rows])

    def _close(self, heads: dict, batch: int) -> dict:
        """Mark drained shards: read to their end, or no longer listed and read to their last record.

        No shard is forgotten, as one that is not known would be read from its start.
        """
        offset = {METADATA: {BATCH_ID: str(batch), STREAM_NAME: self._options.stream_name}}
        for shard, at in sorted(heads.items()):
            end = None if self._ends is None else self._ends.get(shard)
            key = _key(at[ITERATOR_POSITION])
            if (end and key >= _key(end)) or (shard in self._gone and key >= self._pages.head(shard)):
                at = {**at, ITERATOR_TYPE: SHARD_END}
            offset[shard] = at
        return offset

    def initialOffset(self) -> dict:
        if self._started is None:
            self._refresh()
            latest = self._options.start == LATEST
            self._started = self._close(self._heads({}, None) if latest else {}, -1)
        return self._started

    def latestOffset(self) -> dict:
        self._refresh()
        progress = self._seen or check_offset(self.initialOffset())
        limit = batch_limit(self._options.page, self._options.cap)
        offset = self._close(self._heads(progress, limit), self._batch)
        if check_offset(offset) != progress:
            offset[METADATA][BATCH_ID] = str(self._batch + 1)
        return offset

    def partitions(self, start: dict, end: dict) -> list[FileRanges]:
        self._refresh()
        first, last = check_offset(start), check_offset(end)
        past = [s for s in first if s in last and _key(first[s][ITERATOR_POSITION]) > _key(last[s][ITERATOR_POSITION])]
        if past:
            raise ValueError(f"a batch starts after its end in shard {past[0]}: {first[past[0]]}, {last[past[0]]}")
        self._batch = max(self._batch, int(end.get(METADATA, {}).get(BATCH_ID, -1)))
        for shard, at in last.items():
            seen = self._seen.get(shard)
            if seen is None or _key(seen[ITERATOR_POSITION]) <= _key(at[ITERATOR_POSITION]):
                self._seen[shard] = at
        after = {s: _key(at[ITERATOR_POSITION]) for s, at in first.items()}
        upto = {s: _key(at[ITERATOR_POSITION]) for s, at in last.items()}
        found: dict[str, tuple[dict, list]] = {}
        for shard in sorted(upto.keys() & self._pages.shards.keys()):
            for file, run in self._pages.between(shard, after.get(shard, ""), upto[shard]):
                shards, runs = found.setdefault(file, ({}, []))
                shards[shard] = None
                runs.append(run)
        return shared_tasks(
            [
                FileRanges(file, [*ids], [after.get(s, "") for s in ids], [upto[s] for s in ids], merged(runs))
                for file, (ids, runs) in sorted(found.items())
            ]
        )

    def commit(self, end: dict) -> None:
        for shard, at in check_offset(end).items():
            self._pages.drop(shard, _key(at[ITERATOR_POSITION]))

    def stop(self) -> None:
        self._pages = PageListing(self._options.stream_name)
        for source, _ in self._files.values():
            source.close(force=True)
        self._files.clear()
        self._columns.clear()
        self._held = 0
        self._loaded = set()

    # Reading, on the executors.

    def read(self, partition: FileRanges) -> Iterator[pa.RecordBatch]:
        for part in (partition, *partition.more):
            yield from self._file_rows(part)

    def _file_rows(self, partition: FileRanges) -> Iterator[pa.RecordBatch]:
        fs, root = open_path(f"{self._options.path}/data")
        wanted, types = _columns(self._options), _arrow_schema(self._options)
        shards = pa.array(partition.shards, pa.string())
        after = pa.array(partition.after, pa.string())
        upto = pa.array(partition.upto, pa.string())
        columns = sorted({*wanted, "streamName", "shardId", "seqKey"})
        for batch in stored_rows(fs, f"{root}/{partition.file}", columns, partition.runs):
            at = pc.index_in(batch.column("shardId"), shards)
            key = batch.column("seqKey")
            inside = pc.and_(pc.greater(key, after.take(at)), pc.less_equal(key, upto.take(at)))
            inside = pc.and_(inside, pc.equal(batch.column("streamName"), self._options.stream_name))
            kept = batch.filter(inside, null_selection_behavior="drop")
            if kept.num_rows:
                yield kept.select(wanted).cast(types)
