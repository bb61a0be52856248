"""Token ids in Arrow stream files of equal-length sequences and masks.

A file is an Arrow IPC stream. Its record batches have two columns, ``ids``
(fixed-size lists of unsigned ids, of 16 bits if the vocabulary allows, else 32) and ``mask`` (fixed-size lists of booleans, a
bit each: true for an id, false for the padding behind the file's last id), and all
batches but the last hold the same number of sequences. Equal batches take equally many bytes,
so sequence i lies in batch i // batch_rows at a known place: it is read by memory
map, without copying and without reading what comes before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from changefeed.llm.words import word_encoder
from changefeed.sources.stream import open_path
from changefeed.storage import qualified, scratch_path

LENGTH, BATCH_ROWS = 1024, 256
END_ID = 2
_OUT_BYTES = 4 << 20


class TokenFileWriter:
    """Writes one file; holds no more than one batch of sequences."""

    def __init__(self, sink, length: int, batch_rows: int, kind: str = "<u4") -> None:
        self.length, self.batch_rows, self.sink = length, batch_rows, sink
        meta = {"sequence_length": str(length), "batch_rows": str(batch_rows)}
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))], meta
        )
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.room = np.empty(length * batch_rows, kind)
        self.filled = self.tokens = 0

    def add(self, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        while len(ids):
            take = min(len(ids), len(self.room) - self.filled)
            self.room[self.filled : self.filled + take] = ids[:take]
            self.filled, ids = self.filled + take, ids[take:]
            if self.filled == len(self.room):
                self._batch()

    def _batch(self) -> None:
        size = -(-self.filled // self.length) * self.length
        self.room[self.filled : size] = 0
        mask = np.arange(size) < self.filled
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (self.room[:size], mask)
        ]
        self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._batch()
        self.stream.close()
        self.sink.close()


class TokenFile:
    """Random access to the sequences of one file.

    On a local file system the arrays are views of the mapped file; elsewhere a
    batch is read when it is first needed.
    """

    def __init__(self, path: str) -> None:
        system, place = open_path(path)
        local = isinstance(system, pafs.LocalFileSystem)
        self.source = pa.memory_map(place) if local else system.open_input_file(place)
        self.schema = pa.ipc.read_schema(self.source)
        self.start = self.source.tell()
        meta = self.schema.metadata
        self.length, self.batch_rows = int(meta[b"sequence_length"]), int(meta[b"batch_rows"])
        self.held: tuple[int, pa.RecordBatch | None] = (-1, None)
        self.bytes = 0
        self.bytes = self._load(0)

    def _load(self, batch: int) -> int:
        self.source.seek(self.start + batch * self.bytes)
        message = pa.ipc.read_message(self.source)
        self.held = (batch, pa.ipc.read_record_batch(message, self.schema))
        return self.source.tell() - self.start

    def _columns(self, batch: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """All ids of a batch, and the mask of them, both as views."""
        if self.held[0] != batch:
            self._load(batch)
        ids, mask = (c.flatten() for c in self.held[1].columns)
        return ids.to_numpy(zero_copy_only=True), mask

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``."""
        ids, mask = self._columns(i // self.batch_rows)
        at = i % self.batch_rows * self.length
        return ids[at : at + self.length], mask.slice(at, self.length)

    def tokens(self, at: int, count: int) -> np.ndarray:
        """``count`` ids from the ``at``-th on, without a copy if they lie in one batch."""
        size, parts = self.length * self.batch_rows, []
        while True:
            ids, mask = self._columns(at // size)
            ids, mask = ids[at % size :][:count], mask.slice(at % size, count)
            if mask.true_count != len(ids) or count and not len(ids):
                raise ValueError("the file ends before these ids")
            parts.append(ids)
            at, count = at + len(ids), count - len(ids)
            if not count:
                return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def close(self) -> None:
        self.held = (-1, None)
        self.source.close()


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    length: int = LENGTH,
    batch_rows: int = BATCH_ROWS,
) -> None:
    """Encodes all documents in order of their ids into files under ``path``.

    Spark deals the documents out by ranges of ``id_col`` and sorts each range, by
    text where ids are equal, null ids last. A task writes one file,
    ``files/<random>.arrows``, of the ids of its documents, each followed by
    ``end_id``, in 16 bits each if all ids are below 65,536, and gives a row per document to the index: ``id``, ``file``, the
    place ``at`` of its first id in that file, ``n_tokens`` and ``mark``, the order
    of the files. Spark commits the index, a Parquet table in ``index``, so only
    files of tasks that were committed are ever named; what a lost or repeated
    task left is not read. A null or empty text has the end id alone. Repeated rows
    are written as often as they come; other columns are ignored. An empty table
    gives an empty index.
    """
    spark = docs.sparkSession
    root = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        encode, kind_of_ids = encoder.encode, "<u2" if max(encoder.size, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        writer, name, mark = None, f"{uuid.uuid4().hex}.arrows", None
        for batch in batches:
            ids, at, counts = [], [], []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                if writer is None:
                    sink, mark = _sink(f"{root}/files/{name}"), doc.as_py()
                    writer = TokenFileWriter(sink, length, batch_rows, kind_of_ids)
                tokens = np.frombuffer(encode(text.as_py() or "") + end, "<u4")
                at.append(writer.tokens)
                counts.append(len(tokens))
                writer.add(tokens)
            rows = len(counts)
            kind = batch.schema.field(0).type
            columns = [
                batch.column(0), pa.array([name] * rows, pa.string()), pa.array([mark] * rows, kind),
                pa.array(at, pa.int64()), pa.array(counts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "file", "mark", "at", "n_tokens"])
        if writer is not None:
            writer.close()

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_last()]
    kind = plain.schema["id"].dataType
    schema = StructType(
        [
            StructField("id", kind),
            StructField("file", StringType()),
            StructField("mark", kind),
            StructField("at", LongType()),
            StructField("n_tokens", LongType()),
        ]
    )
    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    ranged.mapInArrow(run, schema).write.mode("error").parquet(f"{root}/index")


def _sink(path: str):
    system, place = open_path(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """What the files under ``path`` hold: ``(id, start, n_tokens, ids)``, a row per document.

    ``start`` counts the ids of all documents before it, ``ids`` are little-endian,
    four bytes each, the end id last. Files follow each other in order of the first
    id in them; that order and their sizes are one row per file. Each task opens the
    files that its part of the index names and reads no others.
    """
    root = qualified(spark, path)
    index = spark.read.parquet(f"{root}/index")
    sizes = index.groupBy("file").agg(F.first("mark").alias("mark"), F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy(F.col("mark").asc_nulls_last(), "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, opened = None, None
        for batch in batches:
            held, size, from_row = [], 0, 0
            files, at, counts = (batch.column(i).to_pylist() for i in (2, 3, 4))
            for row, (file, place, count) in enumerate(zip(files, at, counts, strict=True)):
                if file != name:
                    if opened is not None:
                        opened.close()
                    name, opened = file, TokenFile(f"{root}/files/{file}")
                held.append(opened.tokens(place, count).astype("<u4", copy=False).tobytes())
                size += 4 * count
                if size >= _OUT_BYTES or row + 1 == len(files):
                    part = batch.slice(from_row, row + 1 - from_row)
                    found = pa.array([len(x) // 4 for x in held], pa.int64())
                    columns = [part.column(0), part.column(1), found, pa.array(held, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids"])
                    held, size, from_row = [], 0, row + 1
        if opened is not None:
            opened.close()

    placed = index.join(starts, "file").select(
        "id", (F.col("first") + F.col("at")).alias("start"), "file", "at", "n_tokens"
    )
    schema = StructType(
        [
            StructField("id", index.schema["id"].dataType),
            StructField("start", LongType()),
            StructField("n_tokens", LongType()),
            StructField("ids", BinaryType()),
        ]
    )
    return placed.mapInArrow(run, schema)


def token_table(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Writes the files to the shared folder and reads them back; see the two functions above."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, id_col, text_col, vocabulary)
    return read_token_files(spark, path).withColumnRenamed("id", id_col)
