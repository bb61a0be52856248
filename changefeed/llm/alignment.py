"""Alignment of two tokenizers' tokens, and how often their ids are linked."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from changefeed.llm.packing import VOCABULARY as BYTES, Encoder
from changefeed.storage import materialise

PIECES = "piece_bpe_32k.model"
#: Distinct id pairs and rows after which a block of documents is closed.
BLOCK_PAIRS, BLOCK_ROWS = 250_000, 20_000
#: Bytes of text after which a task forgets what it found in its windows.
_KNOWN = 4_500_000
_SHIFT = 32
#: A space between two characters that are not blank, and a piece that goes across one.
_ANCHOR, _ACROSS = re.compile(r"(?<=\S) (?=\S)"), re.compile("[^▁]▁")
_NOTHING = 0, 0, "", np.empty(0, np.int64)


class Side:
    """One tokenizer: its ids of a space and a text, and of each id its bytes."""

    def __init__(self, encode, pieces: list[bytes]) -> None:
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)

    def ids(self, text: str, raw: bytes) -> np.ndarray | None:
        """The ids; None, if they do not spell the bytes."""
        ids = self.encode(text)
        spelled = b"".join(map(self.pieces.__getitem__, ids)) == raw
        return np.array(ids, "<i4") if spelled else None


def byte_side(path: str) -> Side:
    """A byte-level vocabulary file; strings of special tokens are plain text to it."""
    encoder = Encoder(path, specials_are_text=True)
    return Side(lambda text: encoder.ids(" " + text), encoder.pieces())


def piece_side(path: str) -> Side:
    """A sentencepiece model; byte pieces stand for single bytes, U+2581 for a space."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(_ACROSS.search(name) for name in names):
        raise ValueError(f"{path} has pieces that go across a space")
    pieces = [
        bytes([int(name[3:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        for i, name in enumerate(names)
    ]
    return Side(lambda text: model.encode(text, num_threads=1), pieces)


class Aligner:
    """Groups and links of texts, by windows between whitespace anchors.

    An anchor is a single space between two characters that are not blank. Neither
    tokenizer has a token across it, and on both sides the next token starts with
    that space, so the ids of a text are those of the parts between anchors, one
    after the other. Parts not seen before are tokenised together as one text; that
    both sides' tokens spell it and end at every anchor is verified by the bytes of
    the tokens. The two tuples of ids between anchors are a window, and what was found
    for a window is kept by them.
    """

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        self._forget()

    def _forget(self) -> None:
        self.held = 0
        #: Number of the window of a part, -1 if it is not spelled; of two tuples of ids.
        self.parts: dict[str, int] = {}
        self.windows: dict[bytes, int] = {}
        #: Of each window: its groups as text, its links, ids of A and of B.
        self.shown: list[str] = []
        self.links, self.ends = array("q"), array("q", [0])
        self.of_a, self.of_b = array("q"), array("q")

    def align(self, text: str | None) -> tuple[int, int, str, np.ndarray]:
        """Numbers of tokens of both sides, the groups as text, and a linked id pair per group."""
        if not text:
            return _NOTHING
        if self.held >= _KNOWN:
            self._forget()
        parts = _ANCHOR.split(text)
        numbers = list(map(self.parts.get, parts))
        if None in numbers:
            new = [p for p in dict.fromkeys(parts) if p not in self.parts]
            # The ends of a text may be blank; such a part is tokenised by itself.
            inner = [p for p in new if p.strip() == p != ""]
            for some in [inner, *([p] for p in new if p.strip() != p or not p)]:
                self._learn(some)
            numbers = list(map(self.parts.__getitem__, parts))
        at = np.array(numbers)
        if at.min() < 0:
            return _NOTHING
        of_a, of_b, ends, links = (np.frombuffer(x, np.int64) for x in (self.of_a, self.of_b, self.ends, self.links))
        sizes = ends[at + 1] - ends[at]
        found = links[np.repeat(ends[at + 1] - sizes.cumsum(), sizes) + np.arange(sizes.sum())]
        return int(of_a[at].sum()), int(of_b[at].sum()), ";".join(map(self.shown.__getitem__, numbers)), found

    def _learn(self, parts: list[str]) -> None:
        if not parts:
            return
        text = " ".join(parts)
        raw = (" " + text).encode()
        a, b = self.a.ids(text, raw), self.b.ids(text, raw)
        if a is None or b is None:
            if len(parts) == 1:
                self.parts[parts[0]] = -1
            else:
                self._learn(parts[: len(parts) // 2])
                self._learn(parts[len(parts) // 2 :])
            return
        self.held += len(raw)
        ends_a, ends_b = self.a.sizes[a].cumsum(), self.b.sizes[b].cumsum()
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        anchors = np.cumsum([1 + len(p.encode()) for p in parts])
        upto = np.searchsorted(shared, anchors) + 1
        if not np.array_equal(shared[upto - 1], anchors):
            raise ValueError("a token goes across a space")
        to_a, to_b = np.searchsorted(ends_a, shared) + 1, np.searchsorted(ends_b, shared) + 1
        links = (a[to_a - 1].astype(np.int64) << _SHIFT | b[to_b - 1]).tolist()
        named_a, named_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        cuts_a, cuts_b = [0, *to_a.tolist()], [0, *to_b.tolist()]
        bytes_a, bytes_b = a.tobytes(), (~b).tobytes()  # turned, so that a key tells where they begin
        first = 0
        for part, last in zip(parts, upto.tolist(), strict=True):
            i, j, k, m = cuts_a[first], cuts_a[last], cuts_b[first], cuts_b[last]
            key = bytes_a[4 * i : 4 * j] + bytes_b[4 * k : 4 * m]
            number = self.windows.get(key)
            if number is None:
                number = self.windows[key] = len(self.shown)
                groups = [
                    ",".join(named_a[cuts_a[g] : cuts_a[g + 1]]) + "|" + ",".join(named_b[cuts_b[g] : cuts_b[g + 1]])
                    for g in range(first, last)
                ]
                self.shown.append(";".join(groups))
                self.links.extend(links[first:last])
                self.ends.append(len(self.links))
                self.of_a.append(j - i)
                self.of_b.append(m - k)
            self.parts[part] = number
            first = last


_aligners: dict[tuple[str | None, str | None], Aligner] = {}


def aligner(byte_path: str | None = None, piece_path: str | None = None) -> Aligner:
    """The aligner of two vocabulary files, once per process; None: the public defaults."""
    key = (byte_path, piece_path)
    if key not in _aligners:
        _aligners[key] = Aligner(
            byte_side(byte_path or public_tokenizers.path(BYTES)),
            piece_side(piece_path or public_tokenizers.path(PIECES)),
        )
    return _aligners[key]


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class _Block:
    """Documents of a task, their counts, and which pairs they link how often."""

    def __init__(self) -> None:
        self.docs: list[tuple] = []
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.pairs = 0

    def add(self, doc, found: tuple) -> None:
        n_a, n_b, shown, links = found
        codes, times = np.unique(links, return_counts=True)
        digest = hashlib.sha256(shown.encode()).hexdigest() if n_a else ""
        self.docs.append((doc, n_a, n_b, len(links), len(links), digest, len(codes)))
        self.codes.append(codes)
        self.times.append(times)
        self.pairs += len(codes)

    def row(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        codes, place = np.unique(np.concatenate(self.codes), return_inverse=True)
        times = np.concatenate(self.times)
        totals = np.bincount(place, times, len(codes)).astype(np.int64)
        id_, *counts, digest, pairs = zip(*self.docs, strict=True)
        docs = pa.StructArray.from_arrays(
            [
                pa.array(id_, kind),
                *(pa.array(c, pa.int64()) for c in counts),
                pa.array(digest, pa.string()),
                pa.array(pairs, pa.int32()),
            ],
            ["id", *_COUNTS, "digest", "pairs"],
        )
        whole = [docs, pa.array(codes), pa.array(totals), pa.array(place.astype(np.int32)), pa.array(times.astype(np.int32))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in whole]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists], ["block", "docs", "codes", "totals", "places", "times"])


def _blocks_schema(kind: DataType) -> StructType:
    doc = StructType(
        [
            StructField("id", kind),
            *(StructField(name, LongType()) for name in _COUNTS),
            StructField("digest", StringType()),
            StructField("pairs", IntegerType()),
        ]
    )
    lists = {"docs": doc, "codes": LongType(), "totals": LongType(), "places": IntegerType(), "times": IntegerType()}
    return StructType([StructField("block", LongType()), *(StructField(n, ArrayType(t)) for n, t in lists.items())])


def _blocks(byte_path: str | None, piece_path: str | None, most_pairs: int, most_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(byte_path, piece_path)
        number, block = TaskContext.get().partitionId() << _SHIFT, _Block()
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                block.add(doc.as_py(), found.align(text.as_py()))
                if block.pairs >= most_pairs or len(block.docs) >= most_rows:
                    yield block.row(number, kind)
                    number, block = number + 1, _Block()
        if block.docs:
            yield block.row(number, kind)

    return run


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, its links weighed by the counts of its block's pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            docs, places, times, weights = (batch.column(i)[row].values for i in range(4))
            places, times = places.to_numpy(), times.to_numpy()
            count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if weights is not None and len(weights):
                at = weights.field("at").to_numpy().argsort()
                count = weights.field("count").to_numpy()[at]
                best = weights.field("best").to_numpy(zero_copy_only=False)[at].astype(np.int64)
            ends = docs.field("pairs").to_numpy().astype(np.int64).cumsum()
            sums = []
            for each in (best, count):
                running = np.append(0, (each[places] * times).cumsum())
                sums.append(running[ends] - running[np.append(0, ends[:-1])])
            yield pa.RecordBatch.from_arrays(
                [docs.field("id"), *(docs.field(c) for c in _COUNTS), *(pa.array(s) for s in sums), docs.field("digest")],
                ["id", *_COUNTS, "n_best", "count_sum", "groups_sha256"],
            )


def align_tokenizers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
    block_pairs: int = BLOCK_PAIRS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per document, how its tokens of a byte-level vocabulary (A) and of a piece model (B) align.

    ``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``. A
    encodes a space and the text, B the text, before which it puts a space itself.
    A link is a pair of tokens of A and B that end at the same byte; these ends cut
    the tokens into groups (:class:`Aligner`). ``n_best`` counts the links whose pair
    of ids is linked most often in all documents among the pairs of its id of B, ties
    included; ``count_sum`` adds up, over links, how often the pair is linked in all.

    Tasks write blocks of documents: how often each document links which pair, by its
    place in the block's own list of pairs, and that list with its counts. Counts of
    all documents come from those lists alone, by pair and then by id of B; each list
    gets them back by a join on the pair, and each block its list by a join on the
    block. So a pair is shuffled once a block, however often it is linked, and blocks
    are of bounded size, but for a single document that is larger.

    A text that is null or empty, or that either side does not spell byte by byte
    (as where it holds the piece model's mark for spaces), has no tokens: zeros and an
    empty digest. Repeated rows count and come as often as they are there; a null id
    stays null. Other columns are ignored; an empty table gives no rows.
    """
    kind = docs.select(id_col).schema[0].dataType
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = materialise(
        plain.mapInArrow(_blocks(byte_path, piece_path, block_pairs, block_rows), _blocks_schema(kind)), "blocks"
    )
    listed = blocks.select("block", F.posexplode(F.arrays_zip("codes", "totals")).alias("at", "pair")).select(
        "block", "at", F.col("pair.codes").alias("code"), F.col("pair.totals").alias("total")
    )
    counts = materialise(listed.groupBy("code").agg(F.sum("total").alias("count")), "pairs")
    b_id = F.col("code").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    highest = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("highest"))
    ranked = counts.withColumn("b_id", b_id).join(highest, "b_id").select(
        "code", "count", (F.col("count") == F.col("highest")).alias("best")
    )
    weights = (
        listed.drop("total")
        .join(ranked, "code")
        .groupBy("block")
        .agg(F.collect_list(F.struct("at", "count", "best")).alias("weights"))
    )
    schema = StructType(
        [
            StructField("id", kind),
            *(StructField(name, LongType()) for name in [*_COUNTS, "n_best", "count_sum"]),
            StructField("groups_sha256", StringType()),
        ]
    )
    met = blocks.join(weights, "block", "left").select("docs", "places", "times", "weights")
    return met.mapInArrow(_weigh, schema).withColumnRenamed("id", id_col)
