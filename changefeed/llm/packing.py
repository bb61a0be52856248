"""Harmonic packing of token sequences."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from tokenizers import Tokenizer

CAPACITY = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
#: Letters up to here have been the same in every Unicode version the libraries know.
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: ``tiktoken`` overflows its stack on runs that are a hundred times as long.
_LONG_BLANKS = re.compile(r"\s{5000}")
_OUT_BYTES = 8 << 20
#: Ids of padding that one more piece, and one id too few in a cut piece, are worth.
PIECE_COST, LEAST_PIECE = 8, 32
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of a byte-level vocabulary file, little-endian, four bytes an id.

    The file is read by ``tokenizers``. Texts of Latin letters take the same
    vocabulary through ``tiktoken``, which gives the same ids several times faster;
    all others, and any that it refuses, go through ``tokenizers``.
    """

    def __init__(self, path: str, specials_are_text: bool = False) -> None:
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = specials_are_text
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        special = {t["content"]: t["id"] for t in known["added_tokens"]}
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in piece): i
            for piece, i in known["model"]["vocab"].items()
            if piece not in special
        }
        self.fast = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.ranks = ranks
        self.special_ids = {i: content.encode() for content, i in special.items()}
        self.special = [] if specials_are_text else list(special)

    def pieces(self) -> list[bytes]:
        """The bytes of each id; ids that the file leaves out have none."""
        named = {i: piece for piece, i in self.ranks.items()} | self.special_ids
        return [named.get(i, b"") for i in range(max(named) + 1)]

    def ids(self, text: str) -> list[int]:
        plain = not _BEYOND_LATIN.search(text) and not any(s in text for s in self.special)
        if plain and not _LONG_BLANKS.search(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path: str | None) -> Encoder:
    """The encoder of a vocabulary file, once per process; None: the public default."""
    if path is None:
        path = public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@lru_cache
def first_pieces(capacity: int) -> tuple[list[int], list[int]]:
    """By length, the first piece of a whole document, and of the rest of one that is cut.

    ``capacity // s`` pieces of length s share a sequence, and each wastes what it lacks of
    its share. Cuts make waste least, where every piece costs ``PIECE_COST`` ids, and every
    id that a piece of a cut document has fewer than ``LEAST_PIECE`` costs one. Equal costs
    go to the longer first piece.
    """
    sizes = np.arange(1, capacity + 1)
    whole = capacity / (capacity // sizes) - sizes + PIECE_COST
    part = whole + np.maximum(LEAST_PIECE - sizes, 0)
    cost = np.zeros(2 * capacity)
    first, first_of_rest = [0], [0]
    for length in range(1, 2 * capacity):
        longest = min(length, capacity)
        costs = (part[:longest] + cost[length - longest : length][::-1])[::-1]
        best = int(np.argmin(costs))
        cost[length] = costs[best]
        first_of_rest.append(longest - best)
        uncut = length <= capacity and whole[length - 1] <= costs[best]
        first.append(length if uncut else longest - best)
    return first, first_of_rest


def pieces(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths to cut a document into: whole sequences, then as :func:`first_pieces` has it."""
    found = [capacity] * max(length // capacity - 1, 0)
    rest = length - capacity * len(found)
    first, first_of_rest = first_pieces(capacity)
    size = (first_of_rest if found else first)[rest]
    while rest:
        found.append(size)
        rest -= size
        size = first_of_rest[rest]
    return found


def first_fit(held: list[tuple], capacity: int) -> list[list[tuple]]:
    """Pieces, long ones first, each into the first sequence with room for it."""
    sequences, room = [], []
    for piece in sorted(held, key=lambda p: -p[2]):
        place = next((i for i, free in enumerate(room) if free >= piece[2]), len(room))
        if place == len(room):
            sequences.append([])
            room.append(capacity)
        sequences[place].append(piece)
        room[place] -= piece[2]
    return sequences


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
) -> DataFrame:
    """Cuts every document into pieces and packs these into sequences with little padding.

    Returns a row per piece: id, ``start`` (ids of the document before it),
    ``length``, ``ids`` (binary, four bytes an id, little-endian), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence.

    A document is its ids and then id 0, so a null or empty text is one id. Class k
    holds pieces longer than capacity / (k + 1) and no longer than capacity / k, and
    each of its sequences takes exactly k of them. Documents fill whole sequences
    first; the rest stays whole where it nearly fills its share, and is cut where that
    saves more padding than the cut costs. Each task fills its own sequences and
    holds back fewer than k pieces a class; what is left at its end, some dozens of
    sequences at most, goes together by first fit, long pieces first. So there is no
    shuffle and no sequence over ``capacity``, which must be a power of two.
    Sequences end short of it by what :func:`first_pieces` wastes.
    Repeated rows are packed as often as they come; other columns are ignored.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        first = TaskContext.get().partitionId() << 36
        names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        made, out, size, kind = 0, [], 0, None
        waiting: dict[int, list[tuple]] = {}

        def close(held: list[tuple]) -> None:
            nonlocal made, size
            offset = 0
            for piece in held:
                out.append((*piece, first + made, offset))
                offset += piece[2]
                size += len(piece[3]) + 64
            made += 1

        def table() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 7
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], [id_col, *names]
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                blob, at = memoryview(_little_endian(ids)), 0
                for length in pieces(len(ids), capacity):
                    held = waiting.setdefault(capacity // length, [])
                    part = blob[4 * at : 4 * (at + length)].tobytes()
                    held.append((doc.as_py(), at, length, part, len(ids)))
                    if len(held) == capacity // length:
                        close(held)
                        held.clear()
                    at += length
                if size >= _OUT_BYTES:
                    yield table()
                    out, size = [], 0
        for held in first_fit([piece for held in waiting.values() for piece in held], capacity):
            close(held)
        if out:
            yield table()

    kinds = {name: LongType() for name in ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]}
    kinds["ids"] = BinaryType()
    schema = StructType(
        [docs.select(id_col).schema[0], *(StructField(name, kind) for name, kind in kinds.items())]
    )
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _little_endian(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()
