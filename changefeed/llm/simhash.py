"""SimHash near-duplicates by tiled exact comparison of fingerprints."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from changefeed.llm.blocks import Gathered, block_counts, forest, with_part
from changefeed.llm.components import connected_components
from changefeed.storage import materialise

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
TILE = 1024
#: A fingerprint's bits in four quarters of 16, so 0 to 16 of a quarter are set.
QUARTERS, STEPS = 4, 17
_SLICE = 1 << 16


def text_fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, as a signed number."""
    found = text.lower().split() if text else []  # on bytes: A-Z and the six blanks only
    if not found:
        return 0
    count = max(1, len(found) - words + 1)
    hashed = np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), SEED) for i in range(count)),
        np.uint64,
        count,
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, count, _SLICE):
        bits = np.unpackbits(hashed[i : i + _SLICE].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


@arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([text_fingerprint(t.as_py()) for t in texts.cast(pa.binary())], pa.int64())


def fingerprint(text: Column) -> Column:
    """SimHash of a text column as a long; null, empty and blank texts give zero."""
    return _fingerprints(text)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row of ``docs``.

    Fingerprints at ``radius`` or fewer differing bits are linked, texts with one
    fingerprint always; ``component_id`` is the smallest id reachable. Equal
    fingerprints are compared once however many rows have them. The distinct
    ones are tiled by the population counts of their four quarters; two tiles are
    compared only if these counts differ by no more than the radius in all, which
    holds for every pair within it, so no link is lost.

    Null and blank texts have fingerprint zero and are linked like any other. A
    null id never names a component unless all its ids are null. Repeated rows
    give repeated results. Other columns of ``docs`` are not looked at.
    """
    prints = materialise(
        docs.select(F.col(id_col), fingerprint(F.col(text_col)).alias("fingerprint")), "prints"
    )
    distinct = materialise(
        prints.groupBy("fingerprint").agg(F.min(id_col).alias("first_id")), "distinct"
    )
    groups = connected_components(linked_fingerprints(distinct, radius, tile), "one", "other")
    rooted = distinct.join(
        groups.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("component", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialise(
        rooted.join(smallest, "root").select("fingerprint", "component_id"), "named"
    )
    return prints.join(named, "fingerprint").select(id_col, "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id.

    Rows of one id count as one document, of which one row stays. Documents
    without an id cannot be named by a component and stay as they are. Columns stay.
    """
    found = near_duplicates(docs, id_col, text_col)
    first = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    single = docs.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return single.join(first, id_col, "left_semi").unionByName(docs.where(F.col(id_col).isNull()))


def linked_fingerprints(distinct: DataFrame, radius: int, tile: int) -> DataFrame:
    """Pairs ``(one, other)`` that connect all fingerprints within the radius.

    Each pair of tiles gives a spanning forest of its links, not all of them, so
    a large group of near copies stays linear.
    """
    quarters = [
        F.bit_count(F.shiftrightunsigned("fingerprint", 16 * i).bitwiseAND(F.lit(0xFFFF)))
        for i in range(QUARTERS)
    ]
    celled = distinct.select("fingerprint", *(q.alias(f"q{i}") for i, q in enumerate(quarters)))
    cells = [f"q{i}" for i in range(QUARTERS)]
    counts = block_counts(celled, cells, tile)
    parted = with_part(celled, counts, cells, F.col("fingerprint"))
    tiles = materialise(
        parted.withColumn("cell", _cell(*cells))
        .groupBy("cell", "part")
        .agg(F.collect_list("fingerprint").alias("prints")),
        "tiles",
    )
    one = tiles.select(F.col("cell").alias("cell_one"), F.col("part").alias("part_one"), F.col("prints").alias("one"))
    other = tiles.select(F.col("cell").alias("cell_other"), F.col("part").alias("part_other"), F.col("prints").alias("other"))
    pairs = _tile_pairs(counts, cells, radius)
    joined = pairs.join(one, ["cell_one", "part_one"]).join(other, ["cell_other", "part_other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gathered(["one", "other"])
        for batch in batches:
            for left, right in zip(batch.column("one"), batch.column("other"), strict=True):
                a, b = (x.values.to_numpy().view(np.uint64) for x in (left, right))
                i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
                linked = a[i] != b[j]
                if linked.any():
                    nodes, place = np.unique(np.stack([a[i[linked]], b[j[linked]]]), return_inverse=True)
                    high, low = forest(*place.reshape(2, -1), len(nodes))
                    found.add(nodes[high].view(np.int64), nodes[low].view(np.int64))
                    yield from found.take()
        yield from found.take(1)

    return joined.select("one", "other").mapInArrow(compare, "one bigint, other bigint")


def _cell(*quarters: str | Column) -> Column:
    return sum(
        (F.col(q) if isinstance(q, str) else q).cast("int") * STEPS**i
        for i, q in enumerate(quarters)
    )


def _tile_pairs(counts: DataFrame, cells: list[str], radius: int) -> DataFrame:
    """All pairs of tiles whose counts differ by ``radius`` or less, each pair once."""
    moves = [
        move
        for move in itertools.product(range(-radius, radius + 1), repeat=len(cells))
        if sum(map(abs, move)) <= radius and move >= (0,) * len(cells)
    ]
    steps = F.array(*(F.array(*(F.lit(m) for m in move)) for move in moves))
    moved = counts.withColumn("move", F.explode(steps))
    beside = [F.col(c) + F.col("move")[i] for i, c in enumerate(cells)]
    for column in beside:
        moved = moved.where(column.between(0, STEPS - 1))
    left = moved.select(
        _cell(*cells).alias("cell_one"), F.col("parts").alias("parts_one"), _cell(*beside).alias("cell_other")
    )
    right = counts.select(_cell(*cells).alias("cell_other"), F.col("parts").alias("parts_other"))
    return (
        left.join(right, "cell_other")
        .withColumn("part_one", F.explode(F.sequence(F.lit(0), F.col("parts_one") - 1)))
        .withColumn(
            "part_other",
            F.explode(
                F.sequence(
                    F.when(F.col("cell_one") == F.col("cell_other"), F.col("part_one")).otherwise(0),
                    F.col("parts_other") - 1,
                )
            ),
        )
        .select("cell_one", "part_one", "cell_other", "part_other")
    )
