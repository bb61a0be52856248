"""Near copies of texts: wide SimHash fingerprints compared tile by tile, then checked exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from changefeed.llm.blocks import Gathered, block_counts, with_part
from changefeed.llm.components import connected_components
from changefeed.storage import materialise

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 64-bit lanes of a fingerprint, and the most of similar pairs that may differ in more
#: bits than the radius of their size allows.
LANES, LOSS = 4, 1e-6
#: Larger sets have the radius of this size, as the share of differing bits falls with it.
LARGE = 64
TILE = 8_192
#: Bytes of text of a part of a group of candidates.
PART_BYTES = 16 << 20
#: Width of a class of population counts.
STEP = 16
_ROWS = 128  # rows of a tile that are compared at once
_SEED = 42


def shingle_set(text: str | None) -> set[bytes]:
    """Different five-word shingles of a lower-cased text; a shorter one is one shingle."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return set()
    return {b" ".join(words[i : i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1))}


def _hashed(shingles: set[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), np.uint64, len(shingles))


def wide_fingerprint(shingles: set[bytes]) -> bytes:
    """SimHash of a set, ``LANES`` times 64 bits."""
    if not shingles:
        return bytes(8 * LANES)
    hashed = _hashed(shingles)
    tie = np.bitwise_xor.reduce(hashed, keepdims=True)  # another for each set, so that ties make no texts alike
    lanes = []
    for lane in range(LANES):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashed), 1 << 16):
            bits = np.unpackbits(_mixed(hashed[at : at + (1 << 16)], lane).view(np.uint8), bitorder="little")
            ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
        even = np.unpackbits(_mixed(tie, lane).view(np.uint8), bitorder="little").astype(bool)
        lanes.append(np.packbits((2 * ones > len(hashed)) | (2 * ones == len(hashed)) & even, bitorder="little").tobytes())
    return b"".join(lanes)


def differing(size: int, other: int, shared: int) -> float:
    """The chance that a bit of two sets of these sizes differs."""

    def sums(n: int) -> np.ndarray:
        """Chances of ``n`` votes to sum up to -n, 2 - n, ... n."""
        return np.array([comb(n, i) for i in range(n + 1)], float) / 2.0**n

    def ones(more: int) -> np.ndarray:
        votes = np.arange(-shared, shared + 1, 2)[:, None] + np.arange(-more, more + 1, 2)
        return ((votes > 0) + (votes == 0) / 2) @ sums(more)

    a, b = ones(size - shared), ones(other - shared)
    return float(sums(shared) @ (a * (1 - b) + b * (1 - a)))


@cache
def radius(size: int) -> int:
    """Bits in which a set of ``size`` shingles and a similar one, as large or larger, differ, but for ``LOSS``."""
    size = min(size, LARGE)
    pairs = [(b, ceil(SIMILARITY * (size + b) / (1 + SIMILARITY) - 1e-9)) for b in range(size, int(size / SIMILARITY) + 1)]
    p = max((differing(size, b, k) for b, k in pairs if k < b and k <= size), default=0.0)  # equal sets do not differ
    n, lost = 64 * LANES, 0.0
    for most in range(n, 0, -1):
        lost += comb(n, most) * p**most * (1 - p) ** (n - most)
        if lost > LOSS:
            return most
    return 0


@cache
def class_radius(size_class: int) -> int:
    """The largest radius of a set in a class of sizes or above it."""
    least = min(LARGE, max(1, int(SIMILARITY**-size_class)))
    return max(radius(size) for size in range(least, LARGE + 1))


def _mixed(hashed: np.ndarray, lane: int) -> np.ndarray:
    """Another hash of each hash, by multiplication and shifts."""
    mixed = (hashed + np.uint64(lane)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


@arrow_udf(StructType([StructField("bits", BinaryType()), StructField("grams", IntegerType())]))
def _printed(texts: pa.Array) -> pa.Array:
    bits, sizes = [], []
    for text in texts:
        found = shingle_set(text.as_py())
        bits.append(wide_fingerprint(found))
        sizes.append(len(found))
    return pa.StructArray.from_arrays([pa.array(bits, pa.binary()), pa.array(sizes, pa.int32())], ["bits", "grams"])


def spanning(left: np.ndarray, right: np.ndarray, far: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Which of the pairs span what all of them connect, beyond what ``label`` has joined.

    Round by round every group of nodes takes its closest pair to a group of a
    lower label; ``label`` is brought up to date in place.
    """
    chosen, open_ = [], np.flatnonzero(label[left] != label[right])
    while len(open_):
        high = np.maximum(label[left[open_]], label[right[open_]])
        low = np.minimum(label[left[open_]], label[right[open_]])
        order = np.lexsort((low, far[open_], high))
        first = order[np.r_[True, np.diff(high[order]) > 0]]
        parent = np.arange(len(label))
        parent[high[first]] = low[first]
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        label[:] = parent[label]
        chosen.append(open_[first])
        open_ = open_[label[left[open_]] != label[right[open_]]]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """``(id_col, component_id)`` for every row with an id; ids are taken to name one text.

    Two texts are linked if their sets of five-word shingles, in lower case, are
    0.8 similar or more; texts of one set always. Candidates are pairs of
    fingerprints of 256 bits within the ``radius`` of the smaller set, found by
    comparing tiles exactly. Tiles hold texts of one class of set size and of population count;
    pairs of tiles are skipped if the counts differ beyond the radius, or the
    sizes by more than a similarity of 0.8 allows. Of a pair of tiles only a
    spanning forest goes on, which names the groups that candidates connect. In a
    group every candidate is then checked on the 64-bit hashes of all shingles,
    unless links found before connect its ends already, so none is lost; links of a
    pair of parts are a forest too.

    Null and blank texts are copies of each other. Repeated rows are one document.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = materialise(rows.select("id", _printed(F.col("text")).alias("p")).select("id", "p.*"), "prints")
    distinct = materialise(prints.groupBy("bits", "grams").agg(F.min("id").alias("node")), "distinct")
    pairs = materialise(_candidates(distinct, tile).distinct(), "candidates")
    families = connected_components(pairs, "one", "other").join(distinct, "node")
    groups = connected_components(_verified(families, rows, tile), "one", "other")
    named = distinct.join(groups, "node", "left").select(
        "bits", "grams", F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(materialise(named, "named"), ["bits", "grams"]).select(F.col("id").alias(id_col), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies, the one of the smallest id.

    Rows of one id count as one document, of which one row stays. Documents
    without an id cannot be named by a group and stay as they are. Columns stay.
    """
    found = near_copies(docs, id_col, text_col)
    first = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    single = docs.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return single.join(first, id_col, "left_semi").unionByName(docs.where(F.col(id_col).isNull()))


def _candidates(distinct: DataFrame, tile: int) -> DataFrame:
    """Pairs ``(one, other)`` of nodes whose fingerprints are close."""
    size = F.floor(F.log(F.greatest("grams", F.lit(1))) / -np.log(SIMILARITY) + 1e-9)
    count = F.aggregate(
        F.sequence(F.lit(0), F.lit(LANES - 1)),
        F.lit(0),
        lambda n, i: n + F.bit_count(F.conv(F.substring(F.hex("bits"), i * 16 + 1, 16), 16, -10).cast("bigint")),
    )
    celled = distinct.where("grams > 0").select(
        "node", "bits", size.cast("int").alias("size_class"), F.floor(count / STEP).cast("int").alias("count_class")
    )
    cells = ["size_class", "count_class"]
    counts = block_counts(celled, cells, tile)
    parted = with_part(celled, counts, cells, F.col("bits"))
    tiles = materialise(
        parted.groupBy(*cells, "part").agg(F.collect_list(F.struct("node", "bits")).alias("members")), "tiles"
    )
    # Counts of two classes differ by (classes apart - 1) * STEP + 1 at least.
    reach = class_radius(0) // STEP + 1
    moves = [(s, c) for s in (0, 1) for c in range(-reach, reach + 1) if (s, c) >= (0, 0)]
    beside = (
        counts.withColumn("move", F.explode(F.array(*(F.array(F.lit(s), F.lit(c)) for s, c in moves))))
        .select(
            *cells,
            F.col("parts").alias("parts_one"),
            (F.col("size_class") + F.col("move")[0]).alias("size_other"),
            (F.col("count_class") + F.col("move")[1]).alias("count_other"),
        )
        .join(
            counts.select(
                F.col("size_class").alias("size_other"), F.col("count_class").alias("count_other"), F.col("parts").alias("parts_other")
            ),
            ["size_other", "count_other"],
        )
    )
    same = "size_class = size_other and count_class = count_other"
    pairs = (
        beside.withColumn("part", F.explode(F.expr("sequence(0, parts_one - 1)")))
        .withColumn("part_other", F.explode(F.expr(f"sequence(if({same}, part, 0), parts_other - 1)")))
        .select(*cells, "part", "size_other", "count_other", "part_other", F.expr(f"{same} and part = part_other").alias("same"))
    )
    other = tiles.select(
        F.col("size_class").alias("size_other"), F.col("count_class").alias("count_other"),
        F.col("part").alias("part_other"), F.col("members").alias("others"),
    )
    joined = pairs.join(tiles, [*cells, "part"]).join(other, ["size_other", "count_other", "part_other"])
    node = distinct.schema["node"].dataType.simpleString()
    return joined.select("size_class", "members", "others").mapInArrow(_compare, f"one {node}, other {node}")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Gathered(["one", "other"])
    for batch in batches:
        for size_class, members, others in zip(*batch.columns, strict=True):
            most = class_radius(size_class.as_py())
            ids_a, a = _fingerprints(members.values)
            ids_b, b = _fingerprints(others.values)
            ids, place = np.unique(np.concatenate([ids_a, ids_b]), return_inverse=True)
            in_a, in_b = place[: len(a)], place[len(a) :]
            label = np.arange(len(ids))
            for at in range(0, len(a), _ROWS):
                far = _apart(a[at : at + _ROWS], b)
                i, j = np.nonzero((far <= most) & (in_a[at : at + _ROWS, None] != in_b[None]))
                one, other = in_a[at + i], in_b[j]
                chosen = spanning(one, other, far[i, j], label)
                _add(out, ids[one[chosen]], ids[other[chosen]])
            yield from out.take()
    yield from out.take(1)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each of some fingerprints and each of others."""
    far = np.zeros((len(a), len(b)), np.uint16)
    for lane in range(LANES):
        far += np.bitwise_count(a[:, lane, None] ^ b[None, :, lane])
    return far


def _add(out: Gathered, one: np.ndarray, other: np.ndarray) -> None:
    if len(one):
        out.add(*np.sort(np.stack([one, other]), axis=0))


def _fingerprints(values: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    bits = b"".join(values.field("bits").to_pylist())
    return values.field("node").to_numpy(zero_copy_only=False), np.frombuffer(bits, np.uint64).reshape(-1, LANES)


def _verified(families: DataFrame, rows: DataFrame, tile: int) -> DataFrame:
    """Links ``(one, other)`` that connect what all similar candidates connect.

    ``families`` are ``(node, component, bits)``; each is compared with itself, in
    parts of bounded size.
    """
    named = families.select("node", F.col("component").alias("family"), "bits")
    texts = rows.join(named, rows["id"] == named["node"]).dropDuplicates(["node"])
    texts = materialise(texts.select("family", "node", "bits", "text"), "families")
    counts = materialise(
        texts.groupBy("family")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
        .select("family", F.ceil(F.greatest(F.col("n") / tile, F.col("size") / PART_BYTES)).cast("int").alias("parts")),
        "blocks",
    )
    members = F.collect_list(F.struct("node", "bits", "text")).alias("members")
    parts = materialise(
        with_part(texts, counts, ["family"], F.col("bits")).groupBy("family", "part").agg(members), "parts"
    )
    beside = (
        counts.where("parts > 1")
        .withColumn("part", F.explode(F.expr("sequence(0, parts - 2)")))
        .withColumn("part_other", F.explode(F.expr("sequence(part + 1, parts - 1)")))
    )
    others = parts.select("family", F.col("part").alias("part_other"), F.col("members").alias("others"))
    across = beside.join(parts, ["family", "part"]).join(others, ["family", "part_other"]).select("members", "others")
    within = parts.select("members", F.lit(None).cast(across.schema["others"].dataType).alias("others"))
    node = families.schema["node"].dataType.simpleString()
    kind = f"one {node}, other {node}"
    return within.mapInArrow(_check, kind).unionByName(across.mapInArrow(_check, kind))


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Gathered(["one", "other"])
    for batch in batches:
        for members, others in zip(*batch.columns, strict=True):
            lists = [members.values] + ([others.values] if others.is_valid else [])
            ids, bits = (np.concatenate(x) for x in zip(*map(_fingerprints, lists), strict=True))
            found = [_hashed(shingle_set(text.as_py())) for values in lists for text in values.field("text")]
            one, other = similar(bits, found, len(members.values) if others.is_valid else 0)
            _add(out, ids[one], ids[other])
            yield from out.take()
    yield from out.take(1)


def similar(bits: np.ndarray, sets: list[np.ndarray], first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what all candidates of enough similarity connect.

    With ``first``, only pairs of one of so many first sets and one of the others count.
    """
    size = np.array([len(x) for x in sets])
    most = np.array([radius(n) for n in range(LARGE + 1)], np.uint16)[np.minimum(size, LARGE)]
    start = np.cumsum(size) - size
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked, label = np.zeros(len(flat), bool), np.arange(len(sets))
    one, other = [], []
    for i in range(first or len(sets)):
        after = first or i + 1
        far = _apart(bits[i : i + 1], bits[after:])[0]
        near = after + np.flatnonzero((far <= np.maximum(most[i], most[after:])) & (label[after:] != label[i]))
        if not len(near):
            continue
        own, total = flat[start[i] : start[i] + size[i]], np.cumsum(size[near])
        marked[own] = True
        places = np.arange(total[-1]) + np.repeat(start[near] - total + size[near], size[near])
        shared = np.add.reduceat(marked[flat[places]], total - size[near], dtype=np.int64)
        marked[own] = False
        near = near[shared >= SIMILARITY * (size[i] + size[near] - shared)]
        _, at = np.unique(label[near], return_index=True)
        joined = np.unique(label[near[at]])
        one += [i] * len(at)
        other += near[at].tolist()
        label[np.isin(label, joined)] = label[i]
    return np.array(one, np.int64), np.array(other, np.int64)
