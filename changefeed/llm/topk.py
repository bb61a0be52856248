"""Exact search for the highest inner products by a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from changefeed.llm.blocks import Gathered, block_counts, bounded_sample, matrix, with_part
from changefeed.storage import materialise

SCALE = 256
PIVOTS, RINGS, FIT_VECTORS = 16, 24, 5_000
BLOCK, QUERY_BLOCK = 2_048, 256
#: What rounding may take from a distance.
SLACK = 1e-6


#: Products of smaller components, 64 of them, fit 64 bits.
MOST = float(2**20)


def finite(vector: Column) -> Column:
    """True for a vector that is not null and holds only finite numbers below ``MOST``."""
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < MOST), F.lit(False)))
    return F.coalesce(sound, F.lit(False))


@dataclass(frozen=True)
class Index:
    """Pivots, the square of the longest vector, and the width of a ring.

    A vector gets one more component that makes all vectors equally long, a query
    gets 0: the squared distance is then a constant less twice the inner product,
    so the highest products are the nearest neighbours.
    """

    pivots: np.ndarray
    longest: float
    ring: float

    def distances(self, rows: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Distances of rows, with their last component, to the pivots."""
        full = np.column_stack([rows, last])
        squared = (full**2).sum(1)[:, None] - 2 * full @ self.pivots.T + (self.pivots**2).sum(1)
        return np.sqrt(np.maximum(squared, 0))

    def filled(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.longest - (rows**2).sum(1), 0))

    @property
    def width(self) -> int:
        return self.pivots.shape[1] - 1


def whole(rows, width: int) -> np.ndarray:
    """Rows of numbers as whole numbers after scaling, in doubles."""
    return np.floor(SCALE * matrix(rows, width))


def _place(index: Index):
    @arrow_udf("pivot int, ring int")
    def place(vectors: pa.Array) -> pa.Array:
        rows = whole(vectors.to_pylist(), index.width)
        apart = index.distances(rows, index.filled(rows))
        pivot = apart.argmin(1)
        ring = np.floor(apart[np.arange(len(rows)), pivot] / index.ring)
        return pa.StructArray.from_arrays(
            [pa.array(pivot.astype(np.int32)), pa.array(ring.astype(np.int32))], ["pivot", "ring"]
        )

    return place


def _visits(index: Index):
    """Rings that a query must visit: all that may hold a vector as near as its bound."""

    @arrow_udf("array<struct<pivot:int,ring:int>>")
    def visits(vectors: pa.Array, least: pa.Array) -> pa.Array:
        rows = whole(vectors.to_pylist(), index.width)
        bound = np.array([-np.inf if x is None else x for x in least.to_pylist()])
        radius = np.sqrt(np.maximum((rows**2).sum(1) + index.longest - 2 * bound, 0)) + SLACK
        apart = index.distances(rows, np.zeros(len(rows)))
        farthest = 2 * np.sqrt(index.longest) + index.ring
        low = np.floor(np.maximum(apart - radius[:, None] - SLACK, 0) / index.ring)
        high = np.floor(np.minimum(apart + radius[:, None] + SLACK, farthest) / index.ring)
        return pa.array(
            [
                [
                    {"pivot": p, "ring": r}
                    for p in range(len(index.pivots))
                    for r in range(int(low[q, p]), int(high[q, p]) + 1)
                ]
                for q in range(len(rows))
            ],
            pa.list_(pa.struct([("pivot", pa.int32()), ("ring", pa.int32())])),
        )

    return visits


def build(vectors: DataFrame, pivots: int, rings: int, most: int) -> Index | None:
    """Fits the index: pivots from a bounded sample, the longest vector over all rows."""
    squared = F.aggregate(
        F.transform("vector", lambda x: F.pow(F.floor(SCALE * x.cast("double")).cast("double"), 2)), F.lit(0.0), lambda a, x: a + x
    )
    known = vectors.agg(F.max(F.size("vector")).alias("width"), F.max(squared).alias("longest")).first()
    if known["width"] is None:
        return None
    sample = bounded_sample(vectors, F.col("id"), most).select("vector").collect()
    rows = whole([r[0] for r in sample], known["width"])
    rows = np.unique(rows, axis=0)
    index = Index(np.zeros((1, rows.shape[1] + 1)), known["longest"], 1.0)
    full = np.column_stack([rows, index.filled(rows)])
    chosen = [int(((full - full.mean(0)) ** 2).sum(1).argmax())]
    apart = ((full - full[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(full)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((full - full[chosen[-1]]) ** 2).sum(1))
    return Index(full[chosen], known["longest"], max(2 * float(np.sqrt(known["longest"])) / rings, 1.0))


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    rings: int = RINGS,
    fit_vectors: int = FIT_VECTORS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, id_col, score)``: the ``k`` highest inner products of each query.

    Components are floor(256 x). Every vector is keyed by its nearest pivot and
    its distance from there, in rings. A query first searches the ring it lies in;
    the k-th product found bounds its radius, and of all rings only those follow
    that the triangle inequality lets hold something as near. Blocks of a ring
    meet blocks of queries, and only rows that reach a query's bound leave a task.

    All vectors but those of the query's own id are candidates; fewer than ``k``
    give fewer rows. Ties go to the smaller id. Vectors and queries that are null
    or hold null or non-finite components, or one of 2^20 or more, whose products
    need not fit 64 bits, take no part, nor do null ids; shorter
    vectors count as filled up with zeros. Repeated rows are candidates each.
    Scores are exact while they stay below 2^53.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & finite(F.col("vector")))
    asked = queries.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    asked = asked.where(F.col("id").isNotNull() & finite(F.col("vector"))).dropDuplicates(["id"])
    index = build(rows, pivots, rings, fit_vectors)
    result = "query_id bigint, rank int, id bigint, score bigint"
    if index is None:
        return vectors.sparkSession.createDataFrame([], result).withColumnRenamed("id", id_col)
    key = ["pivot", "ring"]
    spot = _place(index)(F.col("vector"))
    keyed = materialise(rows.withColumn("spot", spot).select("id", "vector", "spot.*"), "keyed")
    member = F.struct("id", "vector")
    parted = with_part(keyed, block_counts(keyed, key, block), key, F.xxhash64("id", "vector"))
    blocks = materialise(parted.groupBy(*key, "part").agg(F.collect_list(member).alias("members")), "blocks")

    placed = materialise(asked.withColumn("spot", spot).select("id", "vector", "spot.*"), "asked")
    bounded = placed.withColumn("least", F.lit(None).cast("bigint"))
    near = materialise(_best(_meet(bounded, blocks, key, query_block), index, k), "near")
    first = near.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), False).alias("found"))
    bounded = materialise(
        placed.join(first, placed["id"] == first["query_id"], "left").select(
            "id", "vector", F.col("pivot").alias("own_pivot"), F.col("ring").alias("own_ring"),
            F.get("found", F.lit(k - 1)).alias("least"),
        ),
        "bounded",
    )
    spread = (
        bounded.withColumn("visit", F.explode(_visits(index)(F.col("vector"), F.col("least"))))
        .select("id", "vector", "least", "visit.*", "own_pivot", "own_ring")
        .where("pivot <> own_pivot or ring <> own_ring")
    )
    rest = _best(_meet(spread, blocks, key, query_block), index, k)
    ranked = near.unionByName(rest).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    )
    return ranked.where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score"
    )


def _meet(asked: DataFrame, blocks: DataFrame, key: list[str], size: int) -> DataFrame:
    """Blocks of queries beside each block of the rings that they visit."""
    rings = asked.join(blocks.select(*key).distinct(), key, "left_semi")
    counts = block_counts(rings, key, size)
    grouped = (
        with_part(rings, counts, key, F.col("id"))
        .groupBy(*key, F.col("part").alias("query_part"))
        .agg(F.collect_list(F.struct("id", "vector", "least")).alias("asked"))
    )
    return grouped.join(blocks, key).select("asked", "members")


def _best(met: DataFrame, index: Index, k: int) -> DataFrame:
    """Of each pair of blocks, the best ``k`` of every query that reach its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Gathered(["query_id", "id", "score"])
        for batch in batches:
            for asked, members in zip(*batch.columns, strict=True):
                q_ids, q = _rows(asked.values, index.width)
                ids, rows = _rows(members.values, index.width)
                order = np.argsort(ids, kind="stable")
                ids, rows = ids[order], rows[order]
                least = np.array([-np.inf if x is None else x for x in asked.values.field("least").to_pylist()])
                score = q @ rows.T
                score[(score < least[:, None]) | (ids[None] == q_ids[:, None])] = -np.inf
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(score, best, 1)
                row, col = np.nonzero(found > -np.inf)
                out.add(q_ids[row], ids[best[row, col]], found[row, col].astype(np.int64))
                yield from out.take()
        yield from out.take(1)

    return met.mapInArrow(run, "query_id bigint, id bigint, score bigint")


def _rows(values: pa.StructArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    vectors = values.field("vector")
    flat, sizes = vectors.flatten().to_numpy(zero_copy_only=False), vectors.value_lengths().to_numpy()
    if (sizes == width).all():
        rows = np.floor(SCALE * flat.astype(float).reshape(-1, width))
    else:
        rows = whole(vectors.to_pylist(), width)
    return values.field("id").to_numpy(), rows
