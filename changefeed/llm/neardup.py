"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from changefeed.llm.blocks import Gathered, block_counts, bounded_sample, forest, matrix, with_part
from changefeed.llm.components import connected_components
from changefeed.storage import materialise

SIMILARITY = 0.98
#: Centres of each half, and vectors that they are fitted on, about.
CENTRES, FIT_VECTORS = 8, 10_000
TILE = 512
#: What rounding may take from a bound.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds only finite numbers, one of them not zero."""
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def codebook(points: np.ndarray, centres: int, rounds: int = 8) -> np.ndarray:
    """K-means centres of the points, from points chosen evenly to start with."""
    points = np.unique(points, axis=0)
    found = points[np.linspace(0, len(points) - 1, min(centres, len(points))).astype(int)]
    for _ in range(rounds):
        near = distances(points, found).argmin(1)
        found = np.array([points[near == c].mean(0) if (near == c).any() else found[c] for c in range(len(found))])
    return np.unique(found, axis=0)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    return np.maximum(
        (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None], 0
    )


def cell_bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own cell of each point, and the least squared distance it has to each cell.

    A cell lies beyond the plane halfway between its centre and the point's own.
    """
    squared = distances(points, centres)
    own = squared.argmin(1)
    apart = np.sqrt(distances(centres, centres))[own]
    excess = squared - squared[np.arange(len(points)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = np.where(apart > 0, excess / (2 * apart), 0)
    return own, np.maximum(bound, 0) ** 2


def multi_sequence(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells of the product grid by growing sum of their two bounds, up to ``reach``.

    Both halves are sorted; from a cell taken, the next in either half follows.
    """
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    seen, out = {(0, 0)}, []
    queue = [(first[one[0]] + second[two[0]], 0, 0)]
    while queue:
        bound, i, j = heapq.heappop(queue)
        if bound > reach:
            break
        out.append((int(one[i]), int(two[j])))
        for step in ((i + 1, j), (i, j + 1)):
            if step not in seen and step[0] < len(one) and step[1] < len(two):
                seen.add(step)
                heapq.heappush(queue, (first[one[step[0]]] + second[two[step[1]]], *step))
    return out


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
    centres: int = CENTRES,
    fit_vectors: int = FIT_VECTORS,
    tile: int = TILE,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row of ``vectors``.

    Vectors of one label whose cosine is ``similarity`` or more are linked.
    Equal vectors of a label are compared once and counted as often as they come.
    Unit vectors are cut in halves, each half coded by its own centres, so a pair
    of centres is a cell of the index. Each vector visits cells in order of the
    least distance it can have there and stops where no vector can be close
    enough: every link is found, a recall of one. It is compared with later cells
    only, the earlier ones visit it. The centres are fitted on about
    ``fit_vectors`` vectors; all vectors are indexed.

    Vectors that are null, zero, or hold null or non-finite numbers, and those
    with a null label, have no link, and are a component of their own. Vectors of
    different length are not linked. A component is named by its smallest id;
    ``kept`` is true for rows with that id. An empty table gives no rows.
    """
    sound = F.col("label").isNotNull() & usable(F.col("vector"))
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")
    )
    distinct = materialise(
        rows.where(sound)
        .groupBy("label", "vector")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.xxhash64("label", "vector")),
        "vectors",
    )
    reach = 2 - 2 * similarity + SLACK
    books = _fit(distinct, centres, fit_vectors)
    key = ["label", "width", "cell"]
    coded = materialise(
        distinct.withColumn("width", F.size("vector"))
        .withColumn("visits", _visits(books, reach)(F.col("vector")))
        .withColumn("cell", F.element_at("visits", 1)),
        "coded",
    )
    counts = block_counts(coded, key, tile)
    parted = with_part(coded, counts, key, F.col("node"))
    member = F.struct("node", "copies", "vector")
    tiles = materialise(
        parted.groupBy(*key, "part").agg(F.collect_list(member).alias("members")), "tiles"
    )
    callers = materialise(
        parted.select(*key, "part", "node", "copies", "vector", F.explode("visits").alias("to"))
        .where("`to` >= cell")
        .groupBy("label", "width", F.col("to").alias("cell"), F.col("cell").alias("from"), F.col("part").alias("from_part"))
        .agg(F.collect_list(member).alias("callers")),
        "callers",
    )
    met = callers.join(tiles, key).where("`from` <> cell or from_part <= part")
    links = materialise(
        met.select(
            "callers", "members", F.expr("`from` = cell and from_part = part").alias("same")
        ).mapInArrow(_compare(similarity), "one bigint, other bigint, n bigint"),
        "links",
    )
    groups = connected_components(links.where("one <> other"), "one", "other")
    linked = links.where("one = other").groupBy(F.col("one").alias("of")).agg(F.sum("n").alias("n"))
    rooted = (
        distinct.join(linked, F.col("node") == F.col("of"), "left")
        .select("label", "vector", "node", "id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
        .join(groups, "node", "left")
        .withColumn("root", F.coalesce("component", "node"))
    )
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = materialise(
        rooted.join(smallest, "root").select(
            F.col("label").alias("of_label"), F.col("vector").alias("of_vector"), "n_links", "component_id"
        ),
        "named",
    )
    key_of = (F.col("label") == F.col("of_label")) & (F.col("vector") == F.col("of_vector"))
    found = rows.withColumn("vector", F.when(sound, F.col("vector"))).join(named, key_of, "left")
    component = F.coalesce("component_id", "id")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _fit(distinct: DataFrame, centres: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the two halves, fitted on the driver on a bounded sample."""
    sample = bounded_sample(distinct, F.col("node"), most).select("vector").collect()
    width = max((len(r[0]) for r in sample), default=2)
    half = (width + 1) // 2
    points = matrix([r[0] for r in sample] or [[1.0, 0.0]], max(width, 2 * half))
    points = unit(points)
    return codebook(points[:, :half], centres), codebook(points[:, half:], centres)


def _visits(books: tuple[np.ndarray, np.ndarray], reach: float):
    """Cells that a vector visits, its own first."""

    @arrow_udf("array<int>")
    def visits(vectors: pa.Array) -> pa.Array:
        width, half = sum(b.shape[1] for b in books), books[0].shape[1]
        rows = vectors.to_pylist()
        points = unit(matrix(rows, max(width, *map(len, rows))))  # dropped ends only bring points nearer
        own_one, first = cell_bounds(points[:, :half], books[0])
        own_two, second = cell_bounds(points[:, half:width], books[1])
        out = []
        for a, b, one, two in zip(own_one, own_two, first, second, strict=True):
            own = int(a) * len(books[1]) + int(b)
            cells = [i * len(books[1]) + j for i, j in multi_sequence(one, two, reach)]
            out.append([own, *(c for c in cells if c != own)])
        return pa.array(out, pa.list_(pa.int32()))

    return visits


def _compare(similarity: float):
    """Links of callers with members: pairs that connect them, and a count per vector beside itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Gathered(["one", "other", "n"])
        for batch in batches:
            for callers, members, same in zip(*batch.columns, strict=True):
                node_a, copies_a, a = _members(callers.values)
                node_b, copies_b, b = _members(members.values)
                close = unit(a) @ unit(b).T >= similarity
                if same.as_py():
                    close &= node_a[:, None] < node_b[None, :]
                i, j = np.nonzero(close)
                if len(i):
                    nodes, place = np.unique(np.stack([node_a[i], node_b[j]]), return_inverse=True)
                    left, right = place.reshape(2, -1)
                    high, low = forest(left, right, len(nodes))
                    n = np.bincount(left, copies_b[j], len(nodes)) + np.bincount(right, copies_a[i], len(nodes))
                    out.add(nodes[high], nodes[low], np.zeros(len(high), np.int64))
                    out.add(nodes, nodes, n.astype(np.int64))
                    yield from out.take()
        yield from out.take(1)

    return run


def _members(values: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = values.field("vector")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return (
        values.field("node").to_numpy(),
        values.field("copies").to_numpy(),
        flat.reshape(len(values), -1),
    )
