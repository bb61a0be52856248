import math
import random
from collections import defaultdict

import numpy as np
import pytest

from changefeed.llm import neardup

VECTORS = "vec_id bigint, embedding array<float>, label int, node string, n_links string, kept string, cell string"


def plain_links(rows, union, least=0.98):
    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = defaultdict(int)
    by_label = defaultdict(list)
    for n, (_, vector, label) in enumerate(rows):
        union.find(n)
        if label is not None and sound(vector):
            by_label[label, len(vector)].append(n)
    for found in by_label.values():
        points = np.array([rows[n][1] for n in found], float)
        points /= np.linalg.norm(points, axis=1)[:, None]
        for i, j in zip(*np.nonzero(np.triu(points @ points.T >= least, 1)), strict=True):
            links[found[i]] += 1
            links[found[j]] += 1
            union.join(found[i], found[j])
    names = {}
    for n, (vec, *_) in enumerate(rows):
        if vec is not None:
            root = union.find(n)
            names[root] = min(vec, names.get(root, vec))
    out = []
    for n, (vec, *_) in enumerate(rows):
        name = names.get(union.find(n))
        out.append((vec, links[n], name, vec == name))
    return sorted(out, key=repr)


def run(vectors, **more):
    found = neardup.near_vectors(vectors, **more)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", None, "k", "c") for r in rows], VECTORS)


def near_copies(seed, groups, size, width):
    """Groups of vectors around the limit of similarity."""
    pick = random.Random(seed)
    rows = []
    for g in range(groups):
        centre = [pick.gauss(0, 1) for _ in range(width)]
        for _ in range(size):
            rows.append((len(rows), [x + pick.gauss(0, 0.12) for x in centre], g % 3))
    return rows


def test_embeddings(spark, sf_dir, union):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert run(vectors) == plain_links([tuple(r) for r in vectors.collect()], union)


@pytest.mark.parametrize(("width", "tile"), [(16, 8), (7, 512)])
def test_recall_is_one(spark, union, width, tile):
    vectors = frame(spark, near_copies(width, 12, 30, width))
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    want = plain_links(rows, union)
    assert sum(r[1] for r in want) > 500
    assert run(vectors, tile=tile) == want


def test_odd_vectors(spark, union):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, [2.0, 4.0], 1), (4, [1.0, 2.0], 2), (5, [1.0, 2.0], None), (6, None, 1),
        (7, [0.0, 0.0], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (12, [], 1),
        (13, [1.0], 1), (14, [1.0, 2.0, 0.0], 1), (2, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (15, [-0.0, 1.0], 1),
        (16, [0.0, 1.0], 1), (17, [1e30, 2e30], 1), (18, [1e-30, 2e-30], 1), (None, None, None),
    ]
    assert run(frame(spark, rows)) == plain_links(rows, union)


def test_empty(spark):
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(1, None, 1)])) == [(1, 0, 1, True)]


def test_cells_come_by_growing_bound():
    first, second = np.array([0.0, 0.03, 0.01, 0.2]), np.array([0.02, 0.0, 0.05])
    cells = neardup.multi_sequence(first, second, 0.04)
    bounds = [first[i] + second[j] for i, j in cells]
    assert bounds == sorted(bounds) and cells[0] == (0, 1)
    assert set(cells) == {(i, j) for i in range(4) for j in range(3) if first[i] + second[j] <= 0.04}
