import math
import random

import pytest

from changefeed.llm import topk

VECTORS = "vec_id bigint, embedding array<float>, label int, score string, id string, rank string"


def plain_top(rows, queries, k=5):
    def whole(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            return None
        return [math.floor(256 * x) for x in vector]

    known = [(i, whole(v)) for i, v in rows if i is not None]
    known = [(i, v) for i, v in known if v is not None]
    out = []
    for q, vector in {i: v for i, v in known if queries(i)}.items():
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=False)), i) for i, v in known if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(vectors, queries, **more):
    found = topk.top_products(vectors, vectors.where(queries), **more)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_embeddings(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert run(vectors, "vec_id % 50 = 0") == plain_top(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("block", [16, 2048])
def test_clusters_of_any_length(spark, block):
    pick = random.Random(block)
    rows = []
    for c in range(12):
        centre = [pick.uniform(-1, 1) * 2 ** (c % 4) for _ in range(8)]
        rows += [(100 * c + i, [x + pick.gauss(0, 0.02) for x in centre]) for i in range(40)]
    rows += [(5000 + i, rows[3][1]) for i in range(60)]
    vectors = spark.createDataFrame([(*r, 1, "s", None, "r") for r in rows], VECTORS)
    read = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = run(vectors, "vec_id % 20 = 0", block=block, query_block=block // 4)
    assert got == plain_top(read, lambda i: i % 20 == 0)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.0, 0.0]), (6, []), (7, [1.0]),
        (8, [1.0, 2.0, 3.0]), (0, [1.0, 2.0]), (None, [9.0, 9.0]), (20, None), (40, [-1.0, -1.0]),
    ]
    vectors = spark.createDataFrame([(*r, 1, None, "x", None) for r in rows], VECTORS)
    assert run(vectors, "vec_id % 20 = 0") == plain_top(rows, lambda i: i % 20 == 0)


def test_very_large_components_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e200, 1.0]), (2, [2.0**20, 0.0]), (3, [-5.0, 2.0]), (20, [1e18, 1e18])]
    vectors = spark.createDataFrame([(*r, 1, None, "x", None) for r in rows], VECTORS)
    kept = [r for r in rows if r[0] in (0, 3)]
    assert run(vectors, "vec_id % 20 = 0") == plain_top(kept, lambda i: i % 20 == 0)


def test_empty(spark):
    assert run(spark.createDataFrame([], VECTORS), "true") == []
    one = spark.createDataFrame([(1, [1.0], 1, None, None, None)], VECTORS)
    assert run(one, "true") == []
