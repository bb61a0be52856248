import math
from fractions import Fraction

import numpy as np
import pytest

from changefeed.llm import queries, whitening
from changefeed.llm.eigen import leading_pairs

VECTORS = "vec_id bigint, embedding array<double>, label int, id string, component string, n string, white string"
EXTRA = (1, "i", None, "n", "w")
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows, components=8):
    """The same by exact sums and numpy's own solver."""
    kept = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows]
    n, width = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(width)]
    centred = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(width)] for _, x in kept])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * x[d] - sums[d]) ** 2 for d in range(width)) for _, x in kept]
    return kept, centred @ axes / np.sqrt(values), deviation, values / np.trace(centred.T @ centred / n)


def compare(found, rows, components=8):
    kept, white, deviation, explained = plain(rows, components)
    got = sorted((r["vec_id"], r["component"], r) for r in found.collect())
    want = sorted((i, k + 1, at) for at, (i, _) in enumerate(kept) for k in range(white.shape[1]))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    signs = {}
    for (_, k, r), (_, _, at) in zip(got, want, strict=True):
        assert r["n"] == len(kept) and r["deviation"] == deviation[at]
        assert math.isclose(r["explained"], explained[k - 1], rel_tol=1e-9)
        assert r["identity_error"] < 1e-8
        if abs(white[at, k - 1]) > 1e-6:
            signs.setdefault(k, set()).add(np.sign(r["whitened"] * white[at, k - 1]))
        assert math.isclose(abs(r["whitened"]), abs(white[at, k - 1]), rel_tol=1e-6, abs_tol=1e-7)
    assert all(len(s) == 1 for s in signs.values())


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.op12_whitening(spark, sf_dir)
    assert found.columns == COLUMNS
    assert dict(found.dtypes)["deviation"] == "bigint"
    compare(found, rows)


def test_few_dimensions(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(x) for x in pick.normal(0, 3, 3) * (1, 5, 20)]) for i in range(200)]
    compare(whitening.whiten(spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS)), rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    sound = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (2, [3.0, -1.0]), (3, [0.0, 0.0]), (9, [5.5, 1e6])]
    odd = [(4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, []), (10, [1.0]), (11, [1e300, 0.0])]
    table = spark.createDataFrame([(*r, *EXTRA) for r in sound + odd], VECTORS)
    found = whitening.whiten(table).collect()
    assert sorted((r["vec_id"], r["component"]) for r in found) == sorted((i, k) for i, _ in sound for k in (1, 2))
    assert {r["n"] for r in found} == {5}


def test_null_ids_stay(spark):
    rows = [(None, [1.0, 2.0]), (None, [2.0, 1.0]), (1, [4.0, 4.5])]
    found = whitening.whiten(spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS)).collect()
    assert sorted(r["component"] for r in found if r["vec_id"] is None) == [1, 1, 2, 2]


def test_very_large_entries_are_exact(spark):
    rows = [(1, [2.0**51, 1.0]), (2, [-(2.0**51), 3.0]), (3, [7.0, 2.0**50])]
    found = whitening.whiten(spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS)).collect()
    want = dict(zip((1, 2, 3), plain(rows, 2)[2], strict=True))
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == want


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]])
def test_nothing_varies(spark, rows):
    found = whitening.whiten(spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS))
    assert found.columns == COLUMNS and found.collect() == []


def test_flat_dimensions_have_no_component(spark):
    rows = [(i, [float(i), 1.0, 2.0 * i]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame([(*r, *EXTRA) for r in rows], VECTORS)).collect()
    assert {r["component"] for r in found} == {1}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["any", "equal", "zero", "low rank", "clusters", "blocks"])
def test_eigenpairs(n, kind):
    pick = np.random.default_rng(n)
    a = pick.standard_normal((n, n))
    turn = np.linalg.qr(a)[0]
    matrix = {
        "any": a @ a.T,
        "equal": 3 * np.eye(n),
        "zero": np.zeros((n, n)),
        "low rank": np.outer(a[0], a[0]),
        "clusters": turn @ np.diag(1 + 1e-10 * (np.arange(n) // 2)) @ turn.T,
        "blocks": np.diag(np.arange(n) // 3 + 0.0),
    }[kind]
    values, vectors = leading_pairs(matrix, 8)
    size = max(np.abs(matrix).max(), 1)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:8]).max() < 1e-13 * size * n
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * size * n
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13 * n
