import random

import pytest

from changefeed.llm.components import connected_components


def check(spark, union, edges, kind="bigint"):
    frame = spark.createDataFrame(edges, f"a {kind}, b {kind}")
    got = {r["node"]: r["component"] for r in connected_components(frame, "a", "b").collect()}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            union.join(a, b)
    assert got == {n: union.find(n) for n in union.up}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, union, seed):
    pick = random.Random(seed)
    check(spark, union, [(pick.randrange(80), pick.randrange(80)) for _ in range(50)])


def test_chain_star_and_odd_edges(spark, union):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    check(spark, union, [*chain, *star, (1, 1), (None, 5), (5, None), (3, 2), (2, 3), (3, 2)])


def test_texts_and_no_edges(spark, union):
    check(spark, union, [("b", "a"), ("c", "b"), ("x", "y")], "string")
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").isEmpty()
