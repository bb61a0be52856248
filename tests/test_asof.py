"""The as-of join against a search through all entries."""

import random
from datetime import datetime, timedelta

import pytest

from changefeed.operators.asof import asof_join

ROWS = "k string, n int, at timestamp"
ENTRIES = "k string, since timestamp, value string"
START = datetime(2024, 1, 1)


def at(second):
    return None if second is None else START + timedelta(seconds=second)


def frames(spark, rows, entries):
    made = [(k, n, at(t)) for n, (k, t) in enumerate(rows)]
    return spark.createDataFrame(made, ROWS), spark.createDataFrame([(k, at(t), v) for k, t, v in entries], ENTRIES)


def expected(rows, entries):
    found = {}
    for n, (k, t) in enumerate(rows):
        fit = [(s, v) for key, s, v in entries if None not in (k, t, s) and key == k and s <= t]
        found[n] = max(fit)[1] if fit else None
    return found


@pytest.mark.parametrize("seed, rows_per_part", [(1, 1_000), (2, 3)])
def test_against_search(spark, seed, rows_per_part):
    # A third of the rows have one key, many of them in one bucket; times repeat.
    rng = random.Random(seed)
    keys = ["hot", "hot", "a", "b", "c", None]
    rows = [(rng.choice(keys), rng.choice([rng.randrange(5_000), 77, None])) for _ in range(400)]
    entries = [(rng.choice(keys), rng.choice([rng.randrange(5_000), 77, None]), f"v{i:03d}") for i in range(60)]
    left, right = frames(spark, rows, entries)
    found = asof_join(left, right, ["k"], "at", "since", 60, rows_per_part).collect()
    assert len(found) == len(rows)
    assert {r["n"]: r["value"] for r in found} == expected(rows, entries)


def test_carried_over_many_buckets(spark):
    rows = [("a", t) for t in (0, 99, 100, 9_999, -5_000)] + [("a", 100)]
    left, right = frames(spark, rows, [("a", 100, "x"), ("a", 200, "y"), ("a", 200, "z")])
    found = {r["n"]: r["value"] for r in asof_join(left, right, ["k"], "at", "since", 10, 1).collect()}
    assert found == {0: None, 1: None, 2: "x", 3: "z", 4: None, 5: "x"}


def test_repeated_rows_and_empty_sides(spark):
    left, right = frames(spark, [("a", 5), ("a", 5)], [("a", 1, "x")])
    same = left.selectExpr("k", "1 AS n", "at")
    assert [r["value"] for r in asof_join(same, right, ["k"], "at", "since", 60, 1).collect()] == ["x", "x"]
    assert [r["value"] for r in asof_join(left, right.limit(0), ["k"], "at", "since", 60).collect()] == [None, None]
    assert asof_join(left.limit(0), right, ["k"], "at", "since", 60).collect() == []


def test_clashing_names_fail(spark):
    left, right = frames(spark, [("a", 5)], [("a", 1, "x")])
    with pytest.raises(ValueError, match="value"):
        asof_join(left.selectExpr("*", "'v' AS value"), right, ["k"], "at", "since", 60)
