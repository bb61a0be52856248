import random
from collections import Counter

import numpy as np
import pytest
from odd_inputs import prose

from changefeed.llm import copies

DOCS = "doc_id bigint, text string, bits string, node string, component string, one string"


def plain_groups(rows, union):
    """Groups by all pairs, and how many links there are."""
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets[doc] = frozenset(copies.shingle_set(text))
            union.find(doc)
    ids, links = sorted(sets), 0
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] == sets[b] or (shared and shared >= 0.8 * len(sets[a] | sets[b])):
                union.join(a, b)
                links += sets[a] != sets[b]
    return {doc: union.find(doc) for doc in ids}, links


def edited(text, seed, changes):
    words, pick = text.split(" "), random.Random(seed)
    for _ in range(changes):
        words[pick.randrange(len(words))] = "new" + str(pick.random())[2:8]
    return " ".join(words)


def family(first, seed, words, size):
    """A text and copies of it with some words changed, up to the limit of similarity."""
    base = prose(seed, words)
    return [(first + i, edited(base, i, i % (1 + words // 60))) for i in range(size)]


def got(docs, **more):
    return {r["doc_id"]: r["component_id"] for r in copies.near_copies(docs, **more).collect()}


@pytest.mark.parametrize("tile", [32, 8192])
def test_families(spark, union, tile):
    rows = [r for n, words in enumerate([60, 120, 300, 700]) for r in family(1000 * n, n, words, 60)]
    rows += [(9000 + i, prose(100 + i, 200)) for i in range(60)]
    random.Random(tile).shuffle(rows)
    docs = spark.createDataFrame([(*r, "b", None, "c", "o") for r in rows], DOCS)
    want, links = plain_groups(rows, union)
    assert links > 1000
    assert got(docs, tile=tile) == want


@pytest.mark.parametrize("tile", [128, 8192])
def test_large_family_of_weak_links(spark, union, tile):
    base = prose(7, 200)
    rows = [(i, edited(base, i, 3 + i % 4)) for i in range(900)]
    want, links = plain_groups(rows, union)
    assert links > 100 and len(set(want.values())) > 100
    docs = spark.createDataFrame([(*r, "b", None, "c", "o") for r in rows], DOCS)
    assert got(docs, tile=tile) == want


def test_radius_by_size():
    """Short texts and the same with a word more; none may be further apart than candidates are."""
    for size in (4, 5, 8, 12, 20, 40):
        for seed in range(1500):
            words = [f"w{seed}x{n}" for n in range(size + 5)]
            prints = [
                np.frombuffer(copies.wide_fingerprint(copies.shingle_set(" ".join(words[:n]))), np.uint64)
                for n in (size + 4, size + 5)
            ]
            assert np.bitwise_count(prints[0] ^ prints[1]).sum() <= copies.radius(size)


def test_radius_loses_few():
    for size in (4, 7, 12, 20, 33, 64, 200):
        other = int(size / 0.8)
        chance = copies.differing(size, other, size)
        draw = np.random.default_rng(size).binomial(256, chance, 1_000_000)
        assert (draw > copies.radius(size)).mean() < 1e-5
        assert copies.radius(size) < 90


def test_short_copies(spark, union):
    rows = [(2 * i + n, " ".join(f"w{i}x{m}" for m in range(8 + n))) for i in range(300) for n in (0, 1)]
    want = {doc: doc - doc % 2 for doc, _ in rows}
    docs = spark.createDataFrame([(*r, "b", None, "c", "o") for r in rows], DOCS)
    assert got(docs) == want


def test_documents(documents, union):
    want, _ = plain_groups([(r["doc_id"], r["text"]) for r in documents.collect()], union)
    assert got(documents) == want


def test_odd_rows(odd_docs, no_docs, union):
    want, _ = plain_groups([(r["doc_id"], r["text"]) for r in odd_docs.collect()], union)
    assert got(odd_docs) == want
    assert got(no_docs) == {}
    kept = copies.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == {**dict.fromkeys(set(want.values()), 1), None: 2}
    assert copies.keep_one(no_docs).collect() == []


def test_spanning_pairs_connect_all():
    draw = np.random.default_rng(2)
    left, right = draw.integers(0, 60, (2, 90))
    far = draw.integers(0, 50, 90).astype(np.uint8)
    label, all_label = np.arange(60), np.arange(60)
    picked = copies.spanning(left, right, far, label)
    again = np.arange(60)
    assert len(copies.spanning(left[picked], right[picked], far[picked], again)) == len(picked)
    copies.spanning(left, right, far, all_label)
    assert np.array_equal(again, all_label)
    assert len(copies.spanning(left, right, far, label)) == 0
