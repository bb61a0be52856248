import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd_inputs import prose
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from changefeed.llm import packing


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(docs, plain):
    want = [(r["doc_id"], tuple(plain(r["text"]))) for r in docs.collect()]
    rows = packing.pack(docs).collect()
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], ids))
    for placed in by_sequence.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert sum(n for _, n in placed) <= 1024
    got = defaultdict(int)
    for doc, ids in want:
        got[doc, len(ids)] += 1
    for (doc, total), found in pieces.items():
        copies = got[doc, total]
        found.sort()
        joined = [x for _, ids in found[::copies] for x in ids]
        assert (doc, tuple(joined)) in want and len(joined) == total
        assert sum(len(ids) for _, ids in found) == copies * total
    assert got.keys() == pieces.keys()


def test_odd_rows(odd_docs, plain):
    check(odd_docs, plain)


def test_documents(documents, plain):
    check(documents.limit(60), plain)


def test_empty(no_docs):
    assert packing.pack(no_docs).collect() == []


def test_capacity(odd_docs):
    with pytest.raises(ValueError):
        packing.pack(odd_docs, capacity=1000)
    assert max(r["length"] for r in packing.pack(odd_docs, capacity=64).collect()) == 64


def test_pieces():
    for length in [*range(1, 3000), 5000, 8192]:
        found = packing.pieces(length)
        assert sum(found) == length and all(0 < p <= 1024 for p in found)
        # Little padding, few pieces, and no sliver cut off.
        waste = sum(1024 / (1024 // p) - p for p in found)
        assert waste <= 24 and len(found) <= length // 1024 + 4
        assert len(found) == 1 or min(found) >= 8


def test_cuts_cost_least():
    part = [0, *(64 / (64 // s) - s + packing.PIECE_COST + max(packing.LEAST_PIECE - s, 0) for s in range(1, 65))]

    def least(length):
        best = {0: 0.0}
        for n in range(1, length + 1):
            best[n] = min(part[s] + best[n - s] for s in range(1, min(n, 64) + 1))
        return best[length]

    for length in range(65, 128):
        assert np.isclose(sum(part[s] for s in packing.pieces(length, 64)), least(length))


def test_classes_hold_a_fixed_count(spark, plain):
    texts = [(i, prose(i, 20 + 37 * i % 900)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    check(docs, plain)
    sequences = defaultdict(list)
    for r in packing.pack(docs).collect():
        sequences[r["sequence_id"]].append(r["length"])
    full = [found for found in sequences.values() if {1024 // n for n in found} == {len(found)}]
    assert len(full) >= 0.5 * len(sequences)
    padding = sum(1024 - sum(found) for found in sequences.values())
    assert padding <= 0.03 * 1024 * len(sequences)


def test_first_fit():
    held = [("d", 0, n) for n in [5, 3, 8, 1, 4, 2]]
    assert [[p[2] for p in found] for found in packing.first_fit(held, 8)] == [[8], [5, 3], [4, 2, 1]]
    assert packing.first_fit([], 8) == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_has_the_ids_of_tokenizers(plain, text):
    assert [*packing.encoder(None).ids(text), 0] == plain(text)


@pytest.mark.parametrize(
    "text",
    ["a<|endoftext|>b", " " * 100_000 + "x", "\n" * 3000, "x" * 100_000, "é" * 20_000, "don't I'LL  \t 12,000", "'s 're"],
)
def test_hard_texts(plain, text):
    assert [*packing.encoder(None).ids(text), 0] == plain(text)


def test_latin_letters_have_the_ids_of_tokenizers(plain):
    pick = random.Random(5)
    letters = [chr(c) for c in range(0x250)]
    for _ in range(300):
        text = "".join(pick.choices(letters, k=80))
        assert [*packing.encoder(None).ids(text), 0] == plain(text)


def test_crc_of_the_ids(odd_docs, spark, sf_dir):
    from changefeed.llm.queries import op9_packing

    ids = {(r["doc_id"], r["start"]): r["ids"] for r in packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    for r in op9_packing(spark, sf_dir).collect():
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"], r["start"]])
    assert prose(1, 2)
