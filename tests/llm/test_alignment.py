import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from odd_inputs import DOCS, prose
from tokenizers import Tokenizer

from changefeed.llm import alignment, queries

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in plain]
    letters |= {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(others)}

    def tokens(text):
        if not text:
            return [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]
        other = [
            (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
            for i in b.encode(text)
        ]
        raw = (" " + text).encode()
        if b"".join(x for _, x in one) != raw or b"".join(x for _, x in other) != raw:
            return [], []
        return one, other

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, piece in tokens:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def plain_rows(rows, sides):
    """Links and groups of every document straight from byte offsets."""
    found, counts = [], Counter()
    for doc, text in rows:
        a, b = map(spans, sides(text))
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        by_end = {}
        for i, _, e in b:
            by_end.setdefault(e, []).append(i)
        links = [(i, j) for i, _, e in a for j in by_end.get(e, ())]
        shown, start, x, y = [], 0, 0, 0
        for end in ends:
            left, right = [], []
            while x < len(a) and a[x][2] <= end:
                left.append(str(a[x][0]))
                x += 1
            while y < len(b) and b[y][2] <= end:
                right.append(str(b[y][0]))
                y += 1
            shown.append(",".join(left) + "|" + ",".join(right))
            start = end
        counts.update(links)
        digest = hashlib.sha256(";".join(shown).encode()).hexdigest() if a else ""
        found.append((doc, len(a), len(b), len(ends), links, digest))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (doc, n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for doc, n_a, n_b, n_groups, links, digest in found
    ]


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_query(spark, sf_dir, documents, sides):
    found = queries.op11_alignment(spark, sf_dir)
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain_rows(rows_of(documents), sides))


@pytest.mark.parametrize("pairs, rows", [(250_000, 20_000), (5, 3)])
def test_odd_rows(odd_docs, sides, pairs, rows):
    found = alignment.align_tokenizers(odd_docs, block_pairs=pairs, block_rows=rows)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == sorted(plain_rows(rows_of(odd_docs), sides), key=repr)


def test_hard_texts(spark, sides):
    texts = [
        "a<|endoftext|>b", "<s> x </s><unk>", "<0x41>", "▁ mark", "tab\tand\n\nlines  two", "漢字かな交じり文", "😀😀 é", "ﬁ ① ｆｕｌｌ",
        "\x00\x01", "x" * 3000, " lead", "trail ", "   ", prose(4, 300), "don't we'll", "   ",
    ]
    docs = spark.createDataFrame([(i, t, *([None] * 13)) for i, t in enumerate(texts)], DOCS)
    found = sorted(tuple(r) for r in alignment.align_tokenizers(docs).collect())
    assert found == sorted(plain_rows(list(enumerate(texts)), sides))
    assert found[3][1:] == (0, 0, 0, 0, 0, 0, "")


def test_empty(no_docs):
    found = alignment.align_tokenizers(no_docs)
    assert found.columns == COLUMNS and found.collect() == []


def test_only_texts_without_tokens(spark):
    docs = spark.createDataFrame([(i, t, *([None] * 13)) for i, t in enumerate([None, "", "▁"])], DOCS)
    assert sorted(tuple(r) for r in alignment.align_tokenizers(docs).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in range(3)]


def test_windows_are_remembered_and_forgotten(sides, monkeypatch):
    monkeypatch.setattr(alignment, "_KNOWN", 4)
    found = alignment.Aligner(alignment.aligner().a, alignment.aligner().b)
    for _ in range(2):
        for seed in range(5):
            text = prose(seed, 50)
            n_a, n_b, shown, links = found.align(text)
            want = plain_rows([(0, text)], sides)[0]
            assert (n_a, n_b, len(links), len(links)) == want[1:5]
            assert hashlib.sha256(shown.encode()).hexdigest() == want[-1]
    assert 0 < len(found.windows) < 100
