import random
import re

import pytest
from odd_inputs import prose

from changefeed.llm import licenses

DOCS = "doc_id bigint, text string, license string, grams string, band int"


def grams(text):
    words = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def plain_scan(docs, notices=licenses.NOTICES):
    out = set()
    for doc, text in docs:
        found = grams(text)
        count = len(re.sub(r"[\W_]+", " ", (text or "").lower()).split())
        for name, notice in notices:
            want = set(grams(notice))
            window, stride = licenses.WINDOW, licenses.STRIDE
            while window - stride < len(re.sub(r"[\W_]+", " ", notice).split()):
                window, stride = 2 * window, 2 * stride
            shares = [
                (len(want & set(found[at : at + window - 4])) / len(want), -at)
                for at in range(0, len(found), stride)
            ]
            best = max(shares, default=(0, 0))
            if best[0] >= 0.8:
                end = min(window - best[1], count) - 1
                out.add((doc, name, round(best[0], 9), -best[1], end))
    return out


def compared(found):
    assert found.columns == ["doc_id", "license", "containment", "first_word", "last_word"]
    return sorted((r[0], r[1], round(r[2], 9), r[3], r[4]) for r in found.collect())


def test_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert compared(licenses.scan_licenses(documents)) == sorted(plain_scan(rows))


def test_notices_anywhere(spark):
    notices = dict(licenses.NOTICES)
    rows = []
    for i, (_, notice) in enumerate(licenses.NOTICES):
        for at in range(0, 26, 3):
            rows.append((len(rows), f"{prose(i, at)}\n{notice.upper()}  {prose(i + 50, 40)}"))
    damaged = notices["mit-text"].replace("charge", "cost").replace("software", "program")
    rows += [
        (1000, notices["mit-text"].replace("documentation", "other")),
        (1001, damaged),
        (1002, prose(3, 20_000) + " " + notices["mit"] + " " + notices["gpl-3.0"]),
        (1003, None), (1004, ""), (1005, "Released under the MIT"), (1006, "Released, under (the) mit LICENSE"),
        (1006, "Released, under (the) mit LICENSE"), (1007, "... !!!"),
    ]
    docs = spark.createDataFrame([(*r, "x", None, 4) for r in rows], DOCS)
    got = compared(licenses.scan_licenses(docs))
    assert got == sorted(plain_scan(rows))
    assert {r[0] for r in got} >= {*range(len(rows) - 9), 1000, 1002, 1006}
    assert not {r[0] for r in got} & {1001, 1003, 1004, 1005, 1007}


@pytest.mark.parametrize("name", ["odd_docs", "no_docs"])
def test_odd_inputs(request, name):
    assert licenses.scan_licenses(request.getfixturevalue(name)).collect() == []


def test_long_notices_anywhere(spark):
    # Notices of 5 to 700 words, whole and with some words changed, at any start.
    rng = random.Random(2)
    notices = [(f"n{n}", " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))) for n in (5, 20, 21, 40, 41, 170, 700)]
    rows = []
    for i, (_, notice) in enumerate(notices):
        for at in (0, 1, 7, 23, 24, 400):
            rows.append((len(rows), f"{prose(i, at)} {notice} {prose(i + 9, 30 if at % 2 else 0)}"))
    whole = len(rows)
    words = notices[-1][1].split()
    rows.append((1000, " ".join(w if i % 60 else "x" for i, w in enumerate(words))))
    rows.append((1001, " ".join(w if i % 10 else "x" for i, w in enumerate(words))))
    rows.append((1002, " ".join(words[:400])))
    docs = spark.createDataFrame([(*r, "x", None, 4) for r in rows], DOCS)
    got = compared(licenses.scan_licenses(docs, notices))
    assert got == sorted(plain_scan(rows, notices))
    assert {r[0] for r in got} == {*range(whole), 1000}
    texts = dict(rows)
    assert all(r[4] < len(texts[r[0]].split()) for r in got)


def test_notices_that_are_too_short_or_none(spark):
    docs = spark.createDataFrame([(1, "one two three four five", "x", None, 4)], DOCS)
    with pytest.raises(ValueError, match="brief"):
        licenses.scan_licenses(docs, [("brief", "one two three four")])
    assert licenses.scan_licenses(docs, []).collect() == []
    twice = [("n", "one two three four five"), ("n", "one two three four five")]
    assert compared(licenses.scan_licenses(docs, twice)) == [(1, "n", 1.0, 0, 4)]
