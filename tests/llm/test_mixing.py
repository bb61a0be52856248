import hashlib
import re
from collections import defaultdict

import pytest

from changefeed.llm import mixing


def plain_targets(totals):
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, target = sum(totals.values()), {}
    while len(target) < len(order):
        open_ = [s for s in order if s not in target]
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * left / share >= 3 * totals[s]]
        if not over:
            target |= {s: weight[s] * left / share for s in open_}
        for s in over:
            target[s] = 3.0 * totals[s]
        left -= sum(3 * totals[s] for s in over)
    return target


def plain_mix(docs):
    rows = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs]
    totals = defaultdict(int)
    for _, source, size in rows:
        totals[source] += size
    target = plain_targets(totals)
    out = []
    for source, total in totals.items():
        by_hash = defaultdict(list)
        for doc, of, size in rows:
            if of == source:
                by_hash[hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()[:9]].append((doc, size))
        full = int(target[source] // total) if total else 0
        rest = target[source] - full * total
        for key in sorted(by_hash):
            inside = sum(size for _, size in by_hash[key])
            part = 1.0 if inside <= rest else max(rest, 0) / inside
            for doc, size in by_hash[key]:
                extra = size if part == 1 else int(size * part)
                out.append((doc, size, total, round(target[source], 6), full * size + extra))
            rest = rest - inside if part == 1 else 0
    return sorted(out, key=repr)


def compared(frame):
    return sorted(
        ((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in frame.collect()), key=repr
    )


def near(got, want):
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert all(abs(a[4] - b[4]) <= 1 for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("name", ["odd_docs", "documents"])
def test_against_sorting(request, name):
    docs = request.getfixturevalue(name)
    got = mixing.mix(docs)
    near(compared(got), plain_mix(docs.collect()))
    assert compared(got) == compared(mixing.mix(docs.repartition(7)))


def test_targets_are_met(documents):
    taken, target = defaultdict(int), {}
    for r in mixing.mix(documents).join(documents.select("doc_id", "source"), "doc_id").collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)


def test_bounds_pass_on_what_is_left(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 1), ("b", 2), ("c", 3), ("d", 500), (None, 94)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    near(compared(mixing.mix(docs)), plain_mix(docs.collect()))


def test_empty_and_wordless(spark, no_docs):
    assert mixing.mix(no_docs).collect() == []
    assert mixing.repeat_mixed(no_docs).collect() == []
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert {tuple(r) for r in mixing.mix(docs).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_rows_come_as_often_as_taken(documents, odd_docs):
    times = defaultdict(int)
    for r in mixing.repeat_mixed(documents).collect():
        times[r["doc_id"]] += 1
    for r in mixing.mix(documents).collect():
        assert times[r["doc_id"]] == (int(r["taken"] / r["size"] + 0.5) if r["size"] else 0)
    assert mixing.repeat_mixed(odd_docs).columns == odd_docs.columns
