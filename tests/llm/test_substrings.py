import random
import re

import pytest
from odd_inputs import DOCS, prose

from changefeed.llm import queries, substrings

COLUMNS = ["doc_id", "start", "stop", "first_id", "first_start"]


def plain_runs(rows, least=50):
    """The same runs from all units of all documents in one dictionary."""
    hashes, order = substrings.WordHashes(), {}
    texts = {(doc, text) for doc, text in rows if text}
    units = {x: substrings.units_of(x[1], hashes) for x in texts}
    found = {x: [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"\S+", x[1])] for x in texts}
    first = {}
    for x in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        for u in units[x]:
            first.setdefault(u[4], (x, u))
    out = set()
    for x in texts:
        runs = []
        for u in units[x]:
            if first[u[4]] != (x, u):
                if runs and u[0] <= runs[-1][-1][1]:
                    runs[-1].append(u)
                else:
                    runs.append([u])
        for run in runs:
            (y, head), (z, tail) = first[run[0][4]], first[run[-1][4]]
            a, b, c, d = run[0][0], run[-1][1], head[0], tail[1]
            before = behind = 0
            while before < 32 and min(a, c) > before and found[x][a - before - 1][0] == found[y][c - before - 1][0]:
                before += 1
            while (
                behind < 32 and b + behind < len(found[x]) and d + behind < len(found[z])
                and found[x][b + behind][0] == found[z][d + behind][0]
            ):
                behind += 1
            if b - a + before + behind >= least:
                out.add((x[0], found[x][a - before][1], found[x][b + behind - 1][2], y[0], found[y][c - before][1]))
    return out


@pytest.mark.parametrize("name", ["odd_docs", "documents", "no_docs"])
@pytest.mark.parametrize("least", [50, 15])
def test_against_plain(request, name, least):
    docs = request.getfixturevalue(name)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = substrings.repeated_units(docs, least_words=least)
    assert got.columns == COLUMNS
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_runs(rows, least)


def test_query(spark, sf_dir, documents):
    found = queries.op6_substring_dedup(spark, sf_dir)
    assert {tuple(r) for r in found.collect()} == plain_runs([(r[0], r[1]) for r in documents.collect()])


def planted(spark, words, seed):
    """Texts of their own with one passage in each, inside a line, at any offset."""
    pick, passage = random.Random(seed), prose(1000 + seed, words)
    rows = []
    for i in range(12):
        own = prose(2000 + 50 * seed + i, pick.randint(5, 90)).split()
        at = pick.randint(0, len(own))
        rows.append((i, " ".join([*own[:at], *passage.split(), *own[at:]]), " ".join(own)))
    return spark.createDataFrame([(i, t, *([None] * 13)) for i, t, _ in rows], DOCS), passage, rows


@pytest.mark.parametrize("seed", range(3))
def test_passages_inside_lines_are_cut_to_the_word(spark, seed):
    docs, passage, rows = planted(spark, 51, seed)
    texts = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(docs).collect()}
    assert texts[0] == rows[0][1]
    for i, _, own in rows[1:]:
        assert " ".join(texts[i].split()) == own
    assert passage in texts[0]


def test_short_repeats_stay(spark):
    docs, _, rows = planted(spark, 40, 9)
    assert {r["text"] for r in substrings.remove_repeats(docs).collect()} == {r[1] for r in rows}


def test_whole_copies_and_lines(spark):
    one, line = prose(1, 300), prose(2, 70)
    rows = [(3, one), (1, one), (2, f"{prose(3, 30)}\n{line}\n{prose(4, 30)}"), (5, f"{prose(5, 30)}\n{line}\nend"), (5, one), (None, one)]
    got = substrings.remove_repeats(spark.createDataFrame([(i, t, *([None] * 13)) for i, t in rows], DOCS))
    texts = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    want = [(3, ""), (1, one), rows[2], (5, f"{prose(5, 30)}\nend"), (5, ""), (None, "")]
    assert texts == sorted(want, key=repr)


def test_nothing_is_lost_but_spans(odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        got = substrings.remove_repeats(docs)
        assert got.columns == docs.columns and got.count() == docs.count()
        kept = {r["text"] for r in got.collect()}
        assert all(t is None or not t or any(t in (r["text"] or "") or len(t) < len(r["text"] or "") for r in docs.collect()) for t in kept)


def test_parts_do_not_grow_without_bound():
    text = "same " * 1000
    units = substrings.units_of(text, substrings.WordHashes())
    assert units and max(last - first for first, last, *_ in units) <= 64
