import itertools

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from changefeed.llm import language
from changefeed.llm.queries import op1_language_id


@pytest.fixture(scope="module")
def known():
    read = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = (i for i in range(len(read)) if not (read.is_control(i) or read.is_unknown(i) or read.is_byte(i)))
    return {read.id_to_piece(i): i for i in plain}


def segmentations(word, known):
    """All ways to cut a word into pieces of the vocabulary or single letters."""
    for cuts in itertools.product([False, True], repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate([*cuts, True], 1):
            if c:
                parts.append(word[start:i])
                start = i
        if all(p in known or len(p) == 1 for p in parts):
            yield [known.get(p, language.vocabulary(None).other) for p in parts]


@pytest.fixture(scope="module")
def model():
    size = language.vocabulary(None).size
    drawn = np.random.default_rng(1).random((size, 3))
    return language.Model(("a", "b", "c"), np.vstack([drawn / drawn.sum(0), np.zeros((1, 3))]), None)


@pytest.mark.parametrize("word", ["the", "nation", "über", "漢字x", "q", "théâtre"])
def test_forward_sums_all_segmentations(model, known, word):
    want = sum(np.prod(model.pieces[ids], axis=0) for ids in segmentations("▁" + word, known))
    assert np.allclose(model.word_scores(["other", word])[1], np.log(want))


def test_backward_agrees_with_forward(model):
    words = ["nation", "on", "x"]
    steps = model.pieces[language.vocabulary(None).lattice(words)][..., 0]
    ends = np.array([len(w) + 1 for w in words])
    total = language.forward(steps)[np.arange(3), ends]
    assert np.allclose(language.backward(steps, ends)[:, 0], total)


def test_remembered_words_score_alike(model, monkeypatch):
    texts = ["the nation of words", "die Nation", "une nation et des mots", None, "123 ! ½²", "x" * 500]
    once = language.Scorer(model)(texts)
    monkeypatch.setattr(language, "_CACHE", 0)
    scorer = language.Scorer(model)
    assert [scorer([t])[0] for t in texts] == once
    assert once[3] == once[4] == ("und", 0.0)


def test_held_out_documents(spark, sf_dir, documents):
    found = op1_language_id(spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == documents.count()
    held = [r for r in found if r["held_out"]]
    assert 0.1 < len(held) / len(found) < 0.3
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_odd_rows(odd_docs, no_docs):
    learned = language.train(odd_docs)
    assert learned.languages == ("en", "fr")
    found = language.identify(odd_docs, learned)
    assert found.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    for r in found.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] in (("en", "fr") if letters else ("und",))
        assert (r["score"] >= 0.5) == letters and r["score"] <= 1
    nothing = language.train(no_docs)
    assert nothing.languages == ()
    assert {(r["lang_pred"], r["score"]) for r in language.identify(odd_docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(no_docs, learned).collect() == []
