"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from changefeed.llm.blocks import hash_share
from changefeed.storage import materialise

VOCABULARY = "piece_bpe_32k.model"
UNKNOWN = "und"
#: Documents per language that the piece probabilities are learned from, about.
FIT_DOCS = 1_500
ROUNDS = 3
SMOOTHING = 0.1
#: Letters of a word that are scored together; longer runs are cut.
CHUNK = 24
_WORDS = re.compile(r"[^\W\d_]+")
_START = "▁"
_LETTER_BITS = 21
_GROUP = 256  # documents scored together
_CACHE = 300_000  # words a worker remembers
_vocabularies: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Pieces of a public vocabulary file as a trie, kept as sorted arrays.

    A branch is known by its node and letter, joined in one number.
    """

    def __init__(self, path: str) -> None:
        known = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = known.get_piece_size() + 1
        self.other = self.size - 1  # any single letter that is no piece
        nodes, branches, pieces = {"": 0}, [], [-1]
        for i in range(known.get_piece_size()):
            if not (known.is_control(i) or known.is_unknown(i) or known.is_byte(i)):
                piece = known.id_to_piece(i)
                for end in range(1, len(piece) + 1):
                    if piece[:end] not in nodes:
                        nodes[piece[:end]] = len(nodes)
                        branches.append((nodes[piece[: end - 1]] << _LETTER_BITS | ord(piece[end - 1]), nodes[piece[:end]]))
                        pieces.append(-1)
                pieces[nodes[piece]] = i
        branches.sort()
        self.branches = np.array([b for b, _ in branches], np.int64)
        self.nodes = np.array([n for _, n in branches], np.int64)
        self.pieces = np.array(pieces, np.int32)

    def lattice(self, words: Sequence[str]) -> np.ndarray:
        """Piece ids by word, end and length less one; -1 where there is no piece.

        All starts in all words go down the trie together, letter by letter.
        """
        marked = [_START + w for w in words]
        sizes = np.array([len(w) for w in marked], np.int64)
        letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.arange(len(letters))
        start, last = at - first, first + np.repeat(sizes, sizes)
        node, found, size = np.zeros(len(letters), np.int64), [], 0
        while len(at):
            key = node << _LETTER_BITS | letters[at + size]
            branch = np.minimum(np.searchsorted(self.branches, key), len(self.branches) - 1)
            there = self.branches[branch] == key
            piece = np.where(there, self.pieces[self.nodes[branch]], -1)
            if not size:
                piece[piece < 0] = self.other
            hit = piece >= 0
            found.append((word[hit], start[hit] + size + 1, size, piece[hit]))
            size += 1
            on = there & (at + size < last)
            at, last, word, start, node = at[on], last[on], word[on], start[on], self.nodes[branch[on]]
        ids = np.full((len(words), int(sizes.max(initial=0)) + 1, max(1, size)), -1, np.int32)
        for of, end, length, piece in found:
            ids[of, end, length] = piece
        return ids


def vocabulary(path: str | None) -> Vocabulary:
    """The vocabulary of a file, once per process; None: the public default."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def chunks(text: str) -> list[str]:
    """Lower-cased runs of letters, none longer than a chunk."""
    found = _WORDS.findall(text.lower())
    if not any(map(str.isalpha, found)) and not any(map(str.isalpha, "".join(found))):
        return []  # number signs that are no digits look like letters to the pattern
    if any(len(w) > CHUNK for w in found):
        found = [w[i : i + CHUNK] for w in found for i in range(0, len(w), CHUNK)]
    return found


def forward(steps: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of what stands before each end.

    ``steps`` has the probability of the piece by word, end, length less one, and
    whatever axes follow; 0 where there is none.
    """
    total = np.zeros(steps.shape[:2] + steps.shape[3:])
    total[:, 0] = 1
    for end in range(1, steps.shape[1]):
        for size in range(1, min(end, steps.shape[2]) + 1):
            total[:, end] += total[:, end - size] * steps[:, end, size - 1]
    return total


def backward(steps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of what follows each place, up to the word's end."""
    total = np.zeros(steps.shape[:2])
    total[np.arange(len(ends)), ends] = 1
    for place in range(steps.shape[1] - 2, -1, -1):
        for size in range(1, min(steps.shape[1] - 1 - place, steps.shape[2]) + 1):
            total[:, place] += steps[:, place + size, size - 1] * total[:, place + size]
    return total


@dataclass(frozen=True)
class Model:
    """Probabilities by piece and language; the last row of ``pieces`` is zero."""

    languages: tuple[str, ...]
    pieces: np.ndarray
    path: str | None
    key: str = field(default_factory=lambda: uuid.uuid4().hex)  # what workers remember it by

    def word_scores(self, words: Sequence[str]) -> np.ndarray:
        """Log probability of each word in each language, over all segmentations."""
        ids = vocabulary(self.path).lattice(words)
        ends = np.array([len(w) + 1 for w in words])
        with np.errstate(divide="ignore"):
            return np.log(forward(self.pieces[ids])[np.arange(len(words)), ends])


class Scorer:
    """Scores texts, remembering the words it has seen."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def __call__(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        split = [chunks(t) if t else [] for t in texts]
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(split)
        if len(self.known) > _CACHE:
            self.known, self.scores = {}, self.scores[:0]
        fresh = [w for w in set().union(*split) if w not in self.known]
        fresh.sort(key=len)
        parts = [self.model.word_scores(fresh[i : i + 2048]) for i in range(0, len(fresh), 2048)]
        self.known |= {w: len(self.known) + i for i, w in enumerate(fresh)}
        self.scores = np.concatenate([self.scores, *parts])
        out = []
        for found in split:
            if not found:
                out.append((UNKNOWN, 0.0))
                continue
            rows = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
            total = self.scores[rows].sum(0)
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


_scorers: dict[str, Scorer] = {}


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fit_docs: int = FIT_DOCS,
    rounds: int = ROUNDS,
    path: str | None = None,
) -> Model:
    """Learns the probabilities of the pieces of each language.

    Expectation and maximisation over about ``fit_docs`` documents a language,
    chosen by hash of the id. Tasks add up expected counts of their words; what
    comes to the driver is a number per piece and language. Null texts and null
    languages are left out. No document gives a model without languages.
    """
    usable = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.zeros((vocabulary(path).size + 1, 0)), path)
    place = {lang: i for i, lang in enumerate(languages)}
    shares = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, fit_docs / counts[lang]))))
    numbers = F.create_map(*(F.lit(x) for lang in languages for x in (lang, place[lang])))
    chosen = usable.where(hash_share(F.col("id")) < shares[F.col("lang")]).select(
        numbers[F.col("lang")].alias("lang"), "text"
    )

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                word, n = np.unique(np.array(chunks(text), object), return_counts=True)
                yield pd.DataFrame({"lang": np.full(len(word), lang, np.int32), "word": word, "n": n})

    words = materialise(
        chosen.mapInPandas(split, "lang int, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "words",
    )
    size = vocabulary(path).size
    pieces = np.full((size + 1, len(languages)), 1 / size)
    pieces[-1] = 0
    for _ in range(rounds):
        expected = _expected(words, pieces, path).groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        learned = np.full((size, len(languages)), SMOOTHING)
        learned[expected["piece"], expected["lang"]] += expected["n"]
        pieces = np.vstack([learned / learned.sum(0), np.zeros((1, len(languages)))])
    return Model(languages, pieces, path)


def _expected(words: DataFrame, pieces: np.ndarray, path: str | None) -> DataFrame:
    """Expected number of each piece in each language, by task: ``piece, lang, n``."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(pieces.shape)
        for frame in frames:
            for at in range(0, len(frame), 2048):
                part = frame.iloc[at : at + 2048]
                ids = vocabulary(path).lattice(part["word"].tolist())
                lang = part["lang"].to_numpy()
                steps = pieces[ids, lang[:, None, None]]
                ends = part["word"].str.len().to_numpy() + 1
                before, after = forward(steps), backward(steps, ends)
                weight = part["n"].to_numpy() / before[np.arange(len(ends)), ends]
                for size in range(1, steps.shape[2] + 1):
                    share = before[:, :-size] * steps[:, size:, size - 1] * after[:, size:] * weight[:, None]
                    row, end = np.nonzero(share)
                    np.add.at(total, (ids[row, end + size, size - 1], lang[row]), share[row, end])
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece.astype("int32"), "lang": lang.astype("int32"), "n": total[piece, lang]})

    return words.mapInPandas(count, "piece int, lang int, n double")


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    A text's probability in a language is the product over its words, each summed
    over all ways to cut it into pieces by a forward pass; languages are equally
    likely beforehand. ``score`` is the share of the best one. Of equals the first
    by name wins. Null texts and those without a letter are ``und`` with score 0.
    Whole texts are read, in lower case and letters only.
    """

    @arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        if model.key not in _scorers:
            _scorers.clear()  # of an earlier query
            _scorers[model.key] = Scorer(model)
        found: list[tuple[str, float]] = []
        for at in range(0, len(texts), _GROUP):
            found += _scorers[model.key](texts[at : at + _GROUP].to_pylist())
        names, scores = zip(*found, strict=True) if found else ((), ())
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    body = docs.drop("lang_pred", "score")
    guessed = body.withColumn("__guess", predict(F.col(text_col)))
    return guessed.select(
        *body.columns, F.col("__guess.lang_pred").alias("lang_pred"), F.col("__guess.score").alias("score")
    )
