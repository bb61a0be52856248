"""Ids of a vocabulary with word ends, as little-endian bytes."""

from __future__ import annotations

import json
import struct
import unicodedata

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

from changefeed.llm.packing import byte_letters

VOCABULARY = "word_bpe_49k.json"
#: Letters beyond these, and blanks that libraries disagree on, go through ``tokenizers`` alone.
_OTHER = regex.compile("[^\x00-\x1b -\x84\x86-\x9f¡-ɏ]")
_KNOWN, _LONGEST = 300_000, 64


class Remembered(dict):
    """What a function gives for short strings.

    It forgets those not asked for in a while: when 300,000 are held, they become the
    old ones, and those are dropped that were not asked for since the last time.
    """

    def __init__(self, give) -> None:
        super().__init__()
        self.give, self.old = give, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.give(key)
        if len(key) <= _LONGEST:
            if len(self) >= _KNOWN:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordEncoder:
    """Ids of texts, four bytes an id, of a vocabulary file that ``tokenizers`` reads.

    Its words hold no blanks and do not depend on each other. So a text of Latin
    letters is cut at blanks, each part into words by the file's own pattern, and
    parts seen before are looked up. All other texts, and those with a
    special token's string, go through ``tokenizers`` as a whole.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.model, self.size = self.whole.model, self.whole.get_vocab_size()
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        self.special = [t["content"] for t in known["added_tokens"]]
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.signs: dict[str, bytes] = {}
        pattern = known["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find, self.parts = regex.compile(pattern).findall, Remembered(self._part)

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text) or any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.asarray(ids, "<u4").tobytes()
        plain = unicodedata.normalize("NFC", text).lower()
        return b"".join(map(self.parts.__getitem__, plain.split()))

    def _part(self, part: str) -> bytes:
        # Letters alone are a word, and one sign or digit behind them is another: no need
        # to cut these by the pattern. A word of letters is one for all parts that have it.
        if part.isalpha():
            return self._word(part)
        if part[:-1].isalpha():
            return self.parts[part[:-1]] + self._sign(part[-1])
        return b"".join(self.parts[w] if w.isalpha() else self._sign(w) for w in self.find(part))

    def _sign(self, sign: str) -> bytes:
        found = self.signs.get(sign)
        if found is None:
            found = self._word(sign)
            if len(sign) == 1:
                self.signs[sign] = found
        return found

    def _word(self, word: str) -> bytes:
        letters = word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(self.letters)
        tokens = self.model.tokenize(letters)
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str | None) -> WordEncoder:
    """The encoder of a vocabulary file, once per process; None: the public default."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
