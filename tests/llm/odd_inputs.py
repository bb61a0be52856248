"""Hard inputs that every operator must take."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, size string, fingerprint string, component_id string, score string, kept string, part int, label string, hash string, component string"
EXTRAS = [(7, "x", "f", "c", "s", "k", 3, "l", "h", "o"), (None,) * 10]


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choices("abcdefgh", k=pick.randint(2, 7))) for _ in range(words))


def odd_rows():
    long_text = "\n".join(prose(i, 40) for i in range(500))
    texts = [
        None, "", "   \t\n ", "one", "two words", prose(1, 60), prose(1, 60), prose(2, 80),
        long_text, long_text + " end", "\n\n" + prose(2, 80) + "\n" + prose(3, 9), "ÉÀ ß \x00 ünï 漢字 😀", "x" * 50_000,
        "a " * 20_000,
    ]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, [None, "en", "fr"][i % 3], [None, "a", "", "b"][i % 4], len(text or ""), *EXTRAS[i % 2]))
    rows.append(rows[5])
    rows.append(rows[5])
    rows.append(rows[0])
    rows.append((None, prose(1, 60), "en", "a", None, *EXTRAS[0]))
    rows.append((None, None, None, None, None, *EXTRAS[1]))
    return rows


class Union:
    """Plain union-find, for the brute-force versions."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
