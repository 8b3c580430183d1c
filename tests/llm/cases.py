"""Small inputs with the awkward cases that every operator has to handle."""

from __future__ import annotations

import random

_WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ne") for b in ("ra", "su", "to") for c in ("n", "l", "st", "")]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        word = rnd.choice(_WORDS) + rnd.choice(_WORDS)
        out.append(word.capitalize() if i % 9 == 0 else word)
        if i % 9 == 8:
            out[-1] += ".\n" if i % 27 == 26 else "."
    return " ".join(out).replace("\n ", "\n")


LONG = prose(1, 30_000)
TEXTS = [
    prose(2, 120), prose(3, 120), "", "   \n\t ", "one", "One two", LONG,
    "All rights reserved. ALL RIGHTS RESERVED", "Ärger über\u00a0größe ﬁne 日本語 🙂 naïve",
    "x" * 5000, "a\x1cb\x85c\u200bd\r\ne", "<|endoftext|> $$$ %%% ***",
]
DOC_SCHEMA = (
    "doc_id long, text string, lang string, host string, rule string, n long, ids string, key string, "
    "_row long, label string, n_words int, score string, `odd.name` string"
)


def _row(doc_id, text):
    return (doc_id, text, "en", "h", None, 7, "i", "k", 1, "l", 3, "s", "o")


DOCS = [_row(i, t) for i, t in enumerate(TEXTS)] + [
    _row(20, None), _row(None, "two words"), _row(None, None),
    _row(0, TEXTS[0]), _row(0, TEXTS[0]),  # the same row three times
    _row(21, TEXTS[0]), _row(22, TEXTS[1].replace("\n", " ")),  # copies under other ids
]
