"""Small documents with every awkward case, and plain-Python counterparts of the operators."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, rate int, slot string, _k long, bucket double"


def frame(spark, rows, extra=True):
    """documents from (doc_id, text[, lang[, source]]), with extra columns whose names clash with the operators' own."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r[:4]
        full.append((doc_id, text, lang, source, None if text is None else len(text), "x", 7, "s", 9, 0.5))
    return spark.createDataFrame(full, DOCS).drop(*([] if extra else ["digest", "rate", "slot", "_k", "bucket"]))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(words))


def awkward() -> list[tuple]:
    """Nulls, empties, blanks, short, very long, repeated rows, near copies, marks only."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    long = prose(2, 40_000)
    return [
        (1, base, "en", "a"), (2, near, "en", "a"), (3, base.upper(), "fr", None), (4, None, "en", "b"), (5, "", None, "b"), (6, " \t\n ", "en", "b"),
        (7, "one two", "en", None), (8, "One  TWO", "en", "a"), (9, long, "de", "a"), (10, long + " tail", "de", "c"), (11, "!!! ??? 123", "es", "c"),
        (12, prose(3, 30), "en", "a"), (12, prose(3, 30), "en", "a"), (None, prose(4, 30), None, None), (None, prose(4, 30), "en", "a"), (13, "one\ttwo", "en", "a"),
        (14, "naïve café Ünïcode \U0001d400 text", "fr", "a"),
    ]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(text: str | None, k: int = 4) -> set:
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, links) -> dict:
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def squeezed(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
