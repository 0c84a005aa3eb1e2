"""Tables with every awkward case, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size string, spans string, kept string, task string, _id string"


def prose(rng: random.Random, n: int) -> str:
    """``n`` invented words in sentences."""
    syllables = ["ka", "lo", "mi", "ter", "an", "su", "ve", "ro", "din", "pa", "el", "gu"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


def documents(spark, texts, sources=None):
    """A table of (id, text) pairs with extra columns whose names the operators use inside."""
    rows = [(i, t, "en", sources[n] if sources else "s", len(t or ""), "x", "x", "x", "x", "x", "x") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING)


def shingles(text) -> frozenset:
    words = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def classes(texts) -> dict:
    """Smallest reachable id by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in texts if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in parent}
