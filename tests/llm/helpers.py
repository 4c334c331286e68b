"""Small documents and brute-force versions of the operators' contracts."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra: bool = False):
    """Documents from texts or (doc_id, text) pairs; with ``extra``, columns with clashing names."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    data = [(d, t, "en", f"s{(d or 0) % 3}", None if t is None else len(t)) for d, t in rows]
    df = spark.createDataFrame(data, DOCS)
    if extra:
        for name in ("id", "size", "score", "block_id", "rep", "component", "copies", "kept", "fp", "source_size"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    out = [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
    return "".join(w + rng.choice([" ", " ", " ", ". ", "\n"]) for w in out)


#: NULL, empty and blank texts, ties, one very long word, more than one alphabet.
ODD = [None, "", " ", "\n\n", "a", "a", "ab cd", "x" * 3000, "été 你好 мир", "\t\x0b a \r\n b"]


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def near_components(rows, words, percent):
    """doc_id -> smallest id reachable, by comparing all pairs."""
    union, sets = Union(), {d: shingles(t, words) for d, t in rows}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        union.find(a)
        for b in ids[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    union.join(a, b)
    return {d: union.find(d) for d in ids}


def without_repeats(rows, length=50):
    """doc_id -> (bytes kept, which bytes go), by the definition."""
    rows, first = [(d, (t or "").encode()) for d, t in rows], {}
    for d, b in rows:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, d), d)
    out = {}
    for d, b in rows:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        out[d] = (bytes(x for x, g in zip(b, gone) if not g), gone)
    return out


def targets(sizes, weights, share, most):
    """source -> target by handing out the excess again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while True:
        each = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * each >= most * sizes[s]]
        if not full:
            return out | {s: weight[s] * each for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
        if not open_:
            return out
