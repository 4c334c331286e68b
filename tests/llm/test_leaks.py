"""Benchmark decontamination (12) against brute force."""

import random
import re

import pytest

from tickerlake.llm import decontaminate
from tickerlake.llm.decontaminate import WORD, Automaton, find_leaks, remove_leaks, without_spans

from .helpers import ODD, by_id, frame, prose

BIG = 2**60 + 1


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaks(text, items, window):
    """Number of words, hit places and items of a text, by comparing all windows at all places."""
    w, hit, found = words_of(text), set(), set()
    for item, content in items:
        own = words_of(content)
        n = min(len(own), window)
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(w), hit, found


def cases(seed=5, window=10):
    rng = random.Random(seed)
    items = [(f"i{k}", prose(rng, n, 30)) for k, n in enumerate([40, 25, 12, 10, 9, 6, 3, 2, 1, 60])]
    items += [("i0", items[0][1]), ("copy", items[0][1]), (None, items[1][1]), ("none", None), ("empty", " .,; "),
              ("same", "same " * 40), ("ümlaut", "Straße ÉTÉ 你好, x9"), ("I3", items[3][1].upper())]
    texts = list(ODD)
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 50), 30)]
        for _ in range(rng.randrange(0, 3)):
            source = (rng.choice(items)[1] or "").split()
            lo = rng.randrange(0, max(1, len(source)))
            parts += [rng.choice([" ", "! ", "\n"]).join(source[lo : lo + rng.randrange(1, 30)]), prose(rng, rng.randrange(0, 9), 30)]
        texts.append(" ".join(parts))
    texts += [items[0][1], "same " * 9, "same " * 33 + "other " + "same " * 12, "strasse Straße ÉTÉ 你好... x9 y"]
    return items, texts


@pytest.mark.parametrize("window", [3, 10])
def test_automaton_equals_brute_force(monkeypatch, window):
    monkeypatch.setattr(decontaminate, "CHUNK", 64)
    items, texts = cases(window=window)
    machine = Automaton([(i or "", words_of(t)) for i, t in items], window)
    for text in texts:
        n, spans, found = machine.scan((text or "").encode())
        expected = leaks(text, items, window)
        assert (n, {p for a, b in spans for p in range(a, b)}, found) == expected
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("shard_words", [10_000, 50])
def test_leaks_equal_brute_force(spark, shard_words):
    items, texts = cases()
    rows = [(BIG + 2 * i, t) for i, t in enumerate(texts)] + [(None, texts[-4]), (BIG, texts[0])]
    docs = frame(spark, rows, extra=True).selectExpr("*", "'x' AS leaks", "'y' AS `row`", "'z' AS items").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "'x' AS doc_id", "1 AS words")
    out = find_leaks(docs, bench, shard_words=shard_words).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3])
    expected = sorted(((d, e[0], len(e[1]), sorted(e[2])) for d, t in rows for e in [leaks(t, items, 10)]), key=key)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in out), key=key) == expected
    assert any(n for _, _, n, _ in expected) and not all(n for _, _, n, _ in expected)


def test_spans_are_cut(spark):
    items = [("a", "one two three four five six seven eight nine ten eleven")]
    keep = " ".join(f"own{i}" for i in range(30))
    texts = [f"{keep}\n One, two three four FIVE six seven eight nine ten! {keep}", items[0][1], f"nine ten eleven {keep}", None, ""]
    docs = frame(spark, texts, extra=True)
    out = by_id(remove_leaks(docs, spark.createDataFrame(items, "item_id string, text string")))
    assert out[0]["text"] == f"{keep}\n ! {keep}"
    assert sorted(out) == [0, 2, 3, 4] and out[2]["text"] == texts[2] and out[3]["text"] is None and out[4]["text"] == ""
    assert set(docs.columns) == set(out[0].asDict())
    assert without_spans(b"a b, c d e", [[0, 1], [2, 4]]) == b" b,  e"


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id string, text string")
    docs = frame(spark, ["a b", None])
    assert [r["n_hit"] for r in find_leaks(docs, items).collect()] == [0, 0]
    assert find_leaks(docs.limit(0), items).count() == 0
    assert remove_leaks(docs, items).count() == 2
