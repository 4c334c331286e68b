"""Suffix-array removal of repeats (2) and MinHash near-duplicates (3) against brute force."""

import random

import numpy as np
import pytest

from tickerlake.llm import neardup, suffix_dedup
from tickerlake.llm.neardup import drop_near_duplicates, near_duplicates
from tickerlake.llm.suffix_dedup import LENGTH, anchors, multikey_sort, remove_repeats, sort_bucket
from tickerlake.llm import suffix_dedup as sd

from .helpers import ODD, by_id, frame, near_components, prose, shingles, without_repeats


def _repetitive(seed: int) -> list:
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (8, 14, 20, 60)] + ["abcabcabc" * 12, "z" * 130]
    texts = []
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            lo = rng.randrange(0, max(1, len(p) - 55))
            parts += [p[lo:], prose(rng, rng.randrange(0, 20))]
        texts.append("".join(parts))
    texts += [texts[3], texts[3], texts[5] + "!", "é" * 40 + "x", "é" * 40 + "y"]
    return ODD + texts


def test_multikey_sort_sorts_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order = multikey_sort(lambda t: rows[:, t], 4)
    assert [tuple(r) for r in rows[order]] == sorted(map(tuple, rows))
    assert len(multikey_sort(lambda t: rows[:0, t], 4)) == 0


def test_equal_strings_have_equal_anchors():
    rng = random.Random(2)
    passage = "".join(rng.choice("ab c") for _ in range(400)).encode()
    data = b"start " + passage + b" middle " + passage
    text = np.frombuffer(data + bytes(LENGTH), np.uint8)
    place, hashed, doc, first, last = anchors(text, np.array([0]), np.array([len(data)]))
    starts = {}
    for p, h, a, b in zip(place, hashed, first, last):
        for i in range(a, b + 1):
            assert i not in starts, "each string has one anchor"
            starts[i] = (int(p - i), int(h))
    assert sorted(starts) == list(range(len(data) - LENGTH + 1))
    shift = len(passage) + len(b" middle ")
    for i in range(6, 6 + len(passage) - LENGTH + 1):
        assert starts[i] == starts[i + shift]


@pytest.mark.parametrize("ranges", [1, 7])
def test_repeats_equal_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1 << 10)
    monkeypatch.setattr("tickerlake.llm.blocks.BLOCK_BYTES", 1 << 12)
    rows = list(enumerate(_repetitive(3)))
    random.Random(4).shuffle(rows)
    want = without_repeats(rows)
    got = remove_repeats(frame(spark, rows, extra=True).repartition(5), ranges=ranges).collect()
    assert len(got) == len(rows)
    for r in got:
        kept, gone = want[r.doc_id]
        assert bytes(r.kept) == kept and r.n_removed == sum(gone) and r.n_bytes == len(gone)
        marked = [False] * len(gone)
        for s in r.spans:
            assert not marked[s.start] and (s.start == 0 or not marked[s.start - 1])
            marked[s.start : s.start + s.length] = [True] * s.length
        assert marked == gone


def test_one_passage_over_all_ranges(spark):
    """A hot passage fills every range; all but the first document lose it."""
    rng = random.Random(5)
    passage = prose(rng, 40)
    rows = [(i, prose(rng, 12, 10**6) + passage + prose(rng, 12, 10**6)) for i in range(300)]
    want = without_repeats(rows)
    got = remove_repeats(frame(spark, rows), ranges=16, sample_per_range=100).collect()
    assert all(bytes(r.kept) == want[r.doc_id][0] for r in got) and len(got) == 300


def test_repeats_null_ids_repeated_rows_empty_table(spark):
    long = "0123456789" * 9
    rows = [(7, long), (7, long), (None, long), (9, "other " + long)]
    got = sorted((r.doc_id if r.doc_id is not None else 10**9, r.n_removed) for r in remove_repeats(frame(spark, rows)).collect())
    assert got == [(7, 0), (7, 0), (9, 90), (10**9, 90)]
    assert remove_repeats(frame(spark, []).limit(0)).collect() == []


def test_documents_without_repeats_keep_their_columns(spark):
    long = "0123456789" * 9
    df = frame(spark, [(1, long), (2, "é" + long + " tail"), (3, long), (4, None), (5, "")], extra=True)
    out = sd.without_repeats(df)
    assert out.columns == df.columns
    rows = by_id(out)
    assert set(rows) == {1, 2, 4, 5}  # 3 has nothing left
    assert rows[1].text == long and rows[2].text == "é tail" and rows[2].n_chars == 6
    assert rows[4].text == "" and rows[2].lang == "en" and rows[2].score == "x"
    assert sort_bucket(np.zeros(0, sd.SUFFIX))[2] == []


# ---- near duplicates --------------------------------------------------------------------------


def _edited(rng, text, share):
    words = text.split()
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def _near(seed):
    rng = random.Random(seed)
    shared = prose(rng, 25, 10**6)
    texts = list(ODD)
    for _ in range(8):
        base = prose(rng, rng.randrange(5, 150), 10**6)
        texts += [base.upper()] + [_edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06])) for _ in range(6)]
    # many documents that share a passage but are no copies, some of them copies of each other
    for _ in range(40):
        own = prose(rng, 8, 10**6)
        texts.append(shared + own)
        if rng.random() < 0.3:
            texts.append(shared + own + " end")
    return texts


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, words):
    for size in ("BUCKET_ROWS", "BLOCK", "SLOT_ROWS"):  # several parts a bucket and a cluster
        monkeypatch.setattr(neardup, size, 8)
    rows = list(enumerate(_near(words)))
    want = near_components(rows, words, 80)
    got = near_duplicates(frame(spark, rows, extra=True).repartition(4), words=words).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want[r.doc_id], r
        assert r.n_shingles == len(shingles(rows[r.doc_id][1], words))
        assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_edges(spark):
    same = "one two three four five six"
    rows = [(5, same), (5, same), (3, same.upper()), (None, same), (8, None), (9, "")]
    got = [(r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (8, 8, True), (9, 9, True)], key=str)
    assert near_duplicates(frame(spark, []).limit(0)).collect() == []
    left = drop_near_duplicates(frame(spark, [(1, same), (1, same), (2, same), (None, same), (4, "else")], extra=True))
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 4]
