"""Vector codes (11) against Lloyd's rounds in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tickerlake.llm import codes
from tickerlake.llm.codes import integers, nearest_entries, packed, unpacked, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def lloyd(rows, positions=16, entries=64, rounds=2):
    """vec_id, code, error, label_error and codebook digest of every kept row."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max(len(r[1]) for r in kept) // positions) * positions
    width = size // positions
    whole = []
    for _, v, _ in kept:
        v = [256 * int(x) if abs(x) >= 2.0**60 else math.floor(256 * x) for x in v]
        whole.append([*v, *[0] * (size - len(v))])
    parts = [[w[p * width : (p + 1) * width] for p in range(positions)] for w in whole]
    books = [[parts[i][p] for i in range(min(entries, len(kept)))] for p in range(positions)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(positions):
            held = {}
            for own in parts:
                held.setdefault(near(own[p], books[p])[1], []).append(own[p])
            books[p] = [[sum(c) // len(held[e]) for c in zip(*held[e])] if e in held else entry for e, entry in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out, labels = [], {}
    for (vec_id, _, label), own in zip(kept, parts):
        best = [near(own[p], books[p]) for p in range(positions)]
        error = sum(d for d, _ in best)
        labels[label] = labels.get(label, 0) + error
        out.append((vec_id, "".join(f"{e:02x}" for _, e in best), error, label))
    fit = lambda x: x if x < 2**63 else None
    return [(i, c, fit(e), fit(labels[lab]), digest) for i, c, e, lab in out]


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


def _rows(n, size, seed=1, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(9)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((2**60 + 3 * i + 1, [c + spread * rng.gauss(0, 0.3) for c in centre], rng.choice([0, 1, 2, None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("owner_bytes", [1 << 20, 200])
def test_codes_equal_lloyd(spark, monkeypatch, owner_bytes):
    monkeypatch.setattr(codes, "OWNER_BYTES", owner_bytes)
    rows = _rows(400, 32)
    rows += [rows[0]] * 150 + [(None, rows[1][1], 7), (None, rows[2][1], 7), (rows[3][0], rows[4][1], 1)]  # copies, ids NULL and repeated
    rows += [(1, None, 0), (2, [None] * 32, 0), (3, [float("nan")] * 32, 0), (4, [float("inf")] * 32, 1), (5, [0.0] * 32, 5)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "'x' AS `row`", "'x' AS kind", "1 AS position", "'x' AS code")
    assert in_order(vector_codes(docs.repartition(5)).collect()) == in_order(lloyd(rows))


@pytest.mark.parametrize("rows", [
    _rows(3, 16), [(1, [0.5], None)], [(1, [], 1), (2, [], 1)], _rows(70, 20) + [(1, [1.0, 2.0], 3)], [(7, [0.25] * 16, 0)] * 70,
    _rows(66, 16) + [(1, [1e30] * 16, 0), (2, [-1e200] + [0.0] * 15, 1), (3, [1e308] * 16, 1), (4, [2.0**45] * 16, 2)],
], ids=["few", "short", "empty", "lengths", "copies", "huge"])
def test_odd_vectors(spark, rows):
    assert in_order(vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()) == in_order(lloyd(rows))


def test_more_rounds_and_other_shapes(spark):
    rows = _rows(200, 12, seed=4)
    made = vector_codes(spark.createDataFrame(rows, SCHEMA), positions=3, entries=200, rounds=4).collect()
    assert in_order(made) == in_order(lloyd(rows, 3, 200, 4))


def test_empty_table(spark):
    out = vector_codes(spark.createDataFrame([(1, None, 2)], SCHEMA))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_integers_round_trip():
    x = np.array([[0.1, -0.1], [3e5, -2.0**50], [1e300, -1e300]])
    assert integers(x[:1]).tolist() == [[25, -26]]
    whole = integers(x)
    assert whole.tolist()[2] == [256 * int(1e300), -256 * int(1e300)]
    for some in (integers(x[:1]), whole, whole[:2], np.zeros((0, 2), np.int64)):
        kind, data = packed(some)
        if len(some):
            assert unpacked(kind, data, 2).tolist() == some.tolist()
    entry, distance = nearest_entries(np.array([[1, 1], [5, 5]]), np.array([[0, 0], [2, 2], [2, 2]]))
    assert entry.tolist() == [0, 1] and distance.tolist() == [2, 18]
