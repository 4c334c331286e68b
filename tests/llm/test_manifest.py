"""Merkle manifest (13) against a tree built in Python."""

import hashlib
import random
import zlib

import pytest

from tickerlake.llm import manifest as m
from tickerlake.llm.manifest import manifest, without_line_feeds

from .helpers import ODD, prose

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests):
    """Root, and of each leaf the digests before and after it, level by level."""
    paths, below, nodes = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(nodes) > 1:
        runs = [range(i, min(i + 3, len(nodes))) for i in range(0, len(nodes), 3)]
        for run in runs:
            for j in run:
                for i in below[j]:
                    paths[i].append(([nodes[k] for k in run if k < j], [nodes[k] for k in run if k > j]))
        below = [[i for j in run for i in below[j]] for run in runs]
        nodes = [H(*[nodes[j] for j in run]) for run in runs]
    return nodes[0], paths


def expected(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of every row."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *tree([leaf(r) for r in own])))
    root, upper = tree([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (own, subroot, paths), above in zip(trees, upper):
        for r, path in zip(own, paths):
            text, path = r[4], path + above
            if text is not None and zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf((*r[:4], text))
            for before, after in path:
                node = H(*before, node, *after)
            out.append((str(r[0]), leaf(r), subroot, root, H(*[d for p in path for side in p for d in side]), node, node == root))
    return sorted(out)


def found(docs):
    rows = manifest(docs, without_line_feeds()).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((str(r[0]), *r[1:]) for r in rows)


def _rows(counts, seed=3):
    rng, rows = random.Random(seed), []
    for source, n in counts.items():
        for _ in range(n):
            text = rng.choice([*ODD, prose(rng, 12), prose(rng, 3)])
            rows.append((2**60 + 7 * len(rows) + 1, source, rng.choice(["en", None]), None if text is None else len(text), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("counts", [
    {"a": 1}, {None: 1, "a": 3, "": 2}, {"a": 4, "b": 28, "ü": 9, None: 2, "Z": 82}, {f"s{i}": 1 + i % 4 for i in range(11)},
])
def test_manifest_equals_tree(spark, counts):
    rows = _rows(counts)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == expected(rows)


def test_repeated_rows_nulls_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(m, "STOREY", 2)
    rows = _rows({"a": 60, "b": 7})
    rows += rows[:20] + [rows[0]] * 15 + [(rows[1][0], "a", None, None, "other\ntext"), (None, "a", "en", 3, "x\ny"), (None, "a", "en", 3, "x\ny"), (5, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("lo", "n", "tree_no", "digest", "current", "leaf", "row", "at", "part", "place", "path", "root"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    assert found(docs.repartition(5)) == expected(rows)


def test_proof_finds_the_changed_rows(spark):
    rows = [(i, "s", "en", 1, "a\nb" if i % 3 else "ab") for i in range(30)]
    out = {r[0]: r[-1] for r in found(spark.createDataFrame(rows, SCHEMA))}
    assert out == {str(i): not (i % 3 and zlib.crc32(str(i).encode()) % 2 == 0) for i in range(30)}


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
