"""Fingerprints (5), packing (6), nearest neighbours (7), mixing (9) and the pipeline."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickerlake.llm.ann import Graph, nearest
from tickerlake.llm.components import components
from tickerlake.llm.fingerprints import changed_paragraphs, edited_fingerprints, fingerprint, likeness, root, with_next
from tickerlake.llm.mixing import mix_sources, take_copies
from tickerlake.llm.packing import WordTokenizer, pack_documents
from tickerlake.llm.queries import QUERIES, tokenizer_path

from ..helpers import plan_text
from .helpers import ODD, Union, by_id, frame, near_components, prose, targets, without_repeats

SF = "/root/testdata/sf0.001"


# ---- fingerprints -------------------------------------------------------------------------------------


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(1)
    texts = ODD + [prose(rng, rng.randrange(1, 200)) for _ in range(60)] + ["# head\ntext\n\n# next\nmore"]
    rows = [(i * 3 - 50, t) for i, t in enumerate(texts)]
    got = by_id(edited_fingerprints(frame(spark, rows, extra=True).repartition(6)))
    assert len(got) == len(rows)
    order = sorted(rows, reverse=True)
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        n, r = len(t), got[d]
        want = t[: n - n // 3] + after[: n // 3]
        assert r.n_chars == n and r.edited_text == want
        assert (r.near_edited == 1) == (t == want) and (r.near_next == 1) == (t == after)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if n > 400 and t != want:
            assert 0.45 < r.near_edited < 0.85
    prints = collections.defaultdict(set)
    for d, t in rows:
        prints[t or ""].add(got[d].fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)


def test_texts_are_shuffled_without_their_fingerprints(spark):
    rows = with_next(frame(spark, [(i, f"text {i}") for i in range(40)]).select("doc_id", "text"), 4)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan_text(rows))
    assert any("text#" in columns for columns in moved)
    assert not [columns for columns in moved if "fp#" in columns]
    assert {r.doc_id: r.next_text for r in rows.collect()} == {i: f"text {(i - 1) % 40}" for i in range(40)}


def test_fingerprints_edges(spark):
    one = edited_fingerprints(frame(spark, [(1, "abcdef")])).first()
    assert one.edited_text == "abcdab" and one.near_next == 1
    assert edited_fingerprints(frame(spark, []).limit(0)).collect() == []
    rows = edited_fingerprints(frame(spark, [(1, "aaa"), (1, "bbb"), (None, "ccc")])).collect()
    assert sorted(r.edited_text for r in rows) == ["aab", "bbc", "cca"]


def test_tree_locates_edits(spark):
    a = "# one\nfirst\nsecond\n\n# two\nthird\nfourth"
    b = a.replace("third", "3rd")
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprint(F.col("a")).alias("x"), fingerprint(F.col("b")).alias("y")
    ).select(changed_paragraphs(F.col("x"), F.col("y")).alias("at"), (root(F.col("x")) == root(F.col("y"))).alias("same"),
             likeness(F.col("x"), F.col("y")).alias("near"))
    assert "PythonUDF" not in row._jdf.queryExecution().toString() and "EvalPython" not in row._jdf.queryExecution().toString()
    got = row.first()
    assert got.at == ["2.1"] and not got.same and 0.7 < got.near < 1


# ---- packing -------------------------------------------------------------------------------------------


def test_tokenizer_equals_whole_texts():
    from tokenizers import Tokenizer

    whole, parts = Tokenizer.from_file(tokenizer_path()), WordTokenizer(tokenizer_path(), 1)
    rng = random.Random(2)
    for text in [*ODD, "It's a DON'T, ''s ... x²y 's!? ΑΣΣ. İx́, é, a b <|endoftext|>", prose(rng, 500)]:
        want = whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(parts.ids(text), "<u4").tolist() == want


def test_packing_keeps_every_id(spark):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    rows = list(enumerate(ODD + [prose(rng, rng.randrange(0, 300)) for _ in range(80)] + [prose(rng, 5000)])) + [(3, "again here")]
    got = pack_documents(frame(spark, rows, extra=True).repartition(5), tokenizer_path(), capacity=256, tokens_per_group=6000).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    left = collections.Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        left.update((d, len(ids), i, x) for i, x in enumerate(ids))
    whole = {(d, len(i)): i for d, t in rows for i in [tok.encode(t or "", add_special_tokens=False).ids + [1]]}
    sequences = collections.defaultdict(list)
    for r in got:
        ids = whole[(r.doc_id, r.doc_tokens)][r.start : r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        left.subtract((r.doc_id, r.doc_tokens, r.start + i, x) for i, x in enumerate(ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(left.values()) == {0}
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding < 0.02 * sum(r.length for r in got)
    assert pack_documents(frame(spark, []).limit(0), tokenizer_path()).collect() == []


# ---- nearest neighbours ------------------------------------------------------------------------------------


def _exact(rows, query, k):
    q = np.asarray(rows[query], float)
    out = []
    for i, v in rows.items():
        v = np.asarray(v, float)
        if i != query and len(v) == len(q):
            out.append((-float(q @ v / np.sqrt((q @ q) * (v @ v))), i))
    return sorted((round(s, 12), i) for s, i in out)[:k]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 24))
    rows = {i: (centres[i % 6] + rng.normal(size=24) * 0.7).tolist() for i in range(900)}
    for i in range(30):
        rows[2000 + i] = rows[50]  # many copies of a query's vector
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    got = nearest(df, F.col("vec_id") % 50 == 0, rows_per_shard=250, search_breadth=60).collect()
    hits = total = 0
    for query in [i for i in rows if i % 50 == 0]:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        want = _exact(rows, query, 5)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert [(round(-s, 12), i) for _, i, s in mine] == sorted((round(-s, 12), i) for _, i, s in mine)
        for _, i, s in mine:
            q, v = np.asarray(rows[query]), np.asarray(rows[i])
            assert s == pytest.approx(q @ v / np.sqrt((q @ q) * (v @ v)), abs=1e-12)
        hits += len({i for _, i in want} & {i for _, i, _ in mine})
        total += 5
    assert hits / total >= 0.95
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 50] == [2000, 2001, 2002, 2003, 2004]


def test_unusable_vectors_take_no_part(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(100 + i, v) for i, v in enumerate(bad)] + [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (50, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in nearest(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 2)]  # 50 has no candidate of its dimension
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_extreme_magnitudes_and_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr("tickerlake.llm.ann.QUERY_BLOCK", 7)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=8) * scale).tolist()) for i, scale in enumerate(rng.choice([1.0, 1e200, 1e-200, 1e-310, 1e308 / 8], 120))]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 3 == 0, rows_per_shard=30).collect()
    unit = {i: np.asarray(v) / np.abs(v).max() for i, v in rows}
    for query in range(0, 120, 3):
        mine = [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == query]
        cosine = {i: unit[i] @ unit[query] / np.sqrt((unit[i] @ unit[i]) * (unit[query] @ unit[query])) for i in unit if i != query}
        assert [i for i, _ in mine] == sorted(cosine, key=lambda i: -cosine[i])[:5]
        assert [s for _, s in mine] == pytest.approx([cosine[i] for i, _ in mine], abs=1e-9)


def test_graph_from_its_flat_arrays():
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(300, 8)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    graph = Graph(unit, width=8, breadth=32)
    flat = graph.flat()
    again = Graph.stored(unit, flat["entry"], flat["levels"], flat["links"], 8)
    assert all(graph.search(q, 20) == again.search(q, 20) for q in unit[:20])


# ---- mixing ----------------------------------------------------------------------------------------------------


def test_mix_meets_targets(spark):
    rng = random.Random(6)
    data = []
    for i in range(600):
        source = rng.choice(["b", "b", "b", "a", "c", "é", None, "tiny"]) if i > 3 else "tiny"
        data.append((i, rng.choice([None, "", prose(rng, rng.randrange(1, 40))]), source))
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    rows = mix_sources(df).collect()
    sizes = collections.Counter()
    for _, text, source in data:
        sizes[source] += len((text or "").split())
    want = targets(dict(sizes), (3, 1, 2), 1.5, 2)
    taken = collections.Counter()
    assert len(rows) == 600
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.size == len((data[r.doc_id][1] or "").split()) and 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - want[s]) <= 20 for s in want)
    assert {(r.doc_id, r.copies) for r in mix_sources(df.repartition(9)).collect()} == {(r.doc_id, r.copies) for r in rows}
    copies = {r.doc_id: r.copies for r in rows}
    mixed = collections.Counter(r.doc_id for r in take_copies(df).collect())
    assert mixed == collections.Counter({d: c for d, c in copies.items() if c})


def test_mix_edges(spark):
    assert mix_sources(frame(spark, []).limit(0)).collect() == []
    assert {r.copies for r in mix_sources(frame(spark, [None, ""])).collect()} == {0}
    same = [(1, "a b"), (1, "a b"), (None, "c d")]
    assert len(mix_sources(frame(spark, same)).collect()) == 3


def test_components_of_a_chain_and_a_hub(spark):
    rng = random.Random(7)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    union = Union()
    for a, b in pairs:
        if a != b:
            union.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long"), "test").collect()}
    assert got == {n: union.find(n) for n in union.up}


# ---- pipeline ----------------------------------------------------------------------------------------------------


def test_stages_equal_brute_force(spark):
    """Each stage on what the one before kept, against its brute-force version."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "suffix_dedup", "mix", "pack"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept.get("last", [tuple(r) for r in docs.collect()])
        source = spark.createDataFrame(before, docs.schema)
        out = stage(spark, source, SF)
        rows = [tuple(r) for r in out.collect()]
        if name != "pack":
            assert out.columns == docs.columns
        texts = [(r[0], r[1]) for r in before]
        if name == "language_id":
            assert set(rows) <= set(before) and len(rows) > 0.95 * len(before)
        elif name == "near_dedup":
            want = near_components(texts, 5, 80)
            assert sorted(r[0] for r in rows) == sorted(d for d, c in want.items() if d == c)
        elif name == "suffix_dedup":
            want = {d: k.decode("utf-8", "ignore") for d, (k, gone) in without_repeats(texts).items()}
            assert {r[0]: r[1] for r in rows} == {d: t for d, t in want.items() if t}
            assert all(r[4] == len(r[1]) for r in rows)
        elif name == "mix":
            most = collections.Counter(r[0] for r in rows)
            assert set(rows) <= set(before) and max(most.values()) <= 2
        else:
            total = collections.Counter()
            for r in rows:
                total[r[0]] += r[2]
            copies = collections.Counter(d for d, _ in texts)
            tokens = {r[0]: r[4] for r in rows}
            assert total == collections.Counter({d: n * tokens[d] for d, n in copies.items()})
        kept["last"] = rows


def test_queries_and_run(spark):
    assert [q.split("_")[0] for q in QUERIES] == [f"op{i}" for i in range(1, 14)]
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and "ids_crc32" in rows.columns
    out = QUERIES["op2_suffix_dedup"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = without_repeats(list(docs.items()))
    assert all(r.kept_sha256 == hashlib.sha256(want[r.doc_id][0]).hexdigest() for r in out)
