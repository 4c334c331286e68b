"""Near-duplicate documents: MinHash with tensored banding, candidates verified on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped_texts, small, stored
from .components import components
from .packing import forget_tokenizers
from .text import as_bytes, chunks, mixed, word_hashes

#: Minhashes in a half key, and half keys on each of the two sides.
HASHES = 3
HALVES = 14
#: Least share of equal minhashes at which a pair is verified: far below the similarity asked for.
LEAST_AGREEMENT = 0.58
#: Bytes of text at a time in a task.
CHUNK = 1 << 19
#: Parts that are compared two by two: rows of a bucket by sketch, and documents and bytes of a cluster on full sets.
BUCKET_ROWS = 4096
BLOCK = 1024
BLOCK_BYTES = 16 << 20
#: Rows of small buckets, and bytes of small clusters, that share a group of a task.
SLOT_ROWS = 1 << 14
SLOT_BYTES = 16 << 20

_RNG = np.random.default_rng(3)
_FACTORS = _RNG.integers(1, 2**62, 2 * HALVES * HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDS = _RNG.integers(0, 2**63, 2 * HALVES * HASHES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and how many each has."""
    hashes, per_text = word_hashes(texts)
    first = np.cumsum(per_text) - per_text
    of = np.repeat(np.arange(len(texts)), per_text)
    counts = np.where(per_text >= words, per_text - words + 1, np.minimum(per_text, 1))
    place = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    stop = (first + per_text)[owner]
    shingle = np.zeros(len(place), np.uint64)
    for w in range(words):
        shingle = shingle * _STEP + np.where(place + w < stop, padded[place + w], np.uint64(0))
    shingle = mixed(shingle)
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])]) if len(order) else np.zeros(0, bool)
    return shingle[new], np.bincount(owner[new], minlength=len(texts))


def minhashes(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of minhashes for each set that is not empty."""
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((len(first), len(_FACTORS)), np.uint32)
    for i, (a, b) in enumerate(zip(_FACTORS, _ADDS)):
        out[:, i] = np.minimum.reduceat(((sets * a + b) >> np.uint64(32)).astype(np.uint32), first) if len(first) else 0
    return out


def half_keys(minhash: np.ndarray) -> np.ndarray:
    """2 x HALVES keys a row: each a group of HASHES minhashes, first one side's, then the other's."""
    groups = minhash.astype(np.uint64).reshape(len(minhash), 2 * HALVES, HASHES)
    key = np.tile(np.arange(1, 2 * HALVES + 1, dtype=np.uint64), (len(minhash), 1))
    for h in range(HASHES):
        key = mixed(key * _STEP + groups[:, :, h])
    return key


SKETCH = "n long, set_key string, halves array<long>, sketch binary"


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, set size, a key of the whole set, half keys, and minhashes cut to a byte."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_tokenizers()
        for batch in batches:
            texts = as_bytes(batch["text"])
            for part in chunks([len(t) for t in texts], CHUNK):
                sets, sizes = shingle_sets(texts[part], words)
                some = sizes > 0
                first = (np.cumsum(sizes) - sizes)[some]
                table = batch.iloc[part][["doc_id"]].assign(n=sizes, set_key=None, halves=None, sketch=None)
                if len(first):
                    low, high = np.add.reduceat(sets, first), np.bitwise_xor.reduceat(mixed(sets + _STEP), first)
                    minhash = minhashes(sets, sizes)
                    put = iter(zip(low, high, half_keys(minhash).view(np.int64), minhash.astype(np.uint8)))
                    filled = [(f"{l:016x}{h:016x}", k, s.tobytes()) for l, h, k, s in put]
                    at = iter(filled)
                    table[["set_key", "halves", "sketch"]] = pd.DataFrame(
                        [next(at) if s else (None, None, None) for s in some], index=table.index, dtype=object)
                yield table

    return stored(mapped_texts(docs, sketch, SKETCH), "neardup-sketches")


def buckets_of(reps: DataFrame) -> DataFrame:
    """key and rep of every table bucket that holds two or more.

    A table's key is a pair of half keys, one of each side: HALVES squared
    tables from 2 x HALVES groups of minhashes. A half that no other document
    has is in no shared bucket, so pairs are formed of shared halves only.
    """
    halves = reps.select("rep", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select(F.col("half").alias("h"))
    sides = halves.join(shared, F.col("half") == F.col("h")).groupBy("rep").agg(
        F.collect_list(F.when(F.col("place") < HALVES, F.col("half"))).alias("a"),
        F.collect_list(F.when(F.col("place") >= HALVES, F.col("half"))).alias("b"),
    ).where((F.size("a") > 0) & (F.size("b") > 0))
    keys = sides.select("rep", F.explode("a").alias("a"), "b").select("rep", "a", F.explode("b").alias("b"))
    keys = stored(keys.select("rep", F.xxhash64("a", "b").alias("key")), "neardup-keys")
    several = keys.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("centre")).where("members > 1")
    return stored(keys.join(several.withColumnRenamed("key", "k"), F.col("key") == F.col("k")).select("key", "rep", "members", "centre"), "neardup-buckets")


def agreement(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Share of equal bytes in pairs of sketches."""
    if not len(a):
        return np.zeros(0)
    left, right = (np.frombuffer(b"".join(x), np.uint8).reshape(len(a), -1) for x in (a, b))
    return (left == right).mean(1)


def _agree(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(agreement(a, b))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def enough(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    n = pairs.count()
    left = sets.select(F.col("rep").alias("a_rep"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("rep").alias("b_rep"), F.col("shingles").alias("b_set"))
    joined = left.join(small(pairs, n), F.col("a") == F.col("a_rep")).join(right, F.col("b") == F.col("b_rep"))
    return stored(joined.where(F.pandas_udf(enough, "boolean")("a_set", "b_set")).select("a", "b"), "neardup-links")


class Groups:
    """Union-find over the labels 0 to n - 1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return self.parent
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Join the pairs in order; which of them joined two groups."""
        parent, did = self.parent, []
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            while parent[x] != x:
                x = parent[x] = parent[parent[x]]
            while parent[y] != y:
                y = parent[y] = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                did.append(i)
        return did


def _runs(key: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    return list(zip(edge[:-1].tolist(), edge[1:].tolist()))


def _alike(sketch: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, least_size: float) -> np.ndarray:
    ok = np.minimum(n[a], n[b]) >= least_size * np.maximum(n[a], n[b])
    ok[ok] = (sketch[a[ok]] == sketch[b[ok]]).mean(1) >= LEAST_AGREEMENT
    return ok


#: Columns that tell a group of ``dealt`` rows.
SLOT = ["slot", "many", "x", "y"]


def dealt(rows: DataFrame, key: str, parts: str, slots: int) -> DataFrame:
    """``rows`` with part and SLOT: groups in which every pair of a key's rows meets.

    ``parts`` says in how many parts a key's rows are cut. A key of one part
    shares one of ``slots`` groups with others. Parts of other keys meet two by
    two (x < y) or alone (x = y), each in a group of its own: no group is
    larger than two parts, and none compares pairs of another.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), F.col(parts)).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(parts).cast("int") - 1)))
    rows = rows.withColumns({"x": F.least("part", "_other"), "y": F.greatest("part", "_other")})
    shared = F.pmod(F.xxhash64(F.lit("slot"), key), F.lit(slots))
    slot = F.when(F.col(parts) > 1, F.col(key)).otherwise(shared)
    return rows.withColumns({"slot": slot, "many": F.col(parts) > 1}).drop("_other", parts)


def soft_links(buckets: DataFrame, comps: DataFrame, reps: DataFrame, least_size: float) -> DataFrame:
    """Pairs of components (a, b) that some bucket shows to be alike by sketch.

    Buckets of one component have nothing left to link. Of the others all rows of
    different components are compared, in parts of BUCKET_ROWS two by two.
    Pairs already joined in a group are not compared again, and only pairs that
    join two components there are returned: fewer than a group has components,
    however many pairs are alike.
    """
    labelled = stored(
        buckets.join(comps.withColumnRenamed("node", "_n"), F.col("rep") == F.col("_n"), "left")
        .select("key", "rep", "members", F.coalesce("component", "rep").alias("component")), "neardup-labelled")
    still = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    live = stored(labelled.join(still.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi"), "neardup-live")
    rows = live.join(reps.select(F.col("rep").alias("r"), "n", "sketch"), F.col("rep") == F.col("r"))
    rows = dealt(rows.withColumn("parts", F.ceil(F.col("members") / BUCKET_ROWS)), "key", "parts", live.count() // SLOT_ROWS + 1)
    rows = rows.select(*SLOT, "key", "part", "component", "n", "sketch")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "part", "component"], kind="stable")
        labels, comp = np.unique(group["component"].to_numpy(), return_inverse=True)
        n, sketch = group["n"].to_numpy(), np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group), -1)
        bucket, part, found = group["key"].to_numpy(), group["part"].to_numpy(), Groups(len(labels))
        two = int(group["x"].iloc[0]) != int(group["y"].iloc[0])
        a_out, b_out = [], []

        def link(a: np.ndarray, b: np.ndarray) -> None:
            root = found.roots()
            new = root[comp[a]] != root[comp[b]]
            a, b = a[new], b[new]
            for lo in range(0, len(a), 1 << 15):
                x, y = a[lo : lo + (1 << 15)], b[lo : lo + (1 << 15)]
                ok = _alike(sketch, n, x, y, least_size)
                x, y = comp[x[ok]], comp[y[ok]]
                did = found.join(x, y)
                a_out.extend(labels[x[did]].tolist())
                b_out.extend(labels[y[did]].tolist())

        if two:  # the rows of one part, against those of the other
            first = int(np.searchsorted(part, part[-1]))
            for row in range(first, len(part)):
                link(np.full(first, row), np.arange(first))
            return pd.DataFrame({"a": a_out, "b": b_out}, dtype="int64")
        runs = _runs(bucket)
        size = np.concatenate([np.full(hi - lo, hi - lo) for lo, hi in runs])
        at = np.flatnonzero(size <= 64)
        for step in range(1, 64):
            at = at[at + step < len(bucket)]
            at = at[bucket[at] == bucket[at + step]]
            if not len(at):
                break
            link(at, at + step)
        for lo, hi in runs:
            if hi - lo > 64:
                for row in range(lo + 1, hi):
                    # Rows are in order of their components: those before, of others, are a prefix.
                    before = lo + int(np.searchsorted(comp[lo:row], comp[row]))
                    if before > lo:
                        link(np.full(before - lo, row), np.arange(lo, before))
        return pd.DataFrame({"a": a_out, "b": b_out}, dtype="int64")

    return stored(rows.groupBy(*SLOT).applyInPandas(compare, "a long, b long").distinct(), "neardup-soft")


def cross_links(clusters: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between documents of one cluster (node, component) and different ``comps``, on full sets.

    Clusters of one component have nothing left to link. All pairs of another
    cluster's documents that are of different components are verified: parts of
    BLOCK documents and BLOCK_BYTES two by two, each document's set sent once a
    part. Of the links found, those that join two components in the group are returned.
    """
    labelled = stored(
        clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster"))
        .join(comps.withColumnRenamed("node", "_n"), F.col("id") == F.col("_n"), "left")
        .select("id", "cluster", F.coalesce("component", "id").alias("component")), "neardup-clustered")
    still = labelled.groupBy("cluster").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    live = stored(labelled.join(still.select(F.col("cluster").alias("k")), F.col("cluster") == F.col("k"), "left_semi"), "neardup-live")
    members = stored(
        sets.join(small(live, live.count()), F.col("rep") == F.col("id")).select("cluster", "component", "rep", "shingles"), "neardup-members")
    sizes = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.length("shingles")) / BLOCK_BYTES)).alias("parts")).withColumnRenamed("cluster", "_k")
    total = members.agg(F.sum(F.length("shingles"))).first()[0] or 0
    rows = dealt(members.join(sizes, F.col("cluster") == F.col("_k")).drop("_k"), "cluster", "parts", total // SLOT_BYTES + 1)

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, x, y), part in group.groupby(["cluster", "x", "y"], sort=True):
            part = part.sort_values("rep")
            rep, comp = part["rep"].to_numpy(), np.unique(part["component"].to_numpy(), return_inverse=True)[1]
            side, sets = part["part"].to_numpy(), [np.frombuffer(s, "<u8") for s in part["shingles"]]
            n = np.array([len(s) for s in sets])
            flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
            first, found = np.cumsum(n) - n, Groups(comp.max() + 1)
            has = np.zeros(flat.max() + 1, np.int64)
            for i in range(len(rep)):
                root = found.roots()
                if x == y:
                    others = np.arange(i + 1, len(rep))
                else:
                    others = np.flatnonzero(side != side[i]) if side[i] == x else np.zeros(0, np.int64)
                others = others[root[comp[others]] != root[comp[i]]]
                others = others[100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])]
                if not len(others):
                    continue
                own = flat[first[i] : first[i] + n[i]]
                has[own] = 1
                lengths = n[others]
                starts = np.cumsum(lengths) - lengths
                place = np.repeat(first[others] - starts, lengths) + np.arange(lengths.sum())
                both = np.add.reduceat(has[flat[place]], starts)
                has[own] = 0
                linked = others[100 * both >= percent * (n[i] + lengths - both)]
                did = found.join(np.full(len(linked), comp[i]), comp[linked])
                out += [(rep[i], rep[linked[d]]) for d in did]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return stored(rows.groupBy(*SLOT).applyInPandas(verify, "a long, b long"), "neardup-cross")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """Which documents are near copies, as classes: doc_id, set_key, n_shingles, component_id, kept.

    ``docs`` needs doc_id and text; other columns are ignored. Words are runs of
    anything but ASCII white space, A-Z lower-cased. A document's set is its
    distinct shingles of ``words`` words, or its whole sequence if shorter.
    Documents are linked if 100 * intersection >= percent * union; component_id
    is the smallest doc_id reachable, and the document of that id is kept.

    Texts that are NULL or without words have empty sets and link with nothing. A
    document without an id links with nothing either: its component_id is NULL
    and it is kept. Rows that share an id are linked each by its own set. An empty
    table gives an empty result.

    Scale: equal sets are one representative from the start. Representatives
    that share a table bucket with others are linked by verifying, first, each
    with its buckets' smallest, then all pairs still in different components
    within clusters that buckets show to be alike. Clusters grow first from the pairs with
    buckets' smallest alone, so later only buckets of several clusters are compared, large ones in parts two by two.
    Documents that are alike by sketch and yet not linked are verified pair by pair:
    quadratic work in each such cluster, in groups of bounded size. Sketches agree on
    LEAST_AGREEMENT at least before full sets are fetched. A pair at the threshold shares no bucket with
    probability 1e-4, one of similarity 0.85 with 3e-6.
    """
    rows = sketches(docs, words)
    known = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    reps = stored(
        known.groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "halves", "sketch")).alias("r"))
        .select("set_key", F.col("r.doc_id").alias("rep"), "r.n", "r.halves", "r.sketch"), "neardup-reps")
    buckets = buckets_of(reps)
    least_size = percent / 100
    light = reps.select("rep", "n", "sketch")
    star = (
        buckets.where("rep <> centre").select("rep", "centre").distinct()
        .join(light.toDF("a", "a_n", "a_sketch"), F.col("rep") == F.col("a"))
        .join(light.toDF("b", "b_n", "b_sketch"), F.col("centre") == F.col("b"))
        .where(F.least("a_n", "b_n") >= least_size * F.greatest("a_n", "b_n"))
        .where(F.pandas_udf(_agree, "double")("a_sketch", "b_sketch") >= LEAST_AGREEMENT)
        .select("a", "b")
    )
    star = stored(star, "neardup-star")
    involved = buckets.select(F.col("rep").alias("id")).distinct()
    involved = stored(involved, "neardup-involved")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = as_bytes(batch["text"])
            for part in chunks([len(t) for t in texts], CHUNK):
                sets, sizes = shingle_sets(texts[part], words)
                stop = np.cumsum(sizes)
                ids = batch["doc_id"].iloc[part].tolist()
                key = [f"{int(np.add.reduce(sets[e - n:e])):016x}{int(np.bitwise_xor.reduce(mixed(sets[e - n:e] + _STEP))):016x}" for n, e in zip(sizes, stop)]
                yield pd.DataFrame({"rep": ids, "key": key, "shingles": [sets[e - n:e].astype("<u8").tobytes() for n, e in zip(sizes, stop)]})

    sets = docs.select("doc_id", "text").join(small(involved, involved.count()), F.col("doc_id") == F.col("id"), "left_semi")
    sets = sets.mapInPandas(sets_of, "rep long, key string, shingles binary")
    # Of rows that share an id, the set is that of the representative.
    sets = stored(sets.join(small(reps.select(F.col("rep").alias("r"), "set_key").join(involved, F.col("r") == F.col("id"), "left_semi"), involved.count()),
                            (F.col("rep") == F.col("r")) & (F.col("key") == F.col("set_key"))).select("rep", "shingles"), "neardup-sets")
    links = verified(star, sets, percent)
    firsts = stored(components(links, "neardup-components"), "neardup-firsts")
    near = stored(components(star, "neardup-components"), "neardup-near")
    soft = soft_links(buckets, near, light, least_size)
    clusters = components(near.toDF("a", "b").unionByName(soft), "neardup-components")
    links = links.unionByName(cross_links(clusters, firsts, sets, percent))
    comps = stored(components(links, "neardup-components"), "neardup-classes")
    classes = reps.select("set_key", "rep").join(comps, F.col("rep") == F.col("node"), "left").select(
        F.col("set_key").alias("_key"), F.coalesce("component", "rep").alias("_component"))
    return (
        rows.select("doc_id", "n", "set_key").join(classes, (F.col("set_key") == F.col("_key")) & F.col("doc_id").isNotNull(), "left")
        .withColumn("component_id", F.coalesce("_component", "doc_id"))
        .select("doc_id", "set_key", F.col("n").alias("n_shingles"), "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each class of near copies: the one of smallest doc_id.

    All columns and rows without an id stay. Repeated rows (same id and text) are
    one document.
    """
    found = near_duplicates(docs, words, percent).where(F.col("doc_id").isNotNull())
    ids = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    ids = stored(ids.where("rows > 1 or not kept"), "neardup-decisions")
    gone = ids.where("not kept").select(F.col("doc_id").alias("_gone"))
    left = docs.join(small(gone, gone.count()), F.col("doc_id") == F.col("_gone"), "left_anti")
    again = ids.where("rows > 1").select(F.col("doc_id").alias("_again"))
    n = again.count()
    if not n:
        return left
    same = F.col("doc_id") == F.col("_again")
    return left.join(small(again, n), same, "left_anti").unionByName(
        left.join(small(again, n), same, "left_semi").dropDuplicates(["doc_id", "text"])
    )
