"""Merkle manifest of a dataset: nodes labelled by the leaf ranks they cover, proofs by containment joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, stored

#: Children of a node.
RUN = 3
#: Levels of nodes that one grouping makes: groups of RUN ** STOREY nodes.
STOREY = 4

_POWERS = [RUN**k for k in range(40)]
_PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(columns: list[Column]) -> Column:
    """Digest of a row: of each column '-' if NULL, else its UTF-8 byte count, ':' and its text."""
    texts = [c.cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _numbered(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, Column]:
    """``rows`` sorted and stored, and their place in the order, gapless from 0.

    Ranges are dealt by all of ``order``; each range's first place is the sum of
    the ranges before it, one count a range.
    """
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = sorted((r["part"], r["n"]) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    firsts, total = [], 0
    for p, n in counts:
        firsts.append((p, total))
        total += n
    spark = rows.sparkSession
    offsets = spark.createDataFrame(firsts, "part long, first long")
    placed = rows.withColumn("part", part).join(F.broadcast(offsets), "part")  # a row a range
    return placed.withColumn("place", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "first", "at"), F.col("place")


def ranked_leaves(leaves: DataFrame, tree: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Leaves with ``tree_no``, ``lo`` (rank in their tree) and ``n`` (leaves of it); and one row a tree.

    ``tree`` is a column, trees are numbered in its order, NULL first.
    """
    rows, place = _numbered(leaves, [tree, *order], f"{name}-leaves")
    trees = rows.groupBy(tree).agg(F.min(place).alias("start"), F.count("*").alias("n"))
    numbered, number = _numbered(trees, ["start"], f"{name}-trees")
    trees = stored(numbered.withColumn("tree_no", number).drop("place"), f"{name}-numbers")
    key = trees.withColumnRenamed(tree, "tree_key")
    rows = rows.join(key, rows[tree].eqNullSafe(F.col("tree_key")))
    rows = rows.withColumn("lo", F.col("place") - F.col("start")).drop("place", "start", "tree_key")
    return stored(rows, f"{name}-ranked"), trees


def _joined(below: str, there: Column) -> Column:
    """Digests of the runs of an array of digests; NULL if not ``there``: a tree's root has no node above it."""
    runs = F.sequence(F.lit(0), F.expr(f"cast((size({below}) - 1) div {RUN} as int)"))
    return F.when(there, F.transform(runs, lambda i: digest(F.concat_ws("", F.slice(below, i * RUN + 1, F.lit(RUN))))))


def _labelled(digests: str, level: int, first: Column) -> Column:
    """Neighbouring nodes of a level with their intervals' first ranks; none for NULL."""
    made = F.transform(digests, lambda d, i: F.struct(F.lit(level).alias("level"), (first + i * RUN**level).alias("lo"), d.alias("digest")))
    return F.coalesce(made, F.array().cast("array<struct<level: int, lo: bigint, digest: string>>"))


def _storey(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of the ``STOREY`` levels above ``level``, from that level's nodes."""
    top = RUN ** (level + STOREY)
    groups = nodes.where(F.col("n") > RUN**level).groupBy("tree_no", "n", F.expr(f"lo div {top}").alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("lo", "digest"))).alias("below"))
    groups = groups.withColumn("d0", F.transform("below", lambda x: x["digest"]))
    made = []
    for j in range(1, STOREY + 1):
        groups = groups.withColumn(f"d{j}", _joined(f"d{j - 1}", F.col("n") > RUN ** (level + j - 1)))
        made.append(_labelled(f"d{j}", level + j, F.col("bucket") * top))
    return groups.select("tree_no", "n", F.explode(F.concat(*made)).alias("node")).select(
        "tree_no", "n", "node.level", "node.lo", "node.digest")


def nodes_above(leaves: DataFrame, depth: int, name: str) -> list[DataFrame]:
    """Nodes (tree_no, n, lo, digest) of levels 0 to ``depth``; 0 are the leaves.

    A node of level k carries the interval of leaf ranks that it covers: from ``lo``
    as many as RUN ** k, up to ``n``.
    """
    levels = [leaves]
    for level in range(0, depth, STOREY):
        made = stored(_storey(levels[level], level), f"{name}-nodes")
        levels += [made.where(F.col("level") == k).drop("level") for k in range(level + 1, level + STOREY + 1)]
    return levels[: depth + 1]


def _depth(n: Column) -> Column:
    """Level of the root of a tree of ``n`` leaves."""
    return F.size(F.filter(F.array(*[F.lit(p) for p in _POWERS]), lambda p: p < n))


def paths_down(levels: list[DataFrame], roots: DataFrame, carry: list[str], name: str) -> DataFrame:
    """Leaves with ``path``: of each level from the leaf up what its run has before and after the node.

    ``roots`` has tree_no, n and, to be handed down to all leaves, ``path`` (that of the
    tree's root) and ``carry``. Level by level, nodes meet their parent: both are
    bucketed by the parent's width, and the parent's interval contains theirs.
    The parent's interval less the node's own leaves its siblings.
    """
    roots = roots.withColumn("depth", _depth(F.col("n"))).withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.col("n"))
    at = lambda level: roots.where(F.col("depth") == level).select("tree_no", "lo", "hi", "path", *carry)
    above = at(len(levels) - 1)
    for level in range(len(levels) - 2, -1, -1):
        width, parent_width = RUN**level, RUN ** (level + 1)
        extra = [c for c in levels[level].columns if c not in ("tree_no", "n", "lo", "digest")]
        node = F.struct("lo", F.least(F.col("lo") + width, F.col("n")).alias("hi"), "digest", *extra)
        families = levels[level].where(F.col("n") > width).groupBy(
            F.col("tree_no").alias("tree"), F.expr(f"lo div {parent_width}").alias("bucket")).agg(F.sort_array(F.collect_list(node)).alias("family"))
        first, last = F.col("family")[0], F.element_at("family", -1)
        parents = above.withColumn("parent_bucket", F.expr(f"lo div {parent_width}"))
        contains = (F.col("lo") <= first["lo"]) & (last["hi"] <= F.col("hi"))
        met = families.join(parents, (F.col("tree") == F.col("tree_no")) & (F.col("bucket") == F.col("parent_bucket")) & contains)
        met = met.drop("lo", "hi").withColumn("node", F.explode("family"))

        def side(of) -> Column:
            return F.concat_ws("", F.transform(F.filter("family", of), lambda s: s["digest"]))

        step = F.struct(
            side(lambda s: s["hi"] <= F.col("node")["lo"]).alias("before"), side(lambda s: s["lo"] >= F.col("node")["hi"]).alias("after"))
        above = met.select(
            "tree_no", "node.lo", "node.hi", F.concat(F.array(step), F.col("path")).alias("path"), *carry,
            *[F.col("node")[c].alias(c) for c in ["digest", *extra] * (level == 0)])
        # Trees whose root is on this level: they have their path from above.
        here = at(level)
        if level == 0:
            alone = levels[0].where(F.col("n") == 1).select(F.col("tree_no").alias("tree"), "digest", *extra)
            here = here.join(alone, F.col("tree") == F.col("tree_no")).select(*above.columns)
        above = above.unionByName(here)
        if level and level % STOREY == 0:
            above = stored(above, f"{name}-paths")  # a plan has STOREY joins at most
    if len(levels) == 1:
        own = [c for c in levels[0].columns if c not in ("tree_no", "n", "lo")]
        alone = levels[0].select(F.col("tree_no").alias("tree"), *own)
        above = above.join(alone, F.col("tree") == F.col("tree_no")).select("tree_no", "lo", "hi", "path", *carry, *own)
    return above


def _levels(trees: DataFrame) -> int:
    most = trees.agg(F.max("n").alias("n")).first()["n"] or 0
    return next(k for k, p in enumerate(_POWERS) if p >= most)


def _roots(levels: list[DataFrame]) -> DataFrame:
    """tree_no, n, digest of every tree's root."""
    own = [nodes.where(_depth(F.col("n")) == k).select("tree_no", "n", "digest") for k, nodes in enumerate(levels)]
    return reduce(DataFrame.unionByName, own)


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """Merkle tree over documents by source, and each document's proof of being in it.

    A leaf is the digest of doc_id, source, lang, n_chars and text (``leaf``). Leaves of a source
    ascend by doc_id (NULL first; rows of one id by their leaf) and are joined in runs of
    three, level by level; the sources' roots, in their order (NULL first, by bytes), likewise.
    Returns doc_id, source, leaf, ``current`` (the leaf of the row as it is now),
    subroot, root, path (array of before, after: the digests of the siblings at each
    level from the leaf's to the root's), proof_sha256 (digest of all those digests),
    folded_root (``current`` joined with the siblings up to the root) and verified (that it is the root).

    ``docs`` has the columns named above; ``changed`` gives what a row has now in
    some of them. Repeated rows are leaves of their own; NULLs in any column are part of the leaf; other columns are ignored. An
    empty table gives an empty result. Only digests are shuffled, never texts: a source's leaves
    are dealt by rank, so a hot source is many tasks' work, and no group has
    more than RUN ** STOREY nodes.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    now = [(changed or {}).get(c, F.col(c)) for c in names]
    rows = docs.select("doc_id", "source", leaf([F.col(c) for c in names]).alias("digest"), leaf(now).alias("current"))
    # Equal rows are told apart by a number, so that many of them fill many ranges.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "manifest-rows")
    leaves, sources = ranked_leaves(rows, "source", ["doc_id", "digest", "row"], "manifest")
    own = leaves.select("tree_no", "n", "lo", "digest", "doc_id", "source", "current")
    levels = nodes_above(own, _levels(sources), "manifest")
    subroots = stored(_roots(levels), "manifest-subroots")

    count = sources.count()
    forest = subroots.select(F.lit(0).cast("long").alias("tree_no"), F.lit(count).cast("long").alias("n"), F.col("tree_no").alias("lo"), "digest", F.col("n").alias("leaves"))
    upper = nodes_above(forest, next(k for k, p in enumerate(_POWERS) if p >= count), "manifest-sources")
    whole = _roots(upper).select(F.col("tree_no"), "n", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    tops = paths_down(upper, whole, ["root"], "manifest-sources")
    roots = stored(tops.select(F.col("lo").alias("tree_no"), F.col("leaves").alias("n"), F.col("digest").alias("subroot"), "root", "path"), "manifest-tops")

    proofs = paths_down(levels, roots, ["subroot", "root"], "manifest")
    siblings = F.concat_ws("", F.transform("path", lambda p: F.concat(p["before"], p["after"])))
    folded = F.aggregate("path", F.col("current"), lambda node, p: digest(p["before"], node, p["after"]))
    return proofs.select(
        "doc_id", "source", F.col("digest").alias("leaf"), "current", "subroot", "root", "path",
        digest(siblings).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_feeds() -> dict[str, Column]:
    """A tampered text: without its line feeds where the id's crc32 is even (a NULL id counts as '')."""
    return {"text": F.when(fold(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
