"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small, stored, word_count

#: Ranges of the rank whose sizes are summed before any row is ranked: so many at least, and one for so many rows.
RANK_BINS = 1024
ROWS_PER_BIN = 1 << 16


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, max_copies: int
) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    Sources in code-point order, NULL last, take ``weights`` in turn and share
    ``share`` times the total size in proportion to them. No target exceeds
    ``max_copies`` times its source's size; the excess goes to the others by
    weight. With the sources in order of the level at which they reach their
    limit, that is one running sum: the first k are at their limit where k is
    the last place whose level does not exceed what the rest could then get.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight_list = F.array(*[F.lit(float(w)) for w in weights])
    level = Window.orderBy("limit_level", F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (
        totals.withColumn("place", F.row_number().over(place) - 1)
        .withColumn("weight", F.get(weight_list, F.col("place") % len(weights)))
        .withColumn("limit", (F.col("source_size") * max_copies).cast("double"))
        .withColumn("limit_level", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(whole) * float(share))
        .withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("weights_from", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("common_level", (F.col("budget") - F.col("limits_before")) / F.col("weights_from"))
        .withColumn("at_limit", F.col("limit_level") <= F.col("common_level"))
        # The level of the first source that stays below its limit holds for all after it.
        .withColumn("level", F.min(F.when(~F.col("at_limit"), F.struct("limit_level", "place", "common_level"))).over(whole))
    )
    return ranked.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("at_limit"), F.col("limit"))
        .otherwise(F.col("weight") * F.col("level.common_level"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_copies: int = 2,
    seed: str = "mix",
    carry: Sequence[str] = (),
) -> DataFrame:
    """How many copies of each document a mix of the sources takes.

    ``docs`` needs doc_id, source and text; other columns are ignored. Every
    row counts as a document of its own, repeated ids included. Returns doc_id,
    source, size (words), source_size, target (words, of its source), whole
    (certain copies), rank_key, copies.

    Each document of a source gets ``floor(target / source_size)`` whole copies
    for certain. The rest of the target is drawn by Pareto order sampling with
    probabilities of the documents' own: a document's inclusion odds p / (1 - p) are those of its source
    (left over words to all words) times its size over the source's mean size. With a
    uniform number u it ranks by ``(u / (1 - u)) / (p / (1 - p))`` (``rank_key``) and the lowest ranks are taken until their
    words reach what is left, to within half a document. u is derived from
    the id and ``seed``, so reruns agree; ties go by id, then by size, then by ``carry``.

    NULL text has size 0, takes the whole copies of its source and none beyond. A NULL source is a
    source. An empty table gives an empty result; a source without words has
    target 0 and takes nothing. Columns named in ``carry`` are returned too.

    Scale: words are counted once. A rank is found without sorting a source:
    sums by source and range of the rank say which range the cut falls in, and only
    that range, of some ROWS_PER_BIN rows, is ordered.
    """
    sizes = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        *carry,
        F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")), 1, 12).alias("_hex"),
    ).withColumn(
        "_u", (F.conv("_hex", 16, 10).cast("double") + 0.5) / float(2**48)
    ).drop("_hex")
    sizes = stored(sizes, "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, max_copies), "mix-targets")
    plan = (
        targets.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor("ratio").cast("int"))
        .withColumn("p", F.col("ratio") - F.col("whole"))
        .withColumn("left_over", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    # Odds over odds, but for the source's own odds, which change no order; between 0 and 1 as place in the ranges.
    counts = sizes.groupBy("source").agg(F.count("*").alias("_docs")).withColumnRenamed("source", "_of")
    total = targets.join(counts, F.col("source").eqNullSafe(F.col("_of"))).select("_of", (F.col("source_size").cast("double") / F.col("_docs")).alias("_mean"))
    bins = max(RANK_BINS, -(-sizes.count() // ROWS_PER_BIN))
    key = F.when(F.col("size") > 0, (F.col("_u") / (1 - F.col("_u"))) * (F.col("_mean") / F.col("size")))
    total = stored(total, "mix-means")
    sizes = sizes.join(small(total, total.count()), F.col("source").eqNullSafe(F.col("_of"))).withColumn("_key", key).drop("_of", "_mean", "_u")
    sizes = sizes.withColumn("_bin", F.coalesce(F.floor(F.col("_key") / (1 + F.col("_key")) * bins), F.lit(bins)).cast("int"))
    upto = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        sizes.groupBy("source", "_bin").agg(F.sum("size").alias("bin_size"))
        .withColumn("bin_before", F.coalesce(F.sum("bin_size").over(upto), F.lit(0)))
    )
    cut = plan.alias("t").join(bins.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")))
    cut = stored(
        cut.where((F.col("bin_before") < F.col("left_over")) & (F.col("bin_before") + F.col("bin_size") >= F.col("left_over")))
        .select(F.col("t.source").alias("source"), F.col("_bin").alias("cut_bin"), F.col("bin_before").alias("cut_before")),
        "mix-cuts",
    )
    per_source = plan.alias("t").join(cut.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("t.source").alias("_source"), "source_size", "target", "whole", "p", "left_over", "cut_bin", "cut_before"
    )
    rows = sizes.join(small(per_source, total.count()), F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "rank_key",
        F.when(F.col("p") > 0, F.col("_key") / (F.col("p") / (1 - F.col("p")))),
    )
    inside = F.col("_bin") == F.col("cut_bin")
    sure = rows.where(~F.coalesce(inside, F.lit(False))).withColumn(
        "extra", F.coalesce(F.col("_bin") < F.col("cut_bin"), F.lit(False)) & (F.col("left_over") > 0)
    )
    order = Window.partitionBy("source", "_bin").orderBy(F.col("_key").asc_nulls_last(), "doc_id", "size", *carry)
    ranked = rows.where(inside).withColumn(
        "_before", F.col("cut_before") + F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("extra", F.col("_before") + F.col("size") / 2 <= F.col("left_over")).drop("_before")
    return sure.unionByName(ranked).select(
        "doc_id", "source", *carry, "size", "source_size", "target", "whole", "rank_key",
        (F.col("whole") + F.col("extra").cast("int")).alias("copies"),
    )


def take_copies(docs: DataFrame, **options) -> DataFrame:
    """The mixed table itself: ``docs`` with each row as often as the mix takes it.

    Where ids are repeated, rows are stored with a number and taken by it, so that
    each has copies of its own.
    """
    plan = mix_sources(docs, **options).groupBy("doc_id").agg(F.max("copies").alias("_copies"), F.count("*").alias("_rows"))
    plan = stored(plan.withColumnRenamed("doc_id", "_id"), "mix-copies")
    key, rows = "doc_id", docs
    if plan.where("_rows > 1").limit(1).count():
        key = "_row"
        while key in docs.columns:
            key += "_"
        rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "mix-rows")
        plan = stored(mix_sources(rows, carry=[key], **options).select(F.col(key).alias("_id"), F.col("copies").alias("_copies")), "mix-copies")
    copies = plan.where("_copies > 0").select("_id", "_copies")
    joined = rows.join(small(copies, copies.count()), F.col(key).eqNullSafe(F.col("_id")))
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select(*[rows[c] for c in docs.columns])
