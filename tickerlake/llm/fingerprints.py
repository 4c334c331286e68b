"""Document fingerprints: Merkle trees over sections, paragraphs and blocks of text.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: A section starts at a blank line or a heading; the line feed before it ends the last one.
SECTION_BREAK = r"\n(?=[ \t]*\n|#)"
#: Code points of a paragraph's block, the tree's leaf.
BLOCK_CHARS = 32
_HEX = 12


def _digest(text: Column, digits: int) -> Column:
    return F.substring(F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0")), 17 - digits, digits)


def _paragraph(paragraph: Column) -> Column:
    blocks = F.regexp_extract_all(paragraph, F.lit("(?s).{1,%d}" % BLOCK_CHARS), F.lit(0))
    leaves = F.array_join(F.transform(blocks, lambda b: F.concat(F.lit("."), _digest(b, 6))), "")
    return F.concat(F.substring(F.sha1(paragraph.cast("binary")), 1, _HEX), leaves)


def _section(section: Column) -> Column:
    return F.array_join(F.transform(F.split(section, "\n", -1), _paragraph), ";")


def _node(children: Column, digits: int, mark: str) -> Column:
    """A node's digest over the string of all below it, then that string."""
    return F.concat(F.substring(F.sha2(children.cast("binary"), 256), 1, digits), F.lit(mark), children)


def fingerprint(text: Column) -> Column:
    """The Merkle tree of a text as a string; NULL counts as the empty text.

    ``root:section|section|...``, a section ``digest=paragraph;paragraph;...``, a
    paragraph ``digest.leaf.leaf...`` with one leaf per 32 code points. A
    paragraph's digest is of its text, a section's and the root's of their
    children's digests. Splitting loses no character, so equal roots mean equal
    texts and, from the root down, differing branches lead to the edited blocks.
    """
    sections = F.transform(F.split(F.coalesce(text, F.lit("")), SECTION_BREAK, -1), _section)
    joined = F.array_join(F.transform(sections, lambda s: _node(s, _HEX, "=")), "|")
    return F.get(F.transform(F.array(joined), lambda s: _node(s, 32, ":")), 0)


def root(fp: Column) -> Column:
    return F.substring_index(fp, ":", 1)


def leaves(fp: Column) -> Column:
    """Digests of a fingerprint's leaves in order of the text."""
    return F.regexp_extract_all(fp, F.lit("[.]([0-9a-f]{6})"), F.lit(1))


def likeness(a: Column, b: Column) -> Column:
    """1 where roots agree, else twice the shared distinct leaves over both counts of them."""
    left, right = F.array_distinct(leaves(a)), F.array_distinct(leaves(b))
    both = F.size(left) + F.size(right)
    shared = F.size(F.array_intersect(left, right))
    return F.when(root(a) == root(b), F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(2.0 * shared / both)


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Places (section.paragraph, from 0) in ``b`` whose branch is not in ``a``."""
    def nodes(fp: Column) -> Column:
        return F.regexp_extract_all(fp, F.lit("[=;]([0-9a-f]{12})"), F.lit(1))

    known = nodes(a)
    sections = F.split(F.substring_index(b, ":", -1), "[|]")
    return F.flatten(F.transform(sections, lambda s, i: F.filter(
        F.transform(F.split(F.substring_index(s, "=", -1), ";"), lambda p, j: F.when(
            ~F.array_contains(known, F.substring(p, 1, _HEX)), F.concat(i.cast("string"), F.lit("."), j.cast("string")))),
        lambda place: place.isNotNull())))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """fp of each text, and next_text and next_fp of the next lower doc_id; the last's is the first.

    ``docs`` has doc_id and text (not NULL). Rows of one doc_id follow each other
    by text, NULL ids come last. Ranges of doc_id, split at sampled quantiles,
    are ordered each in its own task; a range's last row takes the first row of
    the next range.
    """
    cuts = [] if parts < 2 else docs.select(
        F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts).alias("q")
    ).first()["q"] or []
    bounds = sorted(set(cuts))
    ranged = docs.withColumn("_range", F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0))
    firsts = ranged.groupBy("_range").agg(F.max("doc_id").alias("_first")).withColumnRenamed("_range", "_r")
    heads = (
        # A row a range: left to a size estimate, all texts would be shuffled to meet these few.
        ranged.join(F.broadcast(firsts), (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi")
        .groupBy("_range").agg(F.min("text").alias("text"))
        .withColumn("head", F.struct("text", fingerprint(F.col("text")).alias("fp")))
    )
    down = Window.orderBy(F.col("_range").desc())
    everything = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = stored(heads.select(
        F.col("_range").alias("_r"),
        F.coalesce(F.lead("head").over(down), F.first("head").over(everything)).alias("_head"),
    ), "fingerprint-heads")
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").asc()]
    within = Window.partitionBy("_range").orderBy(*order)
    # Texts are shuffled and sorted without their fingerprints, which the tasks make that put them in order.
    laid = ranged.repartition("_range").sortWithinPartitions("_range", *order)
    rows = laid.withColumn("fp", fingerprint(F.col("text"))).withColumn("_next", F.lead(F.struct("text", "fp")).over(within))
    return rows.join(heads, F.col("_range") == F.col("_r"), "left").withColumn(
        "_next", F.coalesce("_next", "_head")
    ).select("doc_id", "text", "fp", F.col("_next.text").alias("next_text"), F.col("_next.fp").alias("next_fp"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its text with the last third replaced.

    ``docs`` needs doc_id and text; other columns are ignored. The last
    floor(n_chars / 3) code points give way to the first as many (or all) of
    the next document in descending doc_id, after the last one the first.
    Returns doc_id, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next.

    NULL text is the empty text. A single document is its own next. Rows that
    share a doc_id are separate documents, in the order of their texts. An empty
    table gives an empty result.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), parts)
    n = F.length("text")
    replaced = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - replaced), F.substr("next_text", F.lit(1), replaced))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited_text"), F.col("fp").alias("fingerprint"), "next_fp")
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited_text")))
    return rows.select(
        "doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"),
    )
