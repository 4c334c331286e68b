"""A training corpus from ``documents``: language, near copies, repeats, mix, packed sequences.

Each stage takes what the one before kept, as written and read again. All but the
last return the columns of ``documents``; the last returns the pieces of
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import fold, stored, table
from tickerlake.llm.langid import fit_languages, keep_identified
from tickerlake.llm.mixing import take_copies
from tickerlake.llm.neardup import drop_near_duplicates
from tickerlake.llm.packing import pack_documents
from tickerlake.llm.queries import tokenizer_path
from tickerlake.llm.suffix_dedup import without_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters or a likely language go."""
    model = fit_languages(docs.where(fold(F.col("doc_id")) != 0).select("text", "lang"))
    return keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity 0.8)."""
    return drop_near_duplicates(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document of smaller id has too."""
    return without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return take_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: Trained models, tokenizers and graphs of links are beyond SQL: tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
