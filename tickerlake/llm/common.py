"""Helpers shared by the operators: tables, folds, words, scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.session import scratch_path

#: A word: a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let a batch for Python tasks have 8 MB rather than Spark's default of 64 MB.

    Rows here are documents or blocks of them, and every task holds a few
    batches in both processes. A session that names another size keeps it.
    """
    if spark.conf.get(ARROW_BYTES, "1b") == "1b":  # not set
        spark.conf.set(ARROW_BYTES, "8MB")


def release_memory() -> None:
    """Give the system back what earlier tasks of this worker process have freed.

    Worker processes serve many tasks; the allocators of Arrow and the C library keep
    freed memory, which counts against the executor while other work needs it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped_texts(docs: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``run`` by ``mapInPandas`` over doc_id and text; returns doc_id and the columns of ``schema``.

    In pandas an id is text: longs beside a NULL would become doubles, which
    hold no id above 2 ** 53.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, f"doc_id string, {schema}")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text modulo ``folds``; a NULL id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


#: Most rows of a table of ids that is sent to every task rather than shuffled (some 16 bytes a row).
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be sent to every task if its counted rows are few enough; else Spark decides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it again.

    Cuts the lineage: what comes after reads files that every executor sees, so
    a lost executor costs no recomputation of ``df``.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
