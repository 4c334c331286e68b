"""One row per key, with a deterministic winner."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.operators.coverage import is_empty_document
from tickerlake.schema import (
    DOC_VERSION,
    FILE_PATH,
    FILE_ROW,
    KEY_COLUMNS,
    LOAD_COLUMNS,
    LOAD_TIME,
    LOCATION_COLUMNS,
    PAYLOAD_COLUMNS,
    RENAMES,
)
from tickerlake.session import scratch_path

#: Most repeated keys whose hashes (8 bytes each) are sent to every task.
REPEATED_KEYS = 2_000_000
#: Rows of a file that one bitmap (4 KB) marks: what ``bitmap_construct_agg`` holds.
BITMAP_ROWS = 32_768
#: Most bitmaps that are sent to every task.
SENT_BITMAPS = 20_000

FLAT_PAYLOAD = [RENAMES.get(n, n) for n in PAYLOAD_COLUMNS]


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str] = tuple(KEY_COLUMNS),
    order: Sequence[str | Column] | None = None,
    fewer: Callable[[], DataFrame | None] | None = None,
) -> DataFrame:
    """Keep, per key, the row that is first in ``order`` (ascending, NULLs first).

    ``order`` holds plain column expressions compared ascending, NULL lowest
    (write ``-x`` for a descending number, ``x.isNull()`` first to put NULLs
    last); sort directions such as ``x.desc()`` are not accepted. It defaults
    to every non-key column, so the winner is a total function of the rows
    whatever their arrival order.

    Rows of a key that occurs once need no comparison and are not shuffled: a
    first pass counts hashes of the keys and nothing else, when this is called,
    and hashes that repeat are sent to the tasks. Keys that share a hash are
    only taken for repeated. Columns the caller drops are not read for these rows.

    Rows of the other keys, or all where more than ``REPEATED_KEYS`` repeat, meet by
    ``min(struct(order…, row))`` per key rather than a
    ``row_number`` window: the minimum is an aggregate, so each map task keeps
    only its local winner per key before the shuffle (partial aggregation).
    A key repeated millions of times — a load retried over and over — costs
    one row per map task on the wire, never one task holding the whole group.

    ``fewer``, if given, is asked first where that many keys repeat: for the rows of ``df`` without some
    that are not first in ``order`` (``None`` if it cannot say), of which the same is made then.
    """
    keys = list(keys)
    others = [n for n in df.columns if n not in keys]
    first = list(order) if order is not None else others
    # Columns named in the order lead the struct as themselves: no value travels twice.
    named = [o for o in first if isinstance(o, str)]
    fields = [F.col(f"`{o}`") if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(first)]
    fields += [F.col(f"`{n}`") for n in others if n not in named]

    def winners(rows: DataFrame) -> DataFrame:
        best = rows.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_w"))
        return best.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"_w.`{n}`").alias(n) for n in others])

    repeated = _repeated_hashes(df, keys)
    n = repeated.count()
    if n > REPEATED_KEYS:
        rows = fewer() if fewer is not None else None
        return winners(df) if rows is None else dedup_by_key(rows, keys, order)
    rows = df.select(*[F.col(f"`{c}`") for c in (*keys, *others)])
    if not n:
        return rows
    found = _hash(keys) == F.col("_repeated")
    alone = rows.join(F.broadcast(repeated), found, "left_anti")
    return alone.unionByName(winners(rows.join(F.broadcast(repeated), found, "left_semi")))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_repeated``: hashes of keys that more than one row has, stored in the scratch folder."""
    hashes = df.select(_hash(keys).alias("_repeated"))
    counted = hashes.groupBy("_repeated").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    path = scratch_path(df.sparkSession, "repeated-keys")
    counted.select("_repeated").write.parquet(path)
    return df.sparkSession.read.schema("_repeated long").parquet(path)


def latest_load(loads: DataFrame, payload: Sequence[str] = tuple(FLAT_PAYLOAD)) -> DataFrame:
    """R5 over flat rows of several loads: the last load's row of each key.

    Of one load's rows, the later version of the document wins, then one with
    any payload beats an empty one, then the total order decides. The load's columns are dropped.

    Of rows that say where they lie (``sinks.tables.located``), those that another load, version or payload
    beats are found without a shuffle of whole rows where many keys repeat (``_unbeaten``).
    """
    first = [
        -F.coalesce(F.unix_micros(LOAD_TIME), F.lit(0)),
        -F.coalesce(DOC_VERSION, F.lit(0)),
        is_empty_document([c for c in payload if c in loads.columns]),
    ]
    rows = loads.drop(*LOCATION_COLUMNS)
    order = [*first, *(n for n in rows.columns if n not in (*KEY_COLUMNS, *LOAD_COLUMNS))]
    located = set(LOCATION_COLUMNS) <= set(loads.columns)
    fewer = (lambda: _unbeaten(loads, KEY_COLUMNS, first)) if located else None
    return dedup_by_key(rows, order=order, fewer=fewer).drop(*LOAD_COLUMNS)


def _unbeaten(df: DataFrame, keys: Sequence[str], first: Sequence[Column]) -> DataFrame | None:
    """Rows of ``df`` to which no other of their key comes before by ``first``; ``None`` if that takes too many bitmaps.

    Only keys, what ``first`` gives and each row's place in its file are shuffled, when this is called. Rows that
    are beaten are marked by a bit each, in bitmaps by file, and these are sent to the tasks that read the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "files")
    number = F.row_number().over(Window.orderBy(FILE_PATH))  # one row a file
    df.select(FILE_PATH).distinct().select(FILE_PATH, number.alias("_no")).write.parquet(path)
    files = spark.read.schema(f"{FILE_PATH} string, _no int").parquet(path)

    ranks = [x.alias(f"_o{i}") for i, x in enumerate(first)]
    places = df.join(F.broadcast(files), FILE_PATH).select(*[F.col(f"`{k}`") for k in keys], *ranks, "_no", FILE_ROW)
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*[f"_o{i}" for i in range(len(ranks))]))
    part, bit = F.floor(F.col(FILE_ROW) / BITMAP_ROWS).alias("_part"), F.col(FILE_ROW) % BITMAP_ROWS
    marked = places.withColumn("_rank", rank).where("_rank > 1").groupBy("_no", part)
    path = scratch_path(spark, "beaten-rows")
    marked.agg(F.bitmap_construct_agg(bit).alias("_bits")).join(F.broadcast(files), "_no").select(
        F.col(FILE_PATH).alias("_of"), "_part", "_bits"
    ).write.parquet(path)
    bitmaps = spark.read.schema("_of string, _part long, _bits binary").parquet(path)
    if bitmaps.count() > SENT_BITMAPS:
        return None

    byte = F.substr("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    beaten = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    at = (F.col(FILE_PATH) == F.col("_of")) & (F.floor(F.col(FILE_ROW) / BITMAP_ROWS) == F.col("_part"))
    kept = df.join(F.broadcast(bitmaps), at, "left").where(~F.coalesce(beaten, F.lit(False)))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns if c not in LOCATION_COLUMNS])


def duplicate_keys(df: DataFrame, keys: Sequence[str] = tuple(KEY_COLUMNS)) -> DataFrame:
    """Keys that occur more than once, with their counts (partial aggregation)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
