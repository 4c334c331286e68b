"""Q5: the daily load, end to end.

read landed documents (S1) → skip empty ones (F5) → transform (P9) → flat
table (K1) → last load of each key (R5) → upsert the fact table (K3) → fold
into the dimension (K4) → archive the dates (K7) → ledger rows (K8). A failure
anywhere writes FAILED rows and re-raises.

One call may load one date (the daily run) or many (a backfill) — both are
one Spark job per stage, never a driver loop over dates.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerlake.functions.features import transform
from tickerlake.operators.coverage import CORRUPT_TEXT, is_empty_document, quarantined
from tickerlake.operators.dedup import latest_load
from tickerlake.operators.ledger import FAILED, LOADED, SUCCESS, loaded_not_done
from tickerlake.plans.views import refresh_catalog
from tickerlake.schema import (
    DIMENSION_COLUMNS,
    FLAT_STORED_SCHEMA,
    KEY_COLUMNS,
    LOAD_COLUMNS,
    LOAD_ID,
    LOCATION_COLUMNS,
    PAYLOAD_COLUMNS,
    UPDATE_COLUMNS_FULL,
)
from tickerlake.session import scratch_path
from tickerlake.sinks.landing import archive_dates
from tickerlake.sinks.latest import update_latest
from tickerlake.sinks.ledger import log_run, read_ledger
from tickerlake.sinks.tables import (
    located,
    read_dates,
    read_flat_loads,
    refresh_dimension,
    table_exists,
    update_dimension,
    upsert_fact,
    write_flat,
)
from tickerlake.sinks.trends import update_trends
from tickerlake.sources.snapshots import landed_files, read_all_snapshots, read_snapshots

DAG_ID = "daily_snapshot_load"


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of one deployment live (any Hadoop-compatible URI)."""

    root: str

    @property
    def flat(self) -> str:
        return f"{self.root}/flat"

    @property
    def fact(self) -> str:
        return f"{self.root}/fact"

    @property
    def dimension(self) -> str:
        return f"{self.root}/dimension"

    @property
    def latest(self) -> str:
        return f"{self.root}/latest"

    @property
    def trends(self) -> str:
        return f"{self.root}/trends"

    @property
    def stages(self) -> str:
        """Ledger rows of runs that have loaded their dates and not finished yet."""
        return f"{self.root}/stages"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"


@dataclass(frozen=True)
class LoadResult:
    """What a load did: its dates, documents read, and those skipped as empty."""

    dates: tuple[dt.date, ...]
    documents: int
    empty: int


def usable_documents(raw: DataFrame, seen: Observation) -> DataFrame:
    """``raw`` without documents that carry nothing — a failed fetch landed
    as ``{}``, or a truncated file. They are counted on the way."""
    empty = is_empty_document([c for c in PAYLOAD_COLUMNS if c in raw.columns])
    counts = (F.count(F.lit(1)).alias("documents"), F.count(F.when(empty, 1)).alias("empty"))
    return raw.observe(seen, *counts).where(~empty)


def dimension_history(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Date and descriptive columns of the last load of each key, over all dates."""
    columns = list(dict.fromkeys([*KEY_COLUMNS, *DIMENSION_COLUMNS, *LOAD_COLUMNS]))
    return latest_load(located(read_flat_loads(spark, warehouse.flat)).select(*columns, *LOCATION_COLUMNS))


def fold_dimension(
    spark: SparkSession, warehouse: Warehouse, rows: DataFrame, dates: Sequence[dt.date], mode: str, refresh: str
) -> None:
    """K4 after a load: ``full`` (rebuilt from the flat history, as the warehouse
    statement does) or ``incremental`` (the loaded rows folded in)."""
    history = dimension_history(spark, warehouse)
    if refresh == "full":
        refresh_dimension(history, warehouse.dimension, mode)
    else:
        update_dimension(spark, rows, warehouse.dimension, history, dates, mode)


def _landed(spark: SparkSession, raw_base: str, days: Sequence[dt.date] | None) -> dict[dt.date, tuple[int, dt.datetime]]:
    """Documents and time of the newest of each date that has any: one value a day."""
    named = None if days is None else [d.isoformat() for d in days]
    found = table_exists(lambda: landed_files(spark, raw_base, named))
    return {} if found is None else {r[0]: (r[1], r[2]) for r in found.collect()}


def _resumable(
    spark: SparkSession, warehouse: Warehouse, dag_id: str, days: Sequence[dt.date], landed: dict
) -> tuple[list[dt.date], list[dt.date]]:
    """Of ``days``: those an earlier run has loaded but not archived, without newer documents;
    and those of the others whose documents came after such a run."""
    stages = table_exists(lambda: read_ledger(spark, warehouse.stages))
    if stages is None:
        return [], []
    ledger = table_exists(lambda: read_ledger(spark, warehouse.ledger))
    runs = (stages if ledger is None else stages.unionByName(ledger)).where(F.col("process_date").isin(list(days)))
    done, late = [], []
    for r in loaded_not_done(runs, dag_id).collect():  # one value a day
        newest = landed.get(r["process_date"], (0, None))[1]
        (late if newest is not None and newest > r["loaded_ts"] else done).append(r["process_date"])
    return done, late


def run_daily_load(
    spark: SparkSession,
    raw_base: str,
    warehouse: Warehouse,
    process_dates: str | Iterable[str] | None = None,
    update_columns: Sequence[str] = tuple(UPDATE_COLUMNS_FULL),
    flat_mode: str = "replace_dates",
    dimension_mode: str = "latest",
    dimension_refresh: str = "incremental",
    dag_id: str = DAG_ID,
    archive_base: str | None = None,
    catalog: str | None = None,
    maintain_latest: bool = False,
    quarantine: bool = False,
    maintain_trends: int | None = None,
) -> LoadResult:
    """Load ``process_dates`` (a date, a list, or ``None`` for every date that
    has landed documents) from ``raw_base`` into the warehouse tables.

    The flat rows are written once and read back from parquet for the
    upsert: the raw JSON is scanned exactly once, and the upsert's lineage
    starts at the compact flat files, not at thousands of small documents. How many
    documents a date has is known from the listing and decides by how many tasks it is written.

    ``dimension_refresh`` is ``incremental`` (daily cost proportional to the
    number of tickers) or ``full`` (rebuilt from the whole flat history); both
    give the same dimension. With ``maintain_latest`` the latest rows a ticker are kept current
    too, with ``maintain_trends`` the moving average and volatility over so many snapshots, with ``quarantine`` documents that carry nothing are listed by date, ticker and reason, from the
    same parse; with ``catalog`` the tables and views of that database. With ``archive_base`` the dates'
    raw folders move there after the tables are written.

    A run that failed can be repeated. Before it archives, a run notes its dates as LOADED in
    ``stages``; a later run doesn't load them again (part of their documents may have moved) and goes on with
    archiving, unless newer documents have landed: these are then appended.
    """
    if dimension_refresh not in ("incremental", "full"):
        raise ValueError(f"unknown dimension refresh {dimension_refresh!r}")
    given = [process_dates] if isinstance(process_dates, str) else None if process_dates is None else list(process_dates)
    days: list[dt.date] = []
    try:
        if given is not None:
            days = sorted({dt.date.fromisoformat(d) for d in given})
        landed = _landed(spark, raw_base, None if given is None else days)
        if given is None:
            days = sorted(landed)
        done, late = _resumable(spark, warehouse, dag_id, days, landed) if archive_base is not None else ([], [])
        open_days = [d for d in days if d not in set(done)]
        documents = empty = 0
        for dates, mode in (([d for d in open_days if d not in set(late)], flat_mode), (late, "append")):
            if dates:
                counts = _load(
                    spark, raw_base, warehouse, dates, {d: landed[d][0] for d in dates if d in landed}, update_columns,
                    mode, dimension_mode, dimension_refresh, given is None, maintain_latest, quarantine,
                    maintain_trends)
                documents, empty = documents + counts[0], empty + counts[1]
        if catalog is not None:
            refresh_catalog(spark, warehouse.fact, warehouse.dimension, days, catalog)
        if archive_base is not None:
            if open_days:
                log_run(spark, warehouse.stages, dag_id, LOADED, open_days)
            archive_dates(spark, raw_base, archive_base, days)
        log_run(spark, warehouse.ledger, dag_id, SUCCESS, days)
        return LoadResult(tuple(days), documents, empty)
    except Exception:
        log_run(spark, warehouse.ledger, dag_id, FAILED, days)
        raise


def _load(
    spark: SparkSession,
    raw_base: str,
    warehouse: Warehouse,
    days: list[dt.date],
    sizes: dict[dt.date, int],
    update_columns: Sequence[str],
    flat_mode: str,
    dimension_mode: str,
    dimension_refresh: str,
    whole_landing: bool,
    maintain_latest: bool,
    quarantine: bool,
    maintain_trends: int | None,
) -> tuple[int, int]:
    """Documents of ``days`` through all tables; how many there were, and how many empty."""
    corrupt = CORRUPT_TEXT if quarantine else None
    if whole_landing:
        # Only dates seen in the listing: what lands meanwhile waits for the next run.
        raw = read_all_snapshots(spark, raw_base, corrupt_column=corrupt, version=True).where(F.col("ingestion_date").isin(days))
    else:
        raw = read_snapshots(spark, raw_base, [d.isoformat() for d in days], corrupt_column=corrupt, version=True)
    if quarantine:
        # Parsed once: both what goes on and what doesn't are read from here.
        staging = scratch_path(spark, "parsed")
        raw.write.parquet(staging)
        parsed = spark.read.schema(raw.schema).parquet(staging)
        raw = parsed.drop(CORRUPT_TEXT)
        (
            quarantined(parsed).write.partitionBy("ingestion_date").mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").parquet(warehouse.quarantine)
        )
    seen, load_id = Observation("documents"), uuid.uuid4().hex
    write_flat(transform(usable_documents(raw, seen)), warehouse.flat, flat_mode, load_id, sizes)
    loads = read_dates(spark, warehouse.flat, FLAT_STORED_SCHEMA, days)
    if loads is None:  # nothing was written for these dates
        loads = spark.createDataFrame([], FLAT_STORED_SCHEMA)
        rows = latest_load(loads)
    else:
        rows = latest_load(located(loads))
    upsert_fact(spark, rows, warehouse.fact, update_columns, dates=days, sizes=sizes)
    fold_dimension(spark, warehouse, rows, days, dimension_mode, dimension_refresh)
    if maintain_latest:
        update_latest(spark, warehouse.fact, warehouse.latest, days)
    if maintain_trends is not None:
        update_trends(spark, warehouse.fact, warehouse.trends, days, maintain_trends)
    if loads.where(F.col(LOAD_ID) == load_id).limit(1).count():
        return seen.get["documents"], seen.get["empty"]
    # No document is usable: Spark drops the empty branch, and the counts with it.
    n = raw.count()
    return n, n
