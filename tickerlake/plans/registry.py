"""Every operator and view as a query over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. The market
adapter (``plans.market``) turns ``lineitem ⋈ part`` into snapshots; the
queries then run the library on them — in memory, or through the real sinks
into tables under the shared checkpoint folder, read back as the result.

Tables that several queries read (the landed documents, the warehouse built
from the adapter) are built once per application and sf folder.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.functions import features as feat
from tickerlake.operators.backtest import backtest, backtest_summary
from tickerlake.operators.benchmark import rolling_beta, ticker_beta
from tickerlake.operators.coverage import CORRUPT_TEXT, coverage_summary, landing_outages, quarantined
from tickerlake.operators.dedup import dedup_by_key, latest_load
from tickerlake.operators.dimension import dimension_distinct, dimension_latest
from tickerlake.operators.latest import latest_dates, latest_rows
from tickerlake.operators.ledger import FAILED, SUCCESS, dates_to_process, ledger_status
from tickerlake.operators.timeseries import moving_average, relative_52w_change, volatility
from tickerlake.plans.daily_load import Warehouse, run_daily_load
from tickerlake.plans.market import (
    LINEAGE_ORDER,
    SOURCE_COLUMNS,
    ledger_from_orders,
    line_items,
    raw_snapshots,
    snapshots,
)
from tickerlake.plans.views import (
    analyst_view,
    fundamental_view,
    refresh_catalog,
    register_views,
    store_clustered,
    store_views,
    technical_view,
    undervalued_stocks_view,
)
from tickerlake.schema import KEY_COLUMNS, UPDATE_COLUMNS_FULL, UPDATE_COLUMNS_SCHEDULED
from tickerlake.session import LISTING_PARALLELISM, scratch_path
from tickerlake.sinks.landing import land_snapshots
from tickerlake.sinks.latest import read_latest, refresh_latest, update_latest
from tickerlake.sinks.ledger import read_ledger
from tickerlake.sinks.tables import (
    dates_of,
    day_sizes,
    located,
    read_dimension,
    read_fact,
    read_flat,
    read_flat_loads,
    refresh_dimension,
    to_fact_columns,
    update_dimension,
    upsert_fact,
    write_flat,
)
from tickerlake.sinks.trends import read_trends, refresh_trends, update_trends
from tickerlake.sources.snapshots import landed_files, read_all_snapshots, read_snapshots
from tickerlake.sources.universe import ticker_universe
from tickerlake.streaming.incremental import start_incremental_load

Query = Callable[[SparkSession, str], DataFrame]

# ------------------------------------------------------------ building blocks --


def flat_with_lineage(spark: SparkSession, sf: str, revision: int = 0) -> DataFrame:
    """P9 over the adapter rows, line-item order columns kept."""
    return feat.transform(raw_snapshots(spark, sf, revision, lineage=True))


def flat_rows(spark: SparkSession, sf: str, revision: int = 0) -> DataFrame:
    """The flat table's 107 columns, one row per line item."""
    return flat_with_lineage(spark, sf, revision).drop(*LINEAGE_ORDER)


def deduped(spark: SparkSession, sf: str, revision: int = 0) -> DataFrame:
    """R5 with the line-item order as tie-break; lineage columns kept."""
    return dedup_by_key(flat_with_lineage(spark, sf, revision), order=LINEAGE_ORDER)


def _widened(revision: int = 0) -> Callable[[DataFrame], DataFrame]:
    """P9 over line items: what the sinks make flat rows by, after the shuffle."""
    return lambda items: feat.transform(snapshots(items, revision))


def _deduped_items(spark: SparkSession, sf: str, revision: int = 0) -> DataFrame:
    """The line items of ``deduped``: R5 over whole flat rows, of which the sink gets what they are made of."""
    items = line_items(spark, sf)
    rows = feat.transform(snapshots(items, revision, SOURCE_COLUMNS))
    return dedup_by_key(rows, order=LINEAGE_ORDER).select(*items.columns)


def fact_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The fact contract over de-duplicated flat rows (in memory)."""
    return to_fact_columns(deduped(spark, sf))


_lock = threading.RLock()  # a built table may need another
_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf: str, kind: str, build: Callable[[], object]) -> object:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf), kind)
    with _lock:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """Flat (append), fact (upsert of de-duplicated rows) and dimension
    (latest), written through the sinks once per application."""

    def build() -> Warehouse:
        _listing(spark)
        wh = Warehouse(scratch_path(spark, "warehouse"))
        write_flat(line_items(spark, sf), wh.flat, "append", widen=_widened())
        upsert_fact(spark, _deduped_items(spark, sf), wh.fact, widen=_widened())
        refresh_dimension(read_flat(spark, wh.flat), wh.dimension, "latest")
        return wh

    return _once(spark, sf, "warehouse", build)  # type: ignore[return-value]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """One raw document per (ticker, date): the adapter rows after R5."""
    rows = dedup_by_key(raw_snapshots(spark, sf, lineage=True), order=LINEAGE_ORDER)
    return rows.drop(*LINEAGE_ORDER)


def _listing(spark: SparkSession) -> None:
    """The queries' landing holds thousands of folders; a session whose deployer
    has not said how many tasks list them gets the library's number, for good."""
    if spark.conf.get(LISTING_PARALLELISM, "10000") == "10000":
        spark.conf.set(LISTING_PARALLELISM, "64")


def landing(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """K6: the documents landed as ``date=<d>/<ticker>.json`` once per application."""

    def build() -> tuple[str, DataFrame]:
        _listing(spark)
        base = scratch_path(spark, "landing")
        return base, land_snapshots(_documents(spark, sf), base)

    return _once(spark, sf, "landing", build)  # type: ignore[return-value]


def loaded_and_archived(spark: SparkSession, sf: str) -> tuple[Warehouse, str]:
    """A landing in which every 29th order's documents are empty, loaded by the
    daily load (dimension rebuilt) and archived; once per application."""

    def build() -> tuple[Warehouse, str]:
        rows = dedup_by_key(raw_snapshots(spark, sf, lineage=True), order=LINEAGE_ORDER)
        empty = F.col("l_orderkey") % 29 == 0
        payload = [n for n in rows.columns if n not in (*KEY_COLUMNS, *LINEAGE_ORDER)]
        docs = rows.select(*KEY_COLUMNS, *[F.when(~empty, F.col(f"`{n}`")).alias(n) for n in payload])
        base, archive = scratch_path(spark, "landing"), scratch_path(spark, "archive")
        land_snapshots(docs, base)
        wh = Warehouse(scratch_path(spark, "daily"))
        run_daily_load(spark, base, wh, dimension_refresh="full", archive_base=archive)
        return wh, archive

    return _once(spark, sf, "archived", build)  # type: ignore[return-value]


def last_date(spark: SparkSession, sf: str) -> str:
    rows = raw_snapshots(spark, sf)
    return rows.agg(F.max("ingestion_date")).first()[0].isoformat()


# ------------------------------------------------------------------ queries --


def _feature_query(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return flat_rows(spark, sf).select("ticker_id", "ingestion_date", name)

    return q


FEATURE_QUERIES: dict[str, str] = {
    "E1_market_cap_cr": "market_cap_cr",
    "E2_dividend_yield_cap": "dividendYield",
    "E3_pe_category": "pe_category",
    "E4_week52_position_score": "week52_position_score",
    "E5_discount_from_52w_high": "discount_from_52w_high_pct",
    "E6_above_200dma": "above_200dma",
    "E7_analyst_upside": "analyst_upside_pct",
    "E8_is_strong_buy": "is_strong_buy",
    "E9_net_cash_cr": "net_cash_cr",
    "E10_revenue_cr": "revenue_cr",
    "E11_earnings_yield": "earnings_yield",
    "E12_roe_category": "roe_category",
    "E13_revenue_growth_category": "revenue_growth_category",
    "E14_avg_governance_risk": "avg_governance_risk",
}


def p1_rename(spark: SparkSession, sf: str) -> DataFrame:
    renamed = feat.rename_problematic_columns(raw_snapshots(spark, sf))
    return renamed.select("ticker_id", "ingestion_date", "week52_change", "sandp_52week_change")


def p2_flatten(spark: SparkSession, sf: str) -> DataFrame:
    nested = raw_snapshots(spark, sf).select(
        "ticker_id",
        "ingestion_date",
        F.struct("sector", "industry").alias("profile"),
        F.struct("fiftyTwoWeekLow", "fiftyTwoWeekHigh").alias("range52"),
    )
    return feat.flatten_df(nested)


def p9_transform(spark: SparkSession, sf: str) -> DataFrame:
    return flat_rows(spark, sf)


def r5_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return deduped(spark, sf).drop(*LINEAGE_ORDER)


def r5_dedup_total_order(spark: SparkSession, sf: str) -> DataFrame:
    """R5 with its default order: every non-key column, ascending, NULLs first."""
    return dedup_by_key(flat_rows(spark, sf))


def a1_latest_date(spark: SparkSession, sf: str) -> DataFrame:
    return latest_dates(fact_rows(spark, sf))


def j2_latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return latest_rows(fact_rows(spark, sf))


def a2_dimension_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_distinct(flat_rows(spark, sf))


def a4_dimension_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_latest(flat_rows(spark, sf))


def w2_top3_per_sector(spark: SparkSession, sf: str) -> DataFrame:
    """Top 3 per sector among latest rows with a PE (the screener's ranking, n=3)."""
    wh = warehouse(spark, sf)
    fact, dim = read_fact(spark, wh.fact), read_dimension(spark, wh.dimension)
    return undervalued_stocks_view(fact, dim, top_n=3)


def _views(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    wh = warehouse(spark, sf)
    return read_fact(spark, wh.fact), read_dimension(spark, wh.dimension)


def q1_fundamental(spark: SparkSession, sf: str) -> DataFrame:
    return fundamental_view(*_views(spark, sf))


def q2_technical(spark: SparkSession, sf: str) -> DataFrame:
    return technical_view(_views(spark, sf)[0])


def q3_analyst(spark: SparkSession, sf: str) -> DataFrame:
    return analyst_view(*_views(spark, sf))


def q4_undervalued(spark: SparkSession, sf: str) -> DataFrame:
    return undervalued_stocks_view(*_views(spark, sf))


def q4_undervalued_distinct_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Q4 against the dimension as coded upstream (SELECT DISTINCT): a ticker
    whose descriptive columns drifted joins once per variant."""
    fact = _views(spark, sf)[0]
    return undervalued_stocks_view(fact, dimension_distinct(read_flat(spark, warehouse(spark, sf).flat)))


def k5_catalog_views(spark: SparkSession, sf: str) -> DataFrame:
    """The screener as a stored view over catalog tables."""
    wh = warehouse(spark, sf)
    # A database of its own for each built warehouse: its tables point at those files.
    database = "market_" + wh.root.rsplit("-", 1)[-1]
    store_views(spark, wh.fact, wh.dimension, database)
    return spark.sql(f"SELECT * FROM {database}.undervalued_stocks_view")


def k5_views(spark: SparkSession, sf: str) -> DataFrame:
    register_views(spark, *_views(spark, sf))
    return spark.sql("SELECT * FROM fundamental_view")


def k1_flat_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "flat")
    write_flat(line_items(spark, sf), path, "append", widen=_widened())
    return read_flat(spark, path)


def k1_flat_replace_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Writing the same dates twice in ``replace_dates`` mode leaves them once."""
    path = scratch_path(spark, "flat")
    write_flat(line_items(spark, sf), path, "replace_dates", widen=_widened())
    write_flat(line_items(spark, sf), path, "replace_dates", widen=_widened())
    return read_flat(spark, path)


def _upsert(update_columns) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        """Target: revision-0 rows of line numbers 1–4; source: revision-1 rows
        of line numbers 3–7 (3–4 match, 5–7 are new, 1–2 stay untouched)."""
        return read_fact(spark, _upserted(spark, sf, update_columns)[0])

    return q


def _upserted(spark: SparkSession, sf: str, update_columns) -> tuple[str, str]:
    """The fact table after two loads, and the latest rows kept current with each; once per application."""

    def build() -> tuple[str, str]:
        path, latest = scratch_path(spark, "fact"), scratch_path(spark, "latest")
        first = _deduped_items(spark, sf, 0).where(F.col("l_linenumber") <= 4)
        second = _deduped_items(spark, sf, 1).where(F.col("l_linenumber") >= 3)
        days, again = _load_dates(spark, sf, 1, 4), _load_dates(spark, sf, 3, 7)
        # The first load's dates come in two halves: the table is built, then appended to, then reloaded.
        early = days[: len(days) // 2]
        keep_latest = update_columns == UPDATE_COLUMNS_FULL
        dimension, database = warehouse(spark, sf).dimension if keep_latest else "", _database(path)
        upsert_fact(spark, first, path, dates=days, widen=_widened())
        if keep_latest:
            refresh_latest(spark, path, latest, dates=early)
            update_latest(spark, path, latest, days[len(early) :])
            store_views(spark, path, dimension, database)
        upsert_fact(spark, second, path, update_columns, dates=again, widen=_widened(1))
        if keep_latest:
            update_latest(spark, path, latest, again)
            refresh_catalog(spark, path, dimension, again, database)
        return path, latest

    return _once(spark, sf, f"upserted-{len(update_columns)}", build)  # type: ignore[return-value]


def _database(path: str) -> str:
    """A database of its own for each built table."""
    return "market_" + path.rsplit("-", 1)[-1]


def k5_after_next_load(spark: SparkSession, sf: str) -> DataFrame:
    """A stored view after a load that followed its making: nothing was stored anew."""
    path, _ = _upserted(spark, sf, UPDATE_COLUMNS_FULL)
    return spark.sql(f"SELECT * FROM {_database(path)}.fundamental_view")


def k2_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """The fundamental view over tables bucketed by ticker."""
    wh = warehouse(spark, sf)
    names = store_clustered(spark, *_views(spark, sf), _database(wh.root), buckets=8)
    return fundamental_view(*[spark.table(n) for n in names])


def k1_split_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days of more than ten rows written by several tasks."""
    _listing(spark)
    path = scratch_path(spark, "flat")
    rows = flat_rows(spark, sf)
    write_flat(rows, path, "append", sizes=day_sizes(rows), rows_per_file=10)
    return read_flat(spark, path)


def f5_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that carry nothing, from the archived landing."""
    archive = loaded_and_archived(spark, sf)[1]
    return quarantined(read_all_snapshots(spark, archive, corrupt_column=CORRUPT_TEXT))


def q5_retry(spark: SparkSession, sf: str) -> DataFrame:
    """A load of all dates that fails while archiving, and is repeated: the archive is in the way of one
    date at first. Per date: ledger rows by status and archived files."""
    base, archive = scratch_path(spark, "landing"), scratch_path(spark, "archive")
    land_snapshots(_documents(spark, sf), base)
    wh = Warehouse(scratch_path(spark, "daily"))
    days = dates_of(raw_snapshots(spark, sf))
    hadoop = spark._jvm.org.apache.hadoop.fs
    blocked = hadoop.Path(f"{archive}/date={days[len(days) // 2].isoformat()}")
    files = blocked.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(blocked.getParent())
    files.create(blocked).close()  # a file where the date's folder should go
    try:
        run_daily_load(spark, base, wh, archive_base=archive)
        raise AssertionError("the archive should have been in the way")
    except (OSError, Py4JJavaError):
        files.delete(blocked, False)
    run_daily_load(spark, base, wh, [d.isoformat() for d in days], archive_base=archive)
    ledger = read_ledger(spark, wh.ledger).groupBy(F.col("process_date").alias("ingestion_date")).agg(
        F.count(F.when(F.col("status") == FAILED, 1)).alias("failed"), F.count(F.when(F.col("status") == SUCCESS, 1)).alias("succeeded"))
    moved = landed_files(spark, archive).select("ingestion_date", "files")
    facts = read_fact(spark, wh.fact).groupBy("ingestion_date").agg(F.count("*").alias("facts"))
    return ledger.join(moved, "ingestion_date").join(facts, "ingestion_date")


def r1_outages(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of order dates on which a part's ticker has no document."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    due = orders.select(F.col("o_orderdate").cast("date").alias("ingestion_date"))
    return landing_outages(_part_universe(spark, sf), _documents(spark, sf), due)


def j2_maintained_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The latest rows as kept load by load: an append and a reload."""
    return read_latest(spark, _upserted(spark, sf, UPDATE_COLUMNS_FULL)[1])


def q4_maintained_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The screener over the maintained latest rows: no scan of the history."""
    fact, latest = _upserted(spark, sf, UPDATE_COLUMNS_FULL)
    dim = read_dimension(spark, warehouse(spark, sf).dimension)
    return undervalued_stocks_view(read_fact(spark, fact), dim, latest=read_latest(spark, latest))


def _held(spark: SparkSession, sf: str) -> DataFrame:
    return backtest(fact_rows(spark, sf), dimension_latest(flat_rows(spark, sf)), horizon_days=30)


def b1_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return _held(spark, sf)


def b1_backtest_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Three picks a sector, with prices of 0 and facts without a ticker."""
    return backtest(_gaps(spark, sf), dimension_latest(flat_rows(spark, sf)), horizon_days=90, top_n=3)


def b2_backtest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return backtest_summary(_held(spark, sf))


def v4_rolling_beta(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_beta(read_fact(spark, warehouse(spark, sf).fact), 5, block=16)


def v4_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_beta(_gaps(spark, sf), 5, block=16)


def v5_ticker_beta(spark: SparkSession, sf: str) -> DataFrame:
    return ticker_beta(fact_rows(spark, sf), block=16)


def _load_dates(spark: SparkSession, sf: str, low: int, high: int) -> list:
    """Dates of a load, from the rows before they are de-duplicated (a superset is fine)."""
    rows = raw_snapshots(spark, sf, lineage=True).where(F.col("l_linenumber").between(low, high))
    return dates_of(rows)


def k4_dimension_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return read_dimension(spark, warehouse(spark, sf).dimension)


def k4_dimension_refresh_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The second refresh, from a history of line number 7 alone, holds fewer tickers."""
    path = scratch_path(spark, "dimension")
    rows = flat_with_lineage(spark, sf)
    refresh_dimension(rows, path)
    refresh_dimension(rows.where(F.col("l_linenumber") == 7), path)
    return read_dimension(spark, path)


# From this date on, the reload test loads dates again, with other rows.
RELOADED_FROM = "1996-01-01"


def k4_dimension_incremental_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Dates loaded again with line numbers up to 3 only and brands as sectors:
    the folded dimension equals one built from the new history."""
    path = scratch_path(spark, "dimension")
    rows = flat_with_lineage(spark, sf)
    refresh_dimension(rows, path)
    late = F.col("ingestion_date") >= F.lit(RELOADED_FROM).cast("date")
    again = rows.where(late & (F.col("l_linenumber") <= 3)).withColumn("sector", F.col("industry"))
    dates = dates_of(rows.where(late))
    update_dimension(spark, again, path, rows.where(~late).unionByName(again), dates)
    return read_dimension(spark, path)


def s4_read_single_date(spark: SparkSession, sf: str) -> DataFrame:
    """S1, S4, F3 for one date, the last: its date is a constant column."""
    base, _ = landing(spark, sf)
    return feat.rename_problematic_columns(read_snapshots(spark, base, last_date(spark, sf)))


def p7_cast_date(spark: SparkSession, sf: str) -> DataFrame:
    """Flat rows whose date is text become fact rows with a DATE."""
    rows = deduped(spark, sf).drop(*LINEAGE_ORDER)
    return to_fact_columns(rows.withColumn("ingestion_date", F.col("ingestion_date").cast("string")))


def r5_dedup_latest_load(spark: SparkSession, sf: str) -> DataFrame:
    """Line numbers 3–7 loaded again, restated, by a second append: the last load's rows win."""
    path = scratch_path(spark, "flat")
    items = line_items(spark, sf)
    write_flat(items, path, "append", widen=_widened())
    write_flat(items.where(F.col("l_linenumber") >= 3), path, "append", widen=_widened(1))
    return latest_load(located(read_flat_loads(spark, path)))


def f5_skip_empty(spark: SparkSession, sf: str) -> DataFrame:
    return read_fact(spark, loaded_and_archived(spark, sf)[0].fact)


def k7_archived_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files per date in the archive."""
    archive = loaded_and_archived(spark, sf)[1]
    return landed_files(spark, archive).select(F.date_format("ingestion_date", "yyyy-MM-dd").alias("date"), "files")


def k8_ledger_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One SUCCESS row a date, stamped with the time of the run."""
    ledger = read_ledger(spark, loaded_and_archived(spark, sf)[0].ledger)
    recent = F.col("updated_ts").between(F.current_timestamp() - F.expr("interval 1 day"), F.current_timestamp())
    return ledger.select("dag_id", "status", "process_date", recent.alias("stamped"))


def q5_daily_load_single_date(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = landing(spark, sf)
    wh = Warehouse(scratch_path(spark, "daily"))
    run_daily_load(spark, base, wh, last_date(spark, sf))
    return read_fact(spark, wh.fact)


def r1_landing_coverage_due_dates(spark: SparkSession, sf: str) -> DataFrame:
    """R1 over every order date, on many of which nothing landed."""
    base, _ = landing(spark, sf)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    due = orders.select(F.col("o_orderdate").cast("date").alias("ingestion_date"))
    return coverage_summary(_part_universe(spark, sf), read_all_snapshots(spark, base), dates=due)


def s1_read_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = landing(spark, sf)
    return feat.rename_problematic_columns(read_all_snapshots(spark, base))


def k6_landing_summary(spark: SparkSession, sf: str) -> DataFrame:
    return landing(spark, sf)[1]


def s6_ticker_universe(spark: SparkSession, sf: str) -> DataFrame:
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    master = li.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ticker"))
    return ticker_universe(master)


def _part_universe(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet")
    return part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker_id"))


def r1_landing_coverage(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = landing(spark, sf)
    return coverage_summary(_part_universe(spark, sf), read_all_snapshots(spark, base))


def r2_ledger_status(spark: SparkSession, sf: str) -> DataFrame:
    return ledger_status(ledger_from_orders(spark, sf))


def r4_dates_to_process(spark: SparkSession, sf: str) -> DataFrame:
    landed = raw_snapshots(spark, sf).select("ingestion_date")
    return dates_to_process(landed, ledger_from_orders(spark, sf))


def q5_daily_load(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = landing(spark, sf)
    wh = Warehouse(scratch_path(spark, "daily"))
    run_daily_load(spark, base, wh)
    return read_fact(spark, wh.fact)


def r3_incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All landed documents as a file stream."""
    base, _ = landing(spark, sf)
    wh = Warehouse(scratch_path(spark, "stream-warehouse"))
    query = start_incremental_load(spark, base, wh, checkpoint=scratch_path(spark, "stream-checkpoint"))
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return read_fact(spark, wh.fact)


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with prices of 0 where there is no PE, and without ticker where the PE is 17."""
    fact = fact_rows(spark, sf)
    pe = F.col("trailingPE")
    return fact.withColumns({
        "currentPrice": F.when(pe.isNull(), F.lit(0.0)).otherwise(F.col("currentPrice")),
        "ticker_id": F.when(F.coalesce(pe, F.lit(0)) != 17, F.col("ticker_id")),
    })


def v1_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return moving_average(_gaps(spark, sf), 5, block=16)


def v2_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return volatility(_gaps(spark, sf), 5, block=16)


# Block of 16 positions: small enough that histories of the test tables span
# several blocks, so the halo path is exercised; any block >= n gives the
# same rows.
def v1_moving_average(spark: SparkSession, sf: str) -> DataFrame:
    return moving_average(read_fact(spark, warehouse(spark, sf).fact), 5, block=16)


def v2_volatility(spark: SparkSession, sf: str) -> DataFrame:
    return volatility(read_fact(spark, warehouse(spark, sf).fact), 5, block=16)


def maintained_trends(spark: SparkSession, sf: str) -> DataFrame:
    """V1 and V2 as kept load by load: built, then later dates, then five dates that come late, between those."""
    fact = warehouse(spark, sf).fact

    def build() -> str:
        path = scratch_path(spark, "trends")
        days = dates_of(read_fact(spark, fact))
        late = days[-45:-40]
        refresh_trends(spark, fact, path, 5, dates=days[:-60])
        update_trends(spark, fact, path, [d for d in days[-60:] if d not in late], 5)
        update_trends(spark, fact, path, late, 5)
        return path

    return read_trends(spark, _once(spark, sf, "trends", build), 5)  # type: ignore[arg-type]


def v3_relative_52w(spark: SparkSession, sf: str) -> DataFrame:
    return relative_52w_change(read_fact(spark, warehouse(spark, sf).fact))


QUERIES: dict[str, Query] = {
    **{name: _feature_query(col) for name, col in FEATURE_QUERIES.items()},
    "P1_rename": p1_rename,
    "P2_flatten": p2_flatten,
    "P9_transform": p9_transform,
    "R5_dedup": r5_dedup,
    "R5_dedup_total_order": r5_dedup_total_order,
    "A1_latest_date": a1_latest_date,
    "J2_latest_rows": j2_latest_rows,
    "A2_dimension_distinct": a2_dimension_distinct,
    "A4_dimension_latest": a4_dimension_latest,
    "W2_top3_per_sector": w2_top3_per_sector,
    "Q1_fundamental_view": q1_fundamental,
    "Q2_technical_view": q2_technical,
    "Q3_analyst_view": q3_analyst,
    "Q4_undervalued_stocks_view": q4_undervalued,
    "Q4_undervalued_distinct_dimension": q4_undervalued_distinct_dim,
    "K5_registered_views": k5_views,
    "K1_flat_append": k1_flat_append,
    "K1_flat_replace_dates": k1_flat_replace_dates,
    "K3_upsert": _upsert(UPDATE_COLUMNS_FULL),
    "K3_upsert_scheduled_columns": _upsert(UPDATE_COLUMNS_SCHEDULED),
    "K4_dimension_refresh": k4_dimension_refresh,
    "K4_dimension_refresh_twice": k4_dimension_refresh_twice,
    "K4_dimension_incremental_reload": k4_dimension_incremental_reload,
    "K5_catalog_views": k5_catalog_views,
    "K7_archived_files": k7_archived_files,
    "K8_ledger_rows": k8_ledger_rows,
    "F5_skip_empty": f5_skip_empty,
    "P7_cast_date": p7_cast_date,
    "R5_dedup_latest_load": r5_dedup_latest_load,
    "S4_read_single_date": s4_read_single_date,
    "Q5_daily_load_single_date": q5_daily_load_single_date,
    "R1_landing_coverage_due_dates": r1_landing_coverage_due_dates,
    "V1_moving_average_5_gaps": v1_gaps,
    "V2_volatility_5_gaps": v2_gaps,
    "S1_read_snapshots": s1_read_snapshots,
    "K6_landing_summary": k6_landing_summary,
    "S6_ticker_universe": s6_ticker_universe,
    "R1_landing_coverage": r1_landing_coverage,
    "R2_ledger_status": r2_ledger_status,
    "R4_dates_to_process": r4_dates_to_process,
    "Q5_daily_load": q5_daily_load,
    "R3_incremental_stream": r3_incremental_stream,
    "V1_moving_average_5": v1_moving_average,
    "V2_volatility_5": v2_volatility,
    "V3_relative_52w_change": v3_relative_52w,
    "V1_V2_maintained_trends_5": maintained_trends,
    "J2_maintained_latest_rows": j2_maintained_latest,
    "Q4_maintained_latest": q4_maintained_latest,
    "K5_catalog_views_after_next_load": k5_after_next_load,
    "K2_clustered_fundamental_view": k2_clustered,
    "K1_flat_split_days": k1_split_days,
    "F5_quarantine": f5_quarantine,
    "Q5_retry_after_partial_archive": q5_retry,
    "R1_outages": r1_outages,
    "B1_backtest_30_days": b1_backtest,
    "B1_backtest_90_days_gaps": b1_backtest_gaps,
    "B2_backtest_summary": b2_backtest_summary,
    "V4_rolling_beta_5": v4_rolling_beta,
    "V4_rolling_beta_5_gaps": v4_gaps,
    "V5_ticker_beta": v5_ticker_beta,
}
