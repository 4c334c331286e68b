"""Q1–Q4 and K5: the user-facing views over the fact and dimension tables.

Each view is a DataFrame → DataFrame function; ``register_views`` also
publishes them as temporary views under their warehouse names, and
``store_views`` as views of the catalog.

The dimension joins are plain equi-joins: the dimension has one row per
ticker (``dimension_latest``), so the optimiser broadcasts it while it is
under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks the measured
size at run time) and shuffles both sides on ``ticker_id`` beyond that.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.operators.latest import latest_rows
from tickerlake.operators.ranking import top_n_per_group
from tickerlake.schema import FACT_SCHEMA
from tickerlake.sinks.tables import CLUSTER_COLUMN, COMPRESSION, DIMENSION_BUCKETS, DIMENSION_STORED_SCHEMA, REMOVE_SHUFFLES, _setting

# --- Fixed values: view column lists (warehouse-file form). ---
FUNDAMENTAL_FACT_COLUMNS = [
    "revenueGrowth",
    "revenue_growth_category",
    "profitMargins",
    "grossMargins",
    "operatingMargins",
    "returnOnEquity",
    "roe_category",
    "returnOnAssets",
    "market_cap_cr",
    "revenue_cr",
    "net_cash_cr",
    "dividendYield",
    "payoutRatio",
]
TECHNICAL_COLUMNS = [
    "ticker_id",
    "ingestion_date",
    "currentPrice",
    "previousClose",
    "regularMarketChangePercent",
    "beta",
    "trailingPE",
    "forwardPE",
    "pe_category",
    "fiftyDayAverage",
    "twoHundredDayAverage",
    "above_200dma",
    "week52_position_score",
    "discount_from_52w_high_pct",
    "week52_change",
    "sandp_52week_change",
]
ANALYST_FACT_COLUMNS = [
    "currentPrice",
    "targetMeanPrice",
    "targetHighPrice",
    "targetLowPrice",
    "analyst_upside_pct",
    "recommendationMean",
    "numberOfAnalystOpinions",
    "is_strong_buy",
]
# Union of the two screener forms (file form adds currentPrice and
# market_cap_cr, scheduled form adds discount_from_52w_high_pct).
SCREENER_FACT_COLUMNS = [
    "ticker_id",
    "ingestion_date",
    "currentPrice",
    "trailingPE",
    "revenueGrowth",
    "returnOnEquity",
    "analyst_upside_pct",
    "is_strong_buy",
    "week52_position_score",
    "discount_from_52w_high_pct",
    "market_cap_cr",
]


def _q(name: str):
    return F.col(f"q.`{name}`")


def fundamental_view(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Q1: margins, growth and returns with sector and industry (17 columns).
    Facts without a dimension row are kept (left join)."""
    q, d = fact.alias("q"), dim.alias("d")
    return q.join(d, F.col("q.ticker_id") == F.col("d.ticker_id"), "left").select(
        _q("ticker_id"),
        _q("ingestion_date"),
        F.col("d.sector"),
        F.col("d.industry"),
        *[_q(c) for c in FUNDAMENTAL_FACT_COLUMNS],
    )


def technical_view(fact: DataFrame) -> DataFrame:
    """Q2: price action, averages and 52-week metrics (16 columns)."""
    return fact.select(*TECHNICAL_COLUMNS)


def analyst_view(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Q3: targets, recommendations and upside with sector (11 columns)."""
    q, d = fact.alias("q"), dim.alias("d")
    return q.join(d, F.col("q.ticker_id") == F.col("d.ticker_id"), "left").select(
        _q("ticker_id"),
        _q("ingestion_date"),
        F.col("d.sector"),
        *[_q(c) for c in ANALYST_FACT_COLUMNS],
    )


def undervalued_stocks_view(
    fact: DataFrame, dim: DataFrame, top_n: int = 1, latest: DataFrame | None = None
) -> DataFrame:
    """Q4: per sector, the ticker with the lowest trailing PE (then highest
    revenue growth, then ticker id) among every ticker's latest snapshot.

    Plan: latest row per ticker, of the columns needed, as one aggregate over
    one scan (the fact's key is unique) → drop NULL PE (a ticker whose latest
    row has no PE is out) → inner join with the dimension → row_number per
    sector, limited to ``top_n`` on both sides of the shuffle. Tickers with a
    NULL sector rank as one group. With ``latest`` (the maintained latest rows)
    the fact is not read: the screener's cost is the tickers, not the history.
    """
    if latest is None:
        latest = latest_rows(fact.select(*SCREENER_FACT_COLUMNS), unique=True)
    latest = latest.select(*SCREENER_FACT_COLUMNS).where(F.col("trailingPE").isNotNull())
    q, d = latest.alias("q"), dim.alias("d")
    joined = q.join(d, F.col("q.ticker_id") == F.col("d.ticker_id"), "inner").select(
        F.col("d.sector").alias("sector"), *[_q(c) for c in SCREENER_FACT_COLUMNS]
    )
    return top_n_per_group(
        joined,
        ["sector"],
        [
            F.col("trailingPE").asc_nulls_first(),
            F.col("revenueGrowth").desc_nulls_last(),
            F.col("ticker_id").asc_nulls_first(),
        ],
        n=top_n,
    )


def register_views(spark: SparkSession, fact: DataFrame, dim: DataFrame) -> list[str]:
    """K5 for a session: (re)publish the four views as temporary views; returns their names."""
    views = {
        "fundamental_view": fundamental_view(fact, dim),
        "technical_view": technical_view(fact),
        "analyst_view": analyst_view(fact, dim),
        "undervalued_stocks_view": undervalued_stocks_view(fact, dim),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def view_statements(fact: str, dimension: str) -> dict[str, str]:
    """The four views as SQL over catalog tables."""
    def cols(names: list[str], alias: str = "q") -> str:
        return ", ".join(f"{alias}.`{n}`" for n in names)

    latest = ", ".join(f"`{c}`" for c in SCREENER_FACT_COLUMNS if c not in ("ticker_id", "ingestion_date"))
    picked = ", ".join(
        "last.d AS ingestion_date" if c == "ingestion_date" else c if c == "ticker_id" else f"last.`{c}`"
        for c in SCREENER_FACT_COLUMNS
    )
    facts = f"{fact} q LEFT JOIN {dimension} d ON q.ticker_id = d.ticker_id"
    return {
        "fundamental_view": f"SELECT q.ticker_id, q.ingestion_date, d.sector, d.industry, {cols(FUNDAMENTAL_FACT_COLUMNS)} FROM {facts}",
        "technical_view": f"SELECT {cols(TECHNICAL_COLUMNS)} FROM {fact} q",
        "analyst_view": f"SELECT q.ticker_id, q.ingestion_date, d.sector, {cols(ANALYST_FACT_COLUMNS)} FROM {facts}",
        "undervalued_stocks_view": (
            f"WITH latest AS (SELECT {picked} FROM (SELECT ticker_id, max(struct(ingestion_date AS d, {latest})) AS last "
            f"FROM {fact} WHERE ticker_id IS NOT NULL GROUP BY ticker_id) WHERE last.trailingPE IS NOT NULL), "
            "ranked AS (SELECT d.sector, q.*, CAST(row_number() OVER (PARTITION BY d.sector ORDER BY q.trailingPE, "
            f"q.revenueGrowth DESC, q.ticker_id) AS BIGINT) AS rank FROM latest q JOIN {dimension} d "
            "ON q.ticker_id = d.ticker_id) SELECT * FROM ranked WHERE rank = 1"
        ),
    }


def _catalog_tables(fact_path: str, dimension_path: str) -> tuple:
    return (
        ("quantitative_table", fact_path, FACT_SCHEMA, "ingestion_date"),
        ("dimension_table", dimension_path, DIMENSION_STORED_SCHEMA, "bucket"),
    )


def refresh_catalog(spark: SparkSession, fact_path: str, dimension_path: str, dates: Iterable[dt.date], database: str) -> None:
    """K5 after a load: the catalog's tables know the partitions of ``dates`` (and all of the dimension's buckets).

    Partitions are added by name, as far as their folders exist, and rewritten ones read anew. Nothing is
    dropped, so readers of the views never fail, and no other partition is looked at.
    """
    for name, path, _, by in _catalog_tables(fact_path, dimension_path):
        table = f"{database}.{name}"
        wanted = [d.isoformat() for d in sorted(set(dates))] if by == "ingestion_date" else [str(b) for b in range(DIMENSION_BUCKETS)]
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        there = {f.getPath().getName() for f in files.listStatus(folder)} if files.exists(folder) else set()
        found = [v for v in wanted if f"{by}={v}" in there]
        for lo in range(0, len(found), 500):
            parts = " ".join(f"PARTITION ({by}='{v}')" for v in found[lo : lo + 500])
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
        spark.catalog.refreshTable(table)


def store_views(spark: SparkSession, fact_path: str, dimension_path: str, database: str = "default") -> list[str]:
    """K5 in the catalog: tables over the stored files, with all their partitions, and the four views.

    What a persistent catalog holds outlives the session. Tables that are there already stay, and
    views are replaced in place; loads that name the database keep them current (``refresh_catalog``).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path, schema, by in _catalog_tables(fact_path, dimension_path):
        table = f"{database}.{name}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.catalog.refreshTable(table)
    names = [f"{database}.{n}" for n in view_statements("", "")]
    for name, statement in view_statements(f"{database}.quantitative_table", f"{database}.dimension_table").items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {statement}")
    return names


#: Bytes of a bucket up to which it is written by one task.
BUCKET_BYTES = 32 << 20


def store_clustered(spark: SparkSession, fact: DataFrame, dimension: DataFrame, database: str, buckets: int) -> list[str]:
    """K2 clustered by ticker: fact and dimension as catalog tables bucketed and sorted by ticker.

    Joins and aggregates by ticker over these tables shuffle neither side. They are copies, written anew on
    each call; the partitioned fact stays the table that loads write. Returns the tables' names.

    A bucket is one file, in order, while buckets are small (``BUCKET_BYTES``, by Spark's estimate). Of larger ones
    each task that reads rows writes a file, in order, of its own: whole rows are not shuffled, and no task sorts
    a whole bucket.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, rows, order in (
        ("quantitative_by_ticker", fact, [CLUSTER_COLUMN, "ingestion_date"]), ("dimension_by_ticker", dimension, [CLUSTER_COLUMN]),
    ):
        estimate = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        small = int(str(estimate)) <= buckets * BUCKET_BYTES
        # One task a bucket, so a bucket is one file and its order holds.
        dealt = rows.repartition(buckets, CLUSTER_COLUMN) if small else rows
        writer = dealt.write.mode("overwrite").option("compression", COMPRESSION).bucketBy(buckets, CLUSTER_COLUMN).sortBy(*order)
        with _setting(spark, REMOVE_SHUFFLES, "true"):
            writer.saveAsTable(f"{database}.{name}")
        names.append(f"{database}.{name}")
    return names
