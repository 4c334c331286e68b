"""Adapter: the driver's test tables → raw market snapshots.

``lineitem ⋈ part`` stands in for a ticker universe observed over many days:
one part is one ticker, one ship date is one snapshot date, and the numeric
columns feed the market fields the features read. Some fields are NULL on a
deterministic fraction of rows so every NULL branch of the features is hit;
``exchange`` and ``quoteType`` drift over a ticker's history so the dimension
has changing attributes.

Each mapping below is restated in SQL by ``ADAPTER_SQL`` for the DuckDB
oracle; keep the two in step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.schema import KEY_COLUMNS, RAW_COLUMNS, TYPE_NAMES

c = F.col


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _mapping(revision: int) -> dict[str, Column]:
    """Market column → expression over ``lineitem ⋈ part``.

    ``revision`` > 0 shifts prices and growth, standing in for a restated
    snapshot of the same (ticker, date): the upsert tests load it on top of
    revision 0.
    """
    def bumped(x: Column, scale: float = 1.0) -> Column:
        return x + F.lit(revision * scale) if revision else x

    price = bumped(c("l_extendedprice"))
    return {
        "ticker_id": F.concat(F.lit("P"), c("l_partkey").cast("string")),
        "ingestion_date": c("l_shipdate").cast("date"),
        "symbol": F.concat(F.lit("P"), c("l_partkey").cast("string")),
        "longName": c("p_name"),
        "shortName": c("p_name"),
        "sector": c("p_type"),
        "sectorKey": F.lower(c("p_type")),
        "industry": c("p_brand"),
        "industryKey": F.lower(c("p_brand")),
        "currency": F.lit("INR"),
        "financialCurrency": F.lit("INR"),
        "exchange": c("l_returnflag"),
        "quoteType": c("l_linestatus"),
        "currentPrice": price,
        "previousClose": c("l_extendedprice") / (F.lit(1) + c("l_discount")),
        "regularMarketChangePercent": c("l_discount") * 100 - c("l_tax") * 50,
        "fiftyTwoWeekLow": c("p_retailprice"),
        "fiftyTwoWeekHigh": F.when(c("l_linenumber") == 7, c("p_retailprice")).otherwise(
            c("p_retailprice") * 110
        ),
        "fiftyDayAverage": c("p_retailprice") * (F.lit(1) + c("l_discount")) * c("l_quantity"),
        "twoHundredDayAverage": _null_if(
            c("l_orderkey") % 13 == 0, c("p_retailprice") * c("l_quantity")
        ),
        "52WeekChange": c("l_discount") - c("l_tax"),
        "SandP52WeekChange": c("l_tax"),
        "marketCap": F.floor(c("l_extendedprice") * 100) * c("p_size"),
        "enterpriseValue": F.floor(c("l_extendedprice") * 1000),
        "trailingPE": _null_if(c("l_orderkey") % 11 == 0, bumped(c("l_quantity"))),
        "forwardPE": c("l_quantity") * (F.lit(1) - c("l_discount")),
        "priceToBook": c("p_retailprice") / c("l_quantity"),
        "totalRevenue": F.floor(c("l_extendedprice") * c("l_quantity")),
        "totalCash": c("l_orderkey") * 1000003,
        "totalDebt": c("l_partkey") * 999983,
        "freeCashflow": c("l_orderkey") * 7 - c("l_partkey") * 11,
        "profitMargins": c("l_discount"),
        "grossMargins": c("l_tax"),
        "operatingMargins": c("l_discount") + c("l_tax"),
        "returnOnAssets": c("l_discount") / 2,
        "returnOnEquity": _null_if(c("l_orderkey") % 19 == 0, c("l_discount") * 3),
        "payoutRatio": c("l_tax") * 5,
        "revenueGrowth": _null_if(c("l_orderkey") % 17 == 0, bumped(c("l_tax") * 3, 0.01)),
        "earningsGrowth": c("l_discount") * 2 - c("l_tax"),
        "dividendRate": c("l_tax") * 10,
        "dividendYield": c("l_quantity") * c("l_linenumber"),
        "recommendationMean": _null_if(c("l_linenumber") == 7, c("l_linenumber") / 2.0),
        "numberOfAnalystOpinions": (c("l_linenumber") + c("p_size")).cast("int"),
        "targetHighPrice": c("l_extendedprice") * (F.lit(1) + c("l_tax") * 2),
        "targetLowPrice": c("l_extendedprice") * (F.lit(1) - c("l_tax")),
        "targetMeanPrice": c("l_extendedprice") * (F.lit(1) + c("l_tax")),
        "auditRisk": c("l_linenumber").cast("int"),
        "boardRisk": _null_if(c("l_orderkey") % 23 == 0, (c("p_size") % 10 + 1).cast("int")),
        "compensationRisk": (c("l_suppkey") % 10 + 1).cast("int"),
        "shareHolderRightsRisk": (c("l_partkey") % 10 + 1).cast("int"),
        "overallRisk": ((c("l_partkey") + c("l_suppkey")) % 10 + 1).cast("int"),
        "heldPercentInsiders": c("l_discount"),
        "heldPercentInstitutions": F.lit(1) - c("l_discount"),
        "beta": c("l_tax") * 20,
    }


def lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base join: every line item with its part (inner, on the part key)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


# Total order over line items sharing a (part, ship date) key.
LINEAGE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_extendedprice",
    "l_quantity",
    "l_suppkey",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]

# What the mapping reads of a line item and its part, besides the keys.
SOURCE_COLUMNS = [*LINEAGE_ORDER, "l_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice"]


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part, as they are, and the key of the snapshot each stands for."""
    mapping = _mapping(0)
    return lineitem_part(spark, sf_dir).select(
        *[mapping[k].alias(k) for k in KEY_COLUMNS], *LINEAGE_ORDER, *(n for n in SOURCE_COLUMNS if n not in LINEAGE_ORDER)
    )


def raw_snapshots(
    spark: SparkSession, sf_dir: str, revision: int = 0, lineage: bool = False
) -> DataFrame:
    """``snapshots`` of the line items."""
    return snapshots(lineitem_part(spark, sf_dir), revision, LINEAGE_ORDER if lineage else [])


def snapshots(items: DataFrame, revision: int = 0, keep: Sequence[str] = ()) -> DataFrame:
    """All 94 raw columns, typed as declared; unmapped columns are typed NULLs.

    One row per line item: (ticker, date) repeats where a part ships twice on
    one day, as an append-only landing would after a retry. Line-item and part columns
    in ``keep`` are kept as well: those of ``LINEAGE_ORDER`` are a total order
    to pick one row per key deterministically, and to split loads. Keys that
    ``items`` has already are taken as they are.
    """
    mapping = {**_mapping(revision), **{k: c(k) for k in KEY_COLUMNS if k in items.columns}}
    cols = [
        mapping.get(name, F.lit(None)).cast(TYPE_NAMES[kind]).alias(name)
        for name, kind in RAW_COLUMNS
    ]
    return items.select(*cols, *keep)


def ledger_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run ledger derived from ``orders``: one run per order.

    ``dag_id`` = order priority (five jobs), status FAILED for status ``F``
    orders and SUCCESS otherwise, ``process_date`` = order date, and
    ``updated_ts`` = order date plus ``o_orderkey`` seconds.
    """
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        c("o_orderpriority").alias("dag_id"),
        F.when(c("o_orderstatus") == "F", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        # kept zone-free (timestamp_ntz): the order of runs must not depend on
        # the session time zone
        F.timestamp_add("SECOND", c("o_orderkey"), c("o_orderdate")).alias("updated_ts"),
        c("o_orderdate").cast("date").alias("process_date"),
    )
