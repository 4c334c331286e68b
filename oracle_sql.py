"""DuckDB restatement of every registered query, for the correctness gate.

Each statement recomputes its result from the driver's base tables
(pre-registered as views) with plain SQL: the adapter, the features, the
de-duplication, the fact and dimension tables and the views. Nothing here
runs on Spark.

Comparison traps handled:
* Spark rounds a double half-up on its decimal text; DuckDB rounds the
  binary value. ``R(x, n)`` rounds the decimal text in DuckDB too.
* NULL ordering is spelled out everywhere.
* ``row_number`` is cast to BIGINT.
"""

from __future__ import annotations


def R(x: str, n: int) -> str:
    """Half-up rounding of a double on its shortest decimal text."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _nullif(cond: str, value: str) -> str:
    return f"CASE WHEN {cond} THEN NULL ELSE {value} END"


def raw_select(revision: int = 0) -> str:
    """The market adapter over lineitem ⋈ part (94 raw columns + lineage)."""

    def bumped(x: str, scale: float = 1.0) -> str:
        return f"({x}) + {revision * scale!r}E0" if revision else x

    vs = "CAST(NULL AS VARCHAR)"
    dn = "CAST(NULL AS DOUBLE)"
    bn = "CAST(NULL AS BIGINT)"
    cols = {
        "ticker_id": "'P' || CAST(l_partkey AS VARCHAR)",
        "ingestion_date": "CAST(l_shipdate AS DATE)",
        "symbol": "'P' || CAST(l_partkey AS VARCHAR)",
        "longName": "p_name",
        "shortName": "p_name",
        "sector": "p_type",
        "sectorKey": "lower(p_type)",
        "industry": "p_brand",
        "industryKey": "lower(p_brand)",
        "country": vs,
        "city": vs,
        "currency": "'INR'",
        "financialCurrency": "'INR'",
        "exchange": "l_returnflag",
        "fullExchangeName": vs,
        "quoteType": "l_linestatus",
        "market": vs,
        "website": vs,
        "recommendationKey": vs,
        "averageAnalystRating": vs,
        "currentPrice": bumped("l_extendedprice"),
        "previousClose": "l_extendedprice / (1 + l_discount)",
        "open": dn,
        "dayLow": dn,
        "dayHigh": dn,
        "regularMarketChange": dn,
        "regularMarketChangePercent": "l_discount * 100 - l_tax * 50",
        "volume": bn,
        "averageVolume": bn,
        "averageVolume10days": bn,
        "averageDailyVolume3Month": bn,
        "fiftyTwoWeekLow": "p_retailprice",
        "fiftyTwoWeekHigh": "CASE WHEN l_linenumber = 7 THEN p_retailprice ELSE p_retailprice * 110 END",
        "fiftyDayAverage": "p_retailprice * (1 + l_discount) * l_quantity",
        "twoHundredDayAverage": _nullif("l_orderkey % 13 = 0", "p_retailprice * l_quantity"),
        "week52_change": "l_discount - l_tax",
        "sandp_52week_change": "l_tax",
        "marketCap": "CAST(floor(l_extendedprice * 100) AS BIGINT) * p_size",
        "enterpriseValue": "CAST(floor(l_extendedprice * 1000) AS BIGINT)",
        "trailingPE": _nullif("l_orderkey % 11 = 0", bumped("l_quantity")),
        "forwardPE": "l_quantity * (1 - l_discount)",
        "pegRatio": dn,
        "trailingPegRatio": dn,
        "priceToBook": "p_retailprice / l_quantity",
        "priceToSalesTrailing12Months": dn,
        "enterpriseToRevenue": dn,
        "enterpriseToEbitda": dn,
        "bookValue": dn,
        "trailingEps": dn,
        "forwardEps": dn,
        "revenuePerShare": dn,
        "totalCashPerShare": dn,
        "totalRevenue": "CAST(floor(l_extendedprice * l_quantity) AS BIGINT)",
        "totalCash": "l_orderkey * 1000003",
        "totalDebt": "l_partkey * 999983",
        "ebitda": bn,
        "grossProfits": bn,
        "freeCashflow": "l_orderkey * 7 - l_partkey * 11",
        "operatingCashflow": bn,
        "netIncomeToCommon": bn,
        "profitMargins": "l_discount",
        "grossMargins": "l_tax",
        "operatingMargins": "l_discount + l_tax",
        "ebitdaMargins": dn,
        "returnOnAssets": "l_discount / 2",
        "returnOnEquity": _nullif("l_orderkey % 19 = 0", "l_discount * 3"),
        "debtToEquity": dn,
        "currentRatio": dn,
        "quickRatio": dn,
        "payoutRatio": "l_tax * 5",
        "revenueGrowth": _nullif("l_orderkey % 17 = 0", bumped("l_tax * 3", 0.01)),
        "earningsGrowth": "l_discount * 2 - l_tax",
        "earningsQuarterlyGrowth": dn,
        "dividendRate": "l_tax * 10",
        "dividendYield": "l_quantity * l_linenumber",
        "trailingAnnualDividendRate": dn,
        "trailingAnnualDividendYield": dn,
        "fiveYearAvgDividendYield": dn,
        "recommendationMean": _nullif("l_linenumber = 7", "l_linenumber / 2.0E0"),
        "numberOfAnalystOpinions": "CAST(l_linenumber + p_size AS INTEGER)",
        "targetHighPrice": "l_extendedprice * (1 + l_tax * 2)",
        "targetLowPrice": "l_extendedprice * (1 - l_tax)",
        "targetMeanPrice": "l_extendedprice * (1 + l_tax)",
        "targetMedianPrice": dn,
        "auditRisk": "CAST(l_linenumber AS INTEGER)",
        "boardRisk": _nullif("l_orderkey % 23 = 0", "CAST(p_size % 10 + 1 AS INTEGER)"),
        "compensationRisk": "CAST(l_suppkey % 10 + 1 AS INTEGER)",
        "shareHolderRightsRisk": "CAST(l_partkey % 10 + 1 AS INTEGER)",
        "overallRisk": "CAST((l_partkey + l_suppkey) % 10 + 1 AS INTEGER)",
        "heldPercentInsiders": "l_discount",
        "heldPercentInstitutions": "1 - l_discount",
        "sharesOutstanding": bn,
        "floatShares": bn,
        "beta": "l_tax * 20",
    }
    body = ",\n    ".join(f'{expr} AS "{name}"' for name, expr in cols.items())
    lineage = ", ".join(LINEAGE)
    return (
        f"SELECT\n    {body},\n    {lineage}\n"
        "  FROM lineitem JOIN part ON l_partkey = p_partkey"
    )


LINEAGE = [
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

# --- Fixed values: feature rules over raw (renamed) columns. ---
FEATURES = {
    "market_cap_cr": f"CASE WHEN marketCap IS NOT NULL THEN {R('marketCap / 1.0E7', 2)} END",
    "dividendYield": "CASE WHEN dividendYield > 100 THEN NULL ELSE dividendYield END",
    "pe_category": (
        "CASE WHEN trailingPE IS NULL THEN NULL WHEN trailingPE < 15 THEN 'LOW' "
        "WHEN trailingPE < 25 THEN 'MEDIUM' ELSE 'HIGH' END"
    ),
    "week52_position_score": (
        "CASE WHEN (fiftyTwoWeekHigh - fiftyTwoWeekLow) > 0 THEN "
        + R("(currentPrice - fiftyTwoWeekLow) / (fiftyTwoWeekHigh - fiftyTwoWeekLow) * 100", 2)
        + " END"
    ),
    "discount_from_52w_high_pct": (
        "CASE WHEN fiftyTwoWeekHigh > 0 THEN "
        + R("(fiftyTwoWeekHigh - currentPrice) / fiftyTwoWeekHigh * 100", 2)
        + " END"
    ),
    "above_200dma": (
        "CASE WHEN currentPrice IS NULL OR twoHundredDayAverage IS NULL THEN NULL "
        "WHEN currentPrice > twoHundredDayAverage THEN TRUE ELSE FALSE END"
    ),
    "analyst_upside_pct": (
        "CASE WHEN targetMeanPrice IS NOT NULL AND currentPrice > 0 THEN "
        + R("(targetMeanPrice - currentPrice) / currentPrice * 100", 2)
        + " END"
    ),
    "is_strong_buy": (
        "CASE WHEN recommendationMean IS NULL THEN NULL "
        "WHEN recommendationMean <= 1.5E0 THEN TRUE ELSE FALSE END"
    ),
    "net_cash_cr": (
        "CASE WHEN totalCash IS NOT NULL AND totalDebt IS NOT NULL THEN "
        + R("(totalCash - totalDebt) / 1.0E7", 2)
        + " END"
    ),
    "revenue_cr": f"CASE WHEN totalRevenue IS NOT NULL THEN {R('totalRevenue / 1.0E7', 2)} END",
    "earnings_yield": (
        "CASE WHEN trailingPE IS NOT NULL AND trailingPE <> 0 THEN "
        + R("1.0E0 / trailingPE", 4)
        + " END"
    ),
    "roe_category": (
        "CASE WHEN returnOnEquity IS NULL THEN NULL WHEN returnOnEquity >= 0.25E0 THEN 'HIGH' "
        "WHEN returnOnEquity >= 0.15E0 THEN 'MEDIUM' ELSE 'LOW' END"
    ),
    "revenue_growth_category": (
        "CASE WHEN revenueGrowth IS NULL THEN NULL WHEN revenueGrowth >= 0.20E0 THEN 'HIGH' "
        "WHEN revenueGrowth >= 0.10E0 THEN 'MEDIUM' ELSE 'LOW' END"
    ),
    "avg_governance_risk": R(
        "(CAST(auditRisk AS DOUBLE) + CAST(boardRisk AS DOUBLE) + CAST(compensationRisk AS DOUBLE)"
        " + CAST(shareHolderRightsRisk AS DOUBLE)) / 4.0E0",
        2,
    ),
}

# --- Fixed values: column lists of the warehouse tables, views and updates. ---
FACT_COLUMNS = [
    ("ticker_id", None), ("ingestion_date", None), ("currentPrice", None),
    ("previousClose", None), ("regularMarketChangePercent", None), ("marketCap", None),
    ("market_cap_cr", None), ("enterpriseValue", None), ("trailingPE", None),
    ("forwardPE", None), ("pegRatio", None), ("priceToBook", None),
    ("enterpriseToRevenue", None), ("enterpriseToEbitda", None), ("trailingEps", None),
    ("forwardEps", None), ("bookValue", None), ("totalRevenue", None), ("revenue_cr", None),
    ("totalCash", None), ("totalDebt", None), ("net_cash_cr", None), ("ebitda", None),
    ("freeCashflow", None), ("operatingCashflow", None), ("netIncomeToCommon", None),
    ("profitMargins", None), ("grossMargins", None), ("operatingMargins", None),
    ("ebitdaMargins", None), ("returnOnAssets", None), ("returnOnEquity", None),
    ("debtToEquity", None), ("currentRatio", None), ("quickRatio", None),
    ("payoutRatio", None), ("revenueGrowth", None), ("earningsGrowth", None),
    ("earningsQuarterlyGrowth", None), ("dividendYield", None), ("dividendRate", None),
    ("fiveYearAvgDividendYield", None), ("beta", None), ("fiftyTwoWeekLow", None),
    ("fiftyTwoWeekHigh", None), ("fiftyDayAverage", None), ("twoHundredDayAverage", None),
    ("week52_change", None), ("sandp_52week_change", None), ("recommendationMean", None),
    ("numberOfAnalystOpinions", "BIGINT"), ("targetMeanPrice", None),
    ("targetHighPrice", None), ("targetLowPrice", None), ("overallRisk", "BIGINT"),
    ("avg_governance_risk", None), ("heldPercentInsiders", None),
    ("heldPercentInstitutions", None), ("pe_category", None), ("roe_category", None),
    ("revenue_growth_category", None), ("week52_position_score", None),
    ("discount_from_52w_high_pct", None), ("above_200dma", None),
    ("analyst_upside_pct", None), ("is_strong_buy", None), ("earnings_yield", None),
]
FACT_NAMES = [n for n, _ in FACT_COLUMNS]

DIMENSION_COLUMNS = [
    "ticker_id", "symbol", "longName", "shortName", "sector", "sectorKey", "industry",
    "industryKey", "country", "city", "currency", "financialCurrency", "exchange",
    "fullExchangeName", "quoteType", "market", "website",
]

UPDATE_FULL = [
    "currentPrice", "marketCap", "market_cap_cr", "revenue_cr", "net_cash_cr", "trailingPE",
    "forwardPE", "revenueGrowth", "earningsGrowth", "profitMargins", "returnOnEquity",
    "pe_category", "roe_category", "revenue_growth_category", "week52_position_score",
    "discount_from_52w_high_pct", "above_200dma", "analyst_upside_pct", "is_strong_buy",
    "earnings_yield", "avg_governance_risk",
]


def q(name: str) -> str:
    return f'"{name}"'


def _features_select(src: str) -> str:
    """Flat rows: every raw column (dividendYield replaced) + the 13 new ones."""
    return (
        f"SELECT * REPLACE ({FEATURES['dividendYield']} AS dividendYield), "
        + ", ".join(f"{expr} AS {name}" for name, expr in FEATURES.items() if name != "dividendYield")
        + f" FROM {src}"
    )


def _dedup_select(src: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in LINEAGE)
    return (
        f"SELECT * FROM {src} QUALIFY row_number() OVER "
        f"(PARTITION BY ticker_id, ingestion_date ORDER BY {order}) = 1"
    )


def _fact_select(src: str) -> str:
    cols = ", ".join(
        f"CAST({q(n)} AS {t}) AS {q(n)}" if t else q(n) for n, t in FACT_COLUMNS
    )
    return f"SELECT {cols} FROM {src}"


def _dim_latest_select(src: str) -> str:
    attrs = [c for c in DIMENSION_COLUMNS if c != "ticker_id"]
    order = ", ".join(["ingestion_date DESC NULLS LAST"] + [f"{q(c)} DESC NULLS LAST" for c in attrs])
    cols = ", ".join(q(c) for c in DIMENSION_COLUMNS)
    return (
        f"SELECT {cols} FROM {src} QUALIFY row_number() OVER "
        f"(PARTITION BY ticker_id ORDER BY {order}) = 1"
    )


def _dim_distinct_select(src: str) -> str:
    return "SELECT DISTINCT " + ", ".join(q(c) for c in DIMENSION_COLUMNS) + f" FROM {src}"


def base_ctes(revision: int = 0, suffix: str = "") -> str:
    """raw → flat → dedup → fact, and both dimensions, as CTEs."""
    s = suffix
    return (
        f"raw{s} AS ({raw_select(revision)}),\n"
        f"flat{s} AS ({_features_select('raw' + s)}),\n"
        f"dedup{s} AS ({_dedup_select('flat' + s)}),\n"
        f"fact{s} AS ({_fact_select('dedup' + s)}),\n"
        f"dim{s} AS ({_dim_latest_select('flat' + s)}),\n"
        f"dim_distinct{s} AS ({_dim_distinct_select('flat' + s)})"
    )


def with_base(select: str) -> str:
    return f"WITH {base_ctes()}\n{select}"


# ------------------------------------------------------------------ statements --

RAW_NAMES = [
    "ticker_id", "ingestion_date", "symbol", "longName", "shortName", "sector", "sectorKey",
    "industry", "industryKey", "country", "city", "currency", "financialCurrency", "exchange",
    "fullExchangeName", "quoteType", "market", "website", "recommendationKey",
    "averageAnalystRating", "currentPrice", "previousClose", "open", "dayLow", "dayHigh",
    "regularMarketChange", "regularMarketChangePercent", "volume", "averageVolume",
    "averageVolume10days", "averageDailyVolume3Month", "fiftyTwoWeekLow", "fiftyTwoWeekHigh",
    "fiftyDayAverage", "twoHundredDayAverage", "week52_change", "sandp_52week_change",
    "marketCap", "enterpriseValue", "trailingPE", "forwardPE", "pegRatio", "trailingPegRatio",
    "priceToBook", "priceToSalesTrailing12Months", "enterpriseToRevenue", "enterpriseToEbitda",
    "bookValue", "trailingEps", "forwardEps", "revenuePerShare", "totalCashPerShare",
    "totalRevenue", "totalCash", "totalDebt", "ebitda", "grossProfits", "freeCashflow",
    "operatingCashflow", "netIncomeToCommon", "profitMargins", "grossMargins",
    "operatingMargins", "ebitdaMargins", "returnOnAssets", "returnOnEquity", "debtToEquity",
    "currentRatio", "quickRatio", "payoutRatio", "revenueGrowth", "earningsGrowth",
    "earningsQuarterlyGrowth", "dividendRate", "dividendYield", "trailingAnnualDividendRate",
    "trailingAnnualDividendYield", "fiveYearAvgDividendYield", "recommendationMean",
    "numberOfAnalystOpinions", "targetHighPrice", "targetLowPrice", "targetMeanPrice",
    "targetMedianPrice", "auditRisk", "boardRisk", "compensationRisk", "shareHolderRightsRisk",
    "overallRisk", "heldPercentInsiders", "heldPercentInstitutions", "sharesOutstanding",
    "floatShares", "beta",
]
FLAT_NAMES = RAW_NAMES + [n for n in FEATURES if n != "dividendYield"]
LINEAGE_EXCLUDE = "EXCLUDE (" + ", ".join(LINEAGE) + ")"


def _cols(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{q(n)}" for n in names)


def _merge_sql(update: list[str]) -> str:
    first = _fact_select("dedup WHERE l_linenumber <= 4")
    second = _fact_select("dedup1 WHERE l_linenumber >= 3")
    exprs = []
    for n in FACT_NAMES:
        if n in update:
            e = f"CASE WHEN s._p THEN s.{q(n)} ELSE t.{q(n)} END"
        else:
            e = f"CASE WHEN t._p IS NULL THEN s.{q(n)} ELSE t.{q(n)} END"
        exprs.append(f"{e} AS {q(n)}")
    return (
        f"WITH {base_ctes()},\n{base_ctes(1, '1')},\n"
        f"t AS (SELECT *, TRUE AS _p FROM ({first})),\n"
        f"s AS (SELECT *, TRUE AS _p FROM ({second}))\n"
        f"SELECT {', '.join(exprs)} FROM s FULL OUTER JOIN t "
        "ON s.ticker_id = t.ticker_id AND s.ingestion_date = t.ingestion_date"
    )


SCREENER_COLS = [
    "ticker_id", "ingestion_date", "currentPrice", "trailingPE", "revenueGrowth",
    "returnOnEquity", "analyst_upside_pct", "is_strong_buy", "week52_position_score",
    "discount_from_52w_high_pct", "market_cap_cr",
]


def _screener(n: int, dim: str = "dim") -> str:
    return with_base(
        "SELECT * FROM (SELECT d.sector AS sector, "
        + _cols(SCREENER_COLS, "q.")
        + ", CAST(row_number() OVER (PARTITION BY d.sector ORDER BY q.trailingPE ASC NULLS FIRST, "
        "q.revenueGrowth DESC NULLS LAST, q.ticker_id ASC NULLS FIRST) AS BIGINT) AS rank "
        "FROM (SELECT f.* FROM fact f JOIN (SELECT ticker_id, max(ingestion_date) AS latest_date "
        "FROM fact GROUP BY ticker_id) l ON f.ticker_id = l.ticker_id AND f.ingestion_date = l.latest_date) q "
        f"JOIN {dim} d ON q.ticker_id = d.ticker_id WHERE q.trailingPE IS NOT NULL) r "
        f"WHERE rank <= {n}"
    )


FUNDAMENTAL = [
    "revenueGrowth", "revenue_growth_category", "profitMargins", "grossMargins",
    "operatingMargins", "returnOnEquity", "roe_category", "returnOnAssets", "market_cap_cr",
    "revenue_cr", "net_cash_cr", "dividendYield", "payoutRatio",
]
TECHNICAL = [
    "ticker_id", "ingestion_date", "currentPrice", "previousClose", "regularMarketChangePercent",
    "beta", "trailingPE", "forwardPE", "pe_category", "fiftyDayAverage", "twoHundredDayAverage",
    "above_200dma", "week52_position_score", "discount_from_52w_high_pct", "week52_change",
    "sandp_52week_change",
]
ANALYST = [
    "currentPrice", "targetMeanPrice", "targetHighPrice", "targetLowPrice", "analyst_upside_pct",
    "recommendationMean", "numberOfAnalystOpinions", "is_strong_buy",
]

FUNDAMENTAL_SQL = with_base(
    "SELECT q.ticker_id, q.ingestion_date, d.sector, d.industry, " + _cols(FUNDAMENTAL, "q.")
    + " FROM fact q LEFT JOIN dim d ON q.ticker_id = d.ticker_id"
)

RAW_DEDUP = (
    "raw_dedup AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY ticker_id, "
    "ingestion_date ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in LINEAGE) + ") = 1)"
)
PAYLOAD = [n for n in RAW_NAMES if n not in ("ticker_id", "ingestion_date")]
EMPTY_DOC = "(" + " AND ".join(f"{q(n)} IS NULL" for n in PAYLOAD) + ")"

LEDGER = (
    "ledger AS (SELECT o_orderpriority AS dag_id, "
    "CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status, "
    "o_orderdate + to_seconds(o_orderkey) AS updated_ts, "
    "CAST(o_orderdate AS DATE) AS process_date FROM orders)"
)


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    feature_names = {
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
    for key, col in feature_names.items():
        out[key] = with_base(f"SELECT ticker_id, ingestion_date, {q(col)} FROM flat")
    out["P1_rename"] = with_base(
        "SELECT ticker_id, ingestion_date, week52_change, sandp_52week_change FROM raw"
    )
    out["P2_flatten"] = with_base(
        "SELECT ticker_id, ingestion_date, sector AS profile_sector, industry AS profile_industry, "
        "fiftyTwoWeekLow AS range52_fiftyTwoWeekLow, fiftyTwoWeekHigh AS range52_fiftyTwoWeekHigh FROM raw"
    )
    out["P9_transform"] = with_base(f"SELECT {_cols(FLAT_NAMES)} FROM flat")
    out["R5_dedup"] = with_base(f"SELECT {_cols(FLAT_NAMES)} FROM dedup")
    total = ", ".join(
        f"{q(n)} ASC NULLS FIRST" for n in FLAT_NAMES if n not in ("ticker_id", "ingestion_date")
    )
    out["R5_dedup_total_order"] = with_base(
        f"SELECT {_cols(FLAT_NAMES)} FROM flat QUALIFY row_number() OVER "
        f"(PARTITION BY ticker_id, ingestion_date ORDER BY {total}) = 1"
    )
    out["A1_latest_date"] = with_base(
        "SELECT ticker_id, max(ingestion_date) AS latest_date FROM fact GROUP BY ticker_id"
    )
    out["J2_latest_rows"] = with_base(
        f"SELECT {_cols(FACT_NAMES, 'f.')} FROM fact f JOIN (SELECT ticker_id, max(ingestion_date) "
        "AS latest_date FROM fact GROUP BY ticker_id) l ON f.ticker_id = l.ticker_id "
        "AND f.ingestion_date = l.latest_date"
    )
    out["A2_dimension_distinct"] = with_base("SELECT * FROM dim_distinct")
    out["A4_dimension_latest"] = with_base("SELECT * FROM dim")
    out["W2_top3_per_sector"] = _screener(3)
    out["Q1_fundamental_view"] = FUNDAMENTAL_SQL
    out["Q2_technical_view"] = with_base(f"SELECT {_cols(TECHNICAL)} FROM fact")
    out["Q3_analyst_view"] = with_base(
        "SELECT q.ticker_id, q.ingestion_date, d.sector, " + _cols(ANALYST, "q.")
        + " FROM fact q LEFT JOIN dim d ON q.ticker_id = d.ticker_id"
    )
    out["Q4_undervalued_stocks_view"] = _screener(1)
    out["Q4_undervalued_distinct_dimension"] = _screener(1, "dim_distinct")
    out["K5_registered_views"] = FUNDAMENTAL_SQL
    out["K1_flat_append"] = with_base(f"SELECT {_cols(FLAT_NAMES)} FROM flat")
    out["K1_flat_replace_dates"] = out["K1_flat_append"]
    out["K3_upsert"] = _merge_sql(UPDATE_FULL)
    out["K3_upsert_scheduled_columns"] = _merge_sql(UPDATE_SCHEDULED)
    out["K4_dimension_refresh"] = with_base("SELECT * FROM dim")
    out["S1_read_snapshots"] = (
        f"WITH raw AS ({raw_select()}), {RAW_DEDUP}\nSELECT {_cols(RAW_NAMES)} FROM raw_dedup"
    )
    out["K6_landing_summary"] = (
        f"WITH raw AS ({raw_select()}), {RAW_DEDUP}\n"
        "SELECT strftime(ingestion_date, '%Y-%m-%d') AS date, count(*) AS files "
        "FROM raw_dedup GROUP BY 1"
    )
    out["S6_ticker_universe"] = (
        "SELECT DISTINCT 'P' || CAST(l_partkey AS VARCHAR) AS ticker FROM lineitem "
        "WHERE l_partkey IS NOT NULL"
    )
    out["R1_landing_coverage"] = (
        f"WITH raw AS ({raw_select()}), {RAW_DEDUP},\n"
        "u AS (SELECT DISTINCT 'P' || CAST(p_partkey AS VARCHAR) AS ticker_id FROM part),\n"
        f"tagged AS (SELECT r.ingestion_date, u.ticker_id IS NOT NULL AS expected, {EMPTY_DOC} AS empty "
        "FROM raw_dedup r LEFT JOIN u ON r.ticker_id = u.ticker_id)\n"
        "SELECT ingestion_date, (SELECT count(*) FROM u) AS expected, count(*) AS landed, "
        "count(*) FILTER (WHERE expected AND NOT empty) AS ok, "
        "count(*) FILTER (WHERE expected AND empty) AS empty, "
        "count(*) FILTER (WHERE NOT expected) AS unexpected, "
        "(SELECT count(*) FROM u) - count(*) FILTER (WHERE expected AND NOT empty) "
        "- count(*) FILTER (WHERE expected AND empty) AS missing "
        "FROM tagged GROUP BY ingestion_date"
    )
    out["R2_ledger_status"] = (
        f"WITH {LEDGER},\n"
        "agg AS (SELECT dag_id, count(*) AS runs, count(*) FILTER (WHERE status = 'FAILED') AS failures "
        "FROM ledger GROUP BY dag_id),\n"
        "last AS (SELECT dag_id, status AS last_status, process_date AS last_process_date FROM ledger "
        "QUALIFY row_number() OVER (PARTITION BY dag_id ORDER BY updated_ts DESC NULLS LAST, "
        "status DESC NULLS LAST, process_date DESC NULLS LAST) = 1)\n"
        "SELECT agg.dag_id, runs, failures, last_status, last_process_date "
        "FROM agg JOIN last ON agg.dag_id IS NOT DISTINCT FROM last.dag_id"
    )
    out["R4_dates_to_process"] = (
        f"WITH {LEDGER},\n"
        "landed AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS ingestion_date "
        "FROM lineitem JOIN part ON l_partkey = p_partkey)\n"
        "SELECT ingestion_date FROM landed l WHERE ingestion_date IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM ledger g WHERE g.status = 'SUCCESS' AND g.process_date = l.ingestion_date)"
    )
    out["Q5_daily_load"] = with_base("SELECT * FROM fact")
    out["R3_incremental_stream"] = with_base("SELECT * FROM fact")
    w5 = "PARTITION BY ticker_id ORDER BY ingestion_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"
    out["V1_moving_average_5"] = with_base(
        f"SELECT ticker_id, ingestion_date, currentPrice, {R(f'avg(currentPrice) OVER ({w5})', 6)} AS ma_5 "
        "FROM fact"
    )
    out["V2_volatility_5"] = with_base(
        "SELECT ticker_id, ingestion_date, currentPrice, " + R("r", 6) + " AS daily_return, "
        + R(f"stddev_samp(r) OVER ({w5})", 6) + " AS volatility_5 FROM (SELECT *, currentPrice / "
        "lag(currentPrice) OVER (PARTITION BY ticker_id ORDER BY ingestion_date) - 1 AS r FROM fact)"
    )
    out["V1_V2_maintained_trends_5"] = with_base(
        f"SELECT ticker_id, ingestion_date, currentPrice, {R(f'avg(currentPrice) OVER ({w5})', 6)} AS ma_5, "
        + R("r", 6) + " AS daily_return, " + R(f"stddev_samp(r) OVER ({w5})", 6) + " AS volatility_5 FROM (SELECT *, "
        "currentPrice / lag(currentPrice) OVER (PARTITION BY ticker_id ORDER BY ingestion_date) - 1 AS r FROM fact)"
    )
    out["V3_relative_52w_change"] = with_base(
        "SELECT ticker_id, ingestion_date, week52_change - sandp_52week_change AS relative_52w_change "
        "FROM fact"
    )
    out["K4_dimension_refresh_twice"] = f"WITH {base_ctes()}\n" + _dim_latest_select(
        "(SELECT * FROM flat WHERE l_linenumber = 7)"
    )
    out["K4_dimension_incremental_reload"] = f"WITH {base_ctes()}\n" + _dim_latest_select(
        "(SELECT * FROM flat WHERE ingestion_date < DATE '1996-01-01' UNION ALL "
        "SELECT * REPLACE (industry AS sector) FROM flat "
        "WHERE ingestion_date >= DATE '1996-01-01' AND l_linenumber <= 3)"
    )
    out["K5_catalog_views"] = _screener(1)
    skipped = "FROM dedup WHERE l_orderkey % 29 <> 0"
    out["F5_skip_empty"] = with_base(_fact_select("(SELECT * " + skipped + ")"))
    out["K7_archived_files"] = out["K6_landing_summary"]
    out["K8_ledger_rows"] = with_base(
        "SELECT DISTINCT 'daily_snapshot_load' AS dag_id, 'SUCCESS' AS status, "
        "ingestion_date AS process_date, TRUE AS stamped FROM raw"
    )
    out["P7_cast_date"] = with_base("SELECT * FROM fact")
    out["R5_dedup_latest_load"] = (
        f"WITH {base_ctes()},\n{base_ctes(1, '1')},\n"
        f"loads AS (SELECT {_cols(FLAT_NAMES)}, 0 AS seq FROM flat UNION ALL "
        f"SELECT {_cols(FLAT_NAMES)}, 1 AS seq FROM flat1 WHERE l_linenumber >= 3)\n"
        f"SELECT {_cols(FLAT_NAMES)} FROM loads QUALIFY row_number() OVER "
        f"(PARTITION BY ticker_id, ingestion_date ORDER BY seq DESC, {total}) = 1"
    )
    out["S4_read_single_date"] = (
        f"WITH raw AS ({raw_select()}), {RAW_DEDUP}\nSELECT {_cols(RAW_NAMES)} FROM raw_dedup "
        "WHERE ingestion_date = (SELECT max(ingestion_date) FROM raw)"
    )
    out["Q5_daily_load_single_date"] = with_base(
        "SELECT * FROM fact WHERE ingestion_date = (SELECT max(ingestion_date) FROM fact)"
    )
    out["R1_landing_coverage_due_dates"] = (
        f"WITH landed AS ({out['R1_landing_coverage']}),\n"
        "due AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS ingestion_date FROM orders),\n"
        "n AS (SELECT count(DISTINCT p_partkey) AS expected FROM part)\n"
        "SELECT ingestion_date, n.expected, " + ", ".join(
            f"coalesce({c}, 0) AS {c}" for c in ("landed", "ok", "empty", "unexpected"))
        + ", coalesce(missing, n.expected) AS missing FROM n, landed FULL JOIN due USING (ingestion_date)"
    )
    gaps = (
        "gaps AS (SELECT * REPLACE (CASE WHEN trailingPE IS NULL THEN 0.0E0 ELSE currentPrice END AS currentPrice, "
        "CASE WHEN coalesce(trailingPE, 0) <> 17 THEN ticker_id END AS ticker_id) FROM fact)"
    )
    out["V1_moving_average_5_gaps"] = (
        f"WITH {base_ctes()},\n{gaps}\nSELECT ticker_id, ingestion_date, currentPrice, CASE WHEN ticker_id IS NULL THEN "
        f"{R('currentPrice', 6)} ELSE {R(f'avg(currentPrice) OVER ({w5})', 6)} END AS ma_5 FROM gaps"
    )
    out["V2_volatility_5_gaps"] = (
        f"WITH {base_ctes()},\n{gaps},\nreturns AS (SELECT *, CASE WHEN ticker_id IS NOT NULL THEN currentPrice / "
        "nullif(lag(currentPrice) OVER (PARTITION BY ticker_id ORDER BY ingestion_date), 0) - 1 END AS r FROM gaps)\n"
        "SELECT ticker_id, ingestion_date, currentPrice, " + R("r", 6) + " AS daily_return, "
        f"CASE WHEN ticker_id IS NOT NULL THEN {R(f'stddev_samp(r) OVER ({w5})', 6)} END AS volatility_5 FROM returns"
    )
    merged = f"merged AS (SELECT {_cols(FACT_NAMES)} FROM ({_merge_sql(UPDATE_FULL)}))"
    last = "SELECT * FROM merged WHERE ticker_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker_id ORDER BY ingestion_date DESC) = 1"
    out["J2_maintained_latest_rows"] = f"WITH {merged}\n{last}"
    out["Q4_maintained_latest"] = (
        f"WITH {base_ctes()},\n{merged},\nlast AS ({last})\n"
        "SELECT * FROM (SELECT d.sector AS sector, " + _cols(SCREENER_COLS, "q.")
        + ", CAST(row_number() OVER (PARTITION BY d.sector ORDER BY q.trailingPE ASC NULLS FIRST, "
        "q.revenueGrowth DESC NULLS LAST, q.ticker_id ASC NULLS FIRST) AS BIGINT) AS rank "
        "FROM last q JOIN dim d ON q.ticker_id = d.ticker_id WHERE q.trailingPE IS NOT NULL) WHERE rank = 1"
    )

    out["K5_catalog_views_after_next_load"] = (
        f"WITH {base_ctes()},\n{merged}\nSELECT q.ticker_id, q.ingestion_date, d.sector, d.industry, " + _cols(FUNDAMENTAL, "q.")
        + " FROM merged q LEFT JOIN dim d ON q.ticker_id = d.ticker_id"
    )
    out["K2_clustered_fundamental_view"] = FUNDAMENTAL_SQL
    out["K1_flat_split_days"] = out["K1_flat_append"]
    out["F5_quarantine"] = with_base(
        "SELECT ingestion_date, ticker_id, 'empty' AS reason FROM dedup WHERE l_orderkey % 29 = 0")
    out["Q5_retry_after_partial_archive"] = with_base(
        "SELECT ingestion_date, 1 AS failed, 1 AS succeeded, count(*) AS files, count(*) AS facts FROM fact GROUP BY ingestion_date")
    out["R1_outages"] = (
        f"WITH raw AS ({raw_select()}), {RAW_DEDUP},\n"
        "due AS (SELECT *, row_number() OVER (ORDER BY ingestion_date) AS no FROM "
        "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS ingestion_date FROM orders)),\n"
        "u AS (SELECT DISTINCT 'P' || CAST(p_partkey AS VARCHAR) AS ticker_id FROM part),\n"
        f"ok AS (SELECT DISTINCT ticker_id, ingestion_date FROM raw_dedup WHERE NOT {EMPTY_DOC}),\n"
        "missed AS (SELECT u.ticker_id, due.ingestion_date, no, no - row_number() OVER (PARTITION BY u.ticker_id ORDER BY no) AS run "
        "FROM u CROSS JOIN due ANTI JOIN ok ON ok.ticker_id = u.ticker_id AND ok.ingestion_date = due.ingestion_date)\n"
        "SELECT ticker_id, min(ingestion_date) AS first_date, max(ingestion_date) AS last_date, count(*) AS days "
        "FROM missed GROUP BY ticker_id, run"
    )

    def held(fact: str, horizon: int, n: int) -> str:
        later = (
            f"(SELECT {{what}} FROM {fact} f WHERE f.ticker_id = p.ticker_id AND f.currentPrice IS NOT NULL "
            f"AND f.ingestion_date > p.ingestion_date AND f.ingestion_date <= p.ingestion_date + INTERVAL {horizon} DAY)"
        )
        return (
            "picks AS (SELECT q.ingestion_date, d.sector, q.ticker_id, q.currentPrice AS entry_price, "
            "CAST(row_number() OVER (PARTITION BY q.ingestion_date, d.sector ORDER BY q.trailingPE, "
            "q.revenueGrowth DESC NULLS LAST, q.ticker_id) AS BIGINT) AS rank "
            f"FROM {fact} q JOIN dim d ON q.ticker_id = d.ticker_id WHERE q.trailingPE IS NOT NULL QUALIFY rank <= {n}),\n"
            f"held AS (SELECT *, {later.format(what='max(f.ingestion_date)')} AS exit_date, "
            f"{later.format(what='arg_max(f.currentPrice, f.ingestion_date)')} AS exit_price FROM picks p),\n"
            f"tested AS (SELECT *, {R('exit_price / nullif(entry_price, 0) - 1', 6)} AS forward_return FROM held)"
        )

    out["B1_backtest_30_days"] = f"WITH {base_ctes()},\n{held('fact', 30, 1)}\nSELECT * FROM tested"
    out["B1_backtest_90_days_gaps"] = f"WITH {base_ctes()},\n{gaps},\n{held('gaps', 90, 3)}\nSELECT * FROM tested"
    out["B2_backtest_summary"] = (
        f"WITH {base_ctes()},\n{held('fact', 30, 1)}\nSELECT sector, count(*) AS picks, count(forward_return) AS settled, "
        f"count(*) FILTER (WHERE forward_return > 0) AS gained, {R('avg(forward_return)', 6)} AS mean_return FROM tested GROUP BY sector"
    )

    def compared(fact: str) -> str:
        return (
            "own AS (SELECT ticker_id, ingestion_date, currentPrice / nullif(lag(currentPrice) OVER (PARTITION BY ticker_id "
            f"ORDER BY ingestion_date), 0) - 1 AS r FROM {fact} WHERE ticker_id IS NOT NULL),\n"
            "market AS (SELECT ingestion_date, avg(r) AS index_return FROM own WHERE r IS NOT NULL GROUP BY ingestion_date),\n"
            "both_sides AS (SELECT own.*, index_return, CASE WHEN r IS NOT NULL THEN index_return END AS m "
            "FROM own LEFT JOIN market USING (ingestion_date))"
        )

    def ratios(over: str) -> tuple[str, str]:
        beta = f"covar_samp(r, m) {over} / nullif(var_samp(m) {over}, 0)"
        return R(beta, 6), R(f"covar_samp(r, m) {over} / nullif(stddev_samp(r) {over} * stddev_samp(m) {over}, 0)", 6)

    beta, correlation = ratios(f"OVER ({w5})")
    for name, fact in (("V4_rolling_beta_5", "fact"), ("V4_rolling_beta_5_gaps", "gaps")):
        out[name] = (
            f"WITH {base_ctes()},\n{gaps},\n{compared(fact)}\nSELECT ticker_id, ingestion_date, {R('r', 6)} AS daily_return, "
            f"{R('index_return', 6)} AS index_return, {beta} AS beta_5, {correlation} AS correlation_5 FROM both_sides"
        )
    beta, correlation = ratios("")
    out["V5_ticker_beta"] = (
        f"WITH {base_ctes()},\n{compared('fact')}\nSELECT ticker_id, count(r) AS returns, {beta} AS beta, {correlation} AS correlation, "
        f"{R('avg(r - index_return)', 6)} AS mean_excess_return FROM both_sides GROUP BY ticker_id"
    )
    return out


UPDATE_SCHEDULED = [
    "currentPrice", "marketCap", "market_cap_cr", "trailingPE", "revenueGrowth", "profitMargins",
    "pe_category", "roe_category", "revenue_growth_category", "week52_position_score",
    "discount_from_52w_high_pct", "above_200dma", "analyst_upside_pct", "is_strong_buy",
    "earnings_yield", "avg_governance_risk",
]
