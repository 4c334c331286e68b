"""Column contracts for every table the pipeline reads or writes.

The raw snapshot contract is declared, never inferred: a key missing from a
document reads as NULL, a key not listed here is never materialised.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Type names accepted in a declared column list.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}

# --- Fixed values: raw snapshot columns (name, type), in document order. ---
# These names are the keys of the upstream market-data documents and must be
# spelled exactly so (the JSON key match is case-sensitive).
RAW_COLUMNS: list[tuple[str, str]] = [
    ("ticker_id", "string"),
    ("ingestion_date", "date"),
    ("symbol", "string"),
    ("longName", "string"),
    ("shortName", "string"),
    ("sector", "string"),
    ("sectorKey", "string"),
    ("industry", "string"),
    ("industryKey", "string"),
    ("country", "string"),
    ("city", "string"),
    ("currency", "string"),
    ("financialCurrency", "string"),
    ("exchange", "string"),
    ("fullExchangeName", "string"),
    ("quoteType", "string"),
    ("market", "string"),
    ("website", "string"),
    ("recommendationKey", "string"),
    ("averageAnalystRating", "string"),
    ("currentPrice", "double"),
    ("previousClose", "double"),
    ("open", "double"),
    ("dayLow", "double"),
    ("dayHigh", "double"),
    ("regularMarketChange", "double"),
    ("regularMarketChangePercent", "double"),
    ("volume", "long"),
    ("averageVolume", "long"),
    ("averageVolume10days", "long"),
    ("averageDailyVolume3Month", "long"),
    ("fiftyTwoWeekLow", "double"),
    ("fiftyTwoWeekHigh", "double"),
    ("fiftyDayAverage", "double"),
    ("twoHundredDayAverage", "double"),
    ("52WeekChange", "double"),
    ("SandP52WeekChange", "double"),
    ("marketCap", "long"),
    ("enterpriseValue", "long"),
    ("trailingPE", "double"),
    ("forwardPE", "double"),
    ("pegRatio", "double"),
    ("trailingPegRatio", "double"),
    ("priceToBook", "double"),
    ("priceToSalesTrailing12Months", "double"),
    ("enterpriseToRevenue", "double"),
    ("enterpriseToEbitda", "double"),
    ("bookValue", "double"),
    ("trailingEps", "double"),
    ("forwardEps", "double"),
    ("revenuePerShare", "double"),
    ("totalCashPerShare", "double"),
    ("totalRevenue", "long"),
    ("totalCash", "long"),
    ("totalDebt", "long"),
    ("ebitda", "long"),
    ("grossProfits", "long"),
    ("freeCashflow", "long"),
    ("operatingCashflow", "long"),
    ("netIncomeToCommon", "long"),
    ("profitMargins", "double"),
    ("grossMargins", "double"),
    ("operatingMargins", "double"),
    ("ebitdaMargins", "double"),
    ("returnOnAssets", "double"),
    ("returnOnEquity", "double"),
    ("debtToEquity", "double"),
    ("currentRatio", "double"),
    ("quickRatio", "double"),
    ("payoutRatio", "double"),
    ("revenueGrowth", "double"),
    ("earningsGrowth", "double"),
    ("earningsQuarterlyGrowth", "double"),
    ("dividendRate", "double"),
    ("dividendYield", "double"),
    ("trailingAnnualDividendRate", "double"),
    ("trailingAnnualDividendYield", "double"),
    ("fiveYearAvgDividendYield", "double"),
    ("recommendationMean", "double"),
    ("numberOfAnalystOpinions", "integer"),
    ("targetHighPrice", "double"),
    ("targetLowPrice", "double"),
    ("targetMeanPrice", "double"),
    ("targetMedianPrice", "double"),
    ("auditRisk", "integer"),
    ("boardRisk", "integer"),
    ("compensationRisk", "integer"),
    ("shareHolderRightsRisk", "integer"),
    ("overallRisk", "integer"),
    ("heldPercentInsiders", "double"),
    ("heldPercentInstitutions", "double"),
    ("sharesOutstanding", "long"),
    ("floatShares", "long"),
    ("beta", "double"),
]

# --- Fixed values: document keys that are not legal warehouse column names. ---
RENAMES: dict[str, str] = {
    "52WeekChange": "week52_change",
    "SandP52WeekChange": "sandp_52week_change",
}

# --- Fixed values: derived columns appended by the feature step, in order. ---
DERIVED_COLUMNS: list[tuple[str, str]] = [
    ("market_cap_cr", "double"),
    ("pe_category", "string"),
    ("week52_position_score", "double"),
    ("discount_from_52w_high_pct", "double"),
    ("above_200dma", "boolean"),
    ("analyst_upside_pct", "double"),
    ("is_strong_buy", "boolean"),
    ("net_cash_cr", "double"),
    ("revenue_cr", "double"),
    ("earnings_yield", "double"),
    ("roe_category", "string"),
    ("revenue_growth_category", "string"),
    ("avg_governance_risk", "double"),
]

# --- Fixed values: fact table columns (name, type), in table order. ---
FACT_COLUMNS: list[tuple[str, str]] = [
    ("ticker_id", "string"),
    ("ingestion_date", "date"),
    ("currentPrice", "double"),
    ("previousClose", "double"),
    ("regularMarketChangePercent", "double"),
    ("marketCap", "long"),
    ("market_cap_cr", "double"),
    ("enterpriseValue", "long"),
    ("trailingPE", "double"),
    ("forwardPE", "double"),
    ("pegRatio", "double"),
    ("priceToBook", "double"),
    ("enterpriseToRevenue", "double"),
    ("enterpriseToEbitda", "double"),
    ("trailingEps", "double"),
    ("forwardEps", "double"),
    ("bookValue", "double"),
    ("totalRevenue", "long"),
    ("revenue_cr", "double"),
    ("totalCash", "long"),
    ("totalDebt", "long"),
    ("net_cash_cr", "double"),
    ("ebitda", "long"),
    ("freeCashflow", "long"),
    ("operatingCashflow", "long"),
    ("netIncomeToCommon", "long"),
    ("profitMargins", "double"),
    ("grossMargins", "double"),
    ("operatingMargins", "double"),
    ("ebitdaMargins", "double"),
    ("returnOnAssets", "double"),
    ("returnOnEquity", "double"),
    ("debtToEquity", "double"),
    ("currentRatio", "double"),
    ("quickRatio", "double"),
    ("payoutRatio", "double"),
    ("revenueGrowth", "double"),
    ("earningsGrowth", "double"),
    ("earningsQuarterlyGrowth", "double"),
    ("dividendYield", "double"),
    ("dividendRate", "double"),
    ("fiveYearAvgDividendYield", "double"),
    ("beta", "double"),
    ("fiftyTwoWeekLow", "double"),
    ("fiftyTwoWeekHigh", "double"),
    ("fiftyDayAverage", "double"),
    ("twoHundredDayAverage", "double"),
    ("week52_change", "double"),
    ("sandp_52week_change", "double"),
    ("recommendationMean", "double"),
    ("numberOfAnalystOpinions", "long"),
    ("targetMeanPrice", "double"),
    ("targetHighPrice", "double"),
    ("targetLowPrice", "double"),
    ("overallRisk", "long"),
    ("avg_governance_risk", "double"),
    ("heldPercentInsiders", "double"),
    ("heldPercentInstitutions", "double"),
    ("pe_category", "string"),
    ("roe_category", "string"),
    ("revenue_growth_category", "string"),
    ("week52_position_score", "double"),
    ("discount_from_52w_high_pct", "double"),
    ("above_200dma", "boolean"),
    ("analyst_upside_pct", "double"),
    ("is_strong_buy", "boolean"),
    ("earnings_yield", "double"),
]

# --- Fixed values: columns the upsert overwrites on a key match. ---
# The warehouse-file statement sets 21 columns; the scheduled statement 16.
UPDATE_COLUMNS_FULL: list[str] = [
    "currentPrice",
    "marketCap",
    "market_cap_cr",
    "revenue_cr",
    "net_cash_cr",
    "trailingPE",
    "forwardPE",
    "revenueGrowth",
    "earningsGrowth",
    "profitMargins",
    "returnOnEquity",
    "pe_category",
    "roe_category",
    "revenue_growth_category",
    "week52_position_score",
    "discount_from_52w_high_pct",
    "above_200dma",
    "analyst_upside_pct",
    "is_strong_buy",
    "earnings_yield",
    "avg_governance_risk",
]
UPDATE_COLUMNS_SCHEDULED: list[str] = [
    "currentPrice",
    "marketCap",
    "market_cap_cr",
    "trailingPE",
    "revenueGrowth",
    "profitMargins",
    "pe_category",
    "roe_category",
    "revenue_growth_category",
    "week52_position_score",
    "discount_from_52w_high_pct",
    "above_200dma",
    "analyst_upside_pct",
    "is_strong_buy",
    "earnings_yield",
    "avg_governance_risk",
]

# --- Fixed values: descriptive (dimension) columns, in table order. ---
DIMENSION_COLUMNS: list[str] = [
    "ticker_id",
    "symbol",
    "longName",
    "shortName",
    "sector",
    "sectorKey",
    "industry",
    "industryKey",
    "country",
    "city",
    "currency",
    "financialCurrency",
    "exchange",
    "fullExchangeName",
    "quoteType",
    "market",
    "website",
]

KEY_COLUMNS: list[str] = ["ticker_id", "ingestion_date"]

# Columns that carry no market data: a document whose every other column is
# NULL is reported as empty.
NON_PAYLOAD_COLUMNS: frozenset[str] = frozenset(KEY_COLUMNS)


def struct_of(columns: list[tuple[str, str]]) -> T.StructType:
    """Build an all-nullable StructType from (name, type-name) pairs."""
    return T.StructType(
        [T.StructField(name, TYPE_NAMES[kind], True) for name, kind in columns]
    )


RAW_SCHEMA: T.StructType = struct_of(RAW_COLUMNS)
FACT_SCHEMA: T.StructType = struct_of(FACT_COLUMNS)


def _flat_columns() -> list[tuple[str, str]]:
    cols = [(RENAMES.get(n, n), k) for n, k in RAW_COLUMNS]
    return cols + DERIVED_COLUMNS


FLAT_COLUMNS: list[tuple[str, str]] = _flat_columns()
FLAT_SCHEMA: T.StructType = struct_of(FLAT_COLUMNS)

# Kept beside the flat columns in storage: when a row was loaded, by which load,
# and the version its file name gives. Of two loads of a key the later wins.
LOAD_TIME, LOAD_ID, DOC_VERSION = LOAD_COLUMNS = ("load_ts", "load_id", "doc_version")
# Where a stored row lies, while the rows of a key are compared: its file, and its number in that.
FILE_PATH, FILE_ROW = LOCATION_COLUMNS = ("_file_path", "_file_row")
FLAT_STORED_SCHEMA: T.StructType = T.StructType(
    FLAT_SCHEMA.fields
    + [
        T.StructField(LOAD_TIME, T.TimestampType(), True),
        T.StructField(LOAD_ID, T.StringType(), True),
        T.StructField(DOC_VERSION, T.LongType(), True),
    ]
)

PAYLOAD_COLUMNS: list[str] = [n for n, _ in RAW_COLUMNS if n not in NON_PAYLOAD_COLUMNS]

LEDGER_SCHEMA: T.StructType = T.StructType(
    [
        T.StructField("dag_id", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("updated_ts", T.TimestampType(), True),
        T.StructField("process_date", T.DateType(), True),
    ]
)


def schema_from_list(columns: list[dict] | list[tuple[str, str]]) -> T.StructType:
    """Declarative schema: a list of {name, type} entries (or pairs) → struct.

    Unknown type names raise ``KeyError`` naming the offending column.
    """
    pairs: list[tuple[str, str]] = []
    for entry in columns:
        if isinstance(entry, dict):
            name, kind = entry["name"], entry["type"]
        else:
            name, kind = entry
        if kind not in TYPE_NAMES:
            raise KeyError(f"column {name!r}: unknown type {kind!r}")
        pairs.append((name, kind))
    return struct_of(pairs)
