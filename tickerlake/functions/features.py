"""Cleaning and derived features, all as native Column expressions.

Every feature is row-local, so the whole step compiles into the same
whole-stage-codegen span as the scan that feeds it: no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.schema import RENAMES

c = F.col

# --- Fixed values: feature thresholds and scale factors. ---
CRORE = 1e7  # market cap, revenue and net cash are reported in crores
DIVIDEND_YIELD_CAP = 100  # a yield above this is treated as a data error
PE_LOW, PE_MEDIUM = 15, 25  # < 15 LOW, < 25 MEDIUM, else HIGH
STRONG_BUY_MAX = 1.5  # consensus rating on a 1 (strong buy) .. 5 scale
ROE_HIGH, ROE_MEDIUM = 0.25, 0.15  # >= HIGH, >= MEDIUM, else LOW
GROWTH_HIGH, GROWTH_MEDIUM = 0.20, 0.10  # >= HIGH, >= MEDIUM, else LOW
GOVERNANCE_PARTS = ["auditRisk", "boardRisk", "compensationRisk", "shareHolderRightsRisk"]



def _null(kind: T.DataType) -> Column:
    return F.lit(None).cast(kind)



# ---------------------------------------------------------------- P1, P2 --

def rename_problematic_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename document keys that are illegal as warehouse column names.

    Names that are absent are skipped (``withColumnsRenamed`` ignores them).
    """
    return df.withColumnsRenamed(dict(RENAMES if renames is None else renames))


def flatten_df(df: DataFrame) -> DataFrame:
    """Lift struct columns one level, ``parent_child`` names, order kept.

    Raises ``ValueError`` when two output names would collide.
    """
    cols: list[Column] = []
    names: list[str] = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            for sub in field.dataType.fields:
                out = f"{field.name}_{sub.name}"
                cols.append(c(f"`{field.name}`.`{sub.name}`").alias(out))
                names.append(out)
        else:
            cols.append(c(f"`{field.name}`"))
            names.append(field.name)
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"flatten would produce duplicate columns: {dupes}")
    return df.select(cols)


# ------------------------------------------------------------- E1 .. E14 --

def _to_crore(x: Column) -> Column:
    return F.when(x.isNotNull(), F.round(x / F.lit(CRORE), 2)).otherwise(_null(T.DoubleType()))


def market_cap_cr() -> Column:
    """Market cap in crores, 2 decimals."""
    return _to_crore(c("marketCap"))


def capped_dividend_yield() -> Column:
    """A dividend yield above the cap becomes NULL (exactly the cap stays)."""
    return F.when(c("dividendYield") > DIVIDEND_YIELD_CAP, _null(T.DoubleType())).otherwise(
        c("dividendYield")
    )


def pe_category() -> Column:
    """LOW / MEDIUM / HIGH trailing-PE bucket; NULL stays NULL."""
    pe = c("trailingPE")
    return (
        F.when(pe.isNull(), _null(T.StringType()))
        .when(pe < PE_LOW, F.lit("LOW"))
        .when(pe < PE_MEDIUM, F.lit("MEDIUM"))
        .otherwise(F.lit("HIGH"))
    )


def week52_position_score() -> Column:
    """Where the price sits in the 52-week range, 0..100 (not clamped)."""
    lo, hi, px = c("fiftyTwoWeekLow"), c("fiftyTwoWeekHigh"), c("currentPrice")
    span = hi - lo
    return F.when(span > 0, F.round((px - lo) / span * 100, 2)).otherwise(_null(T.DoubleType()))


def discount_from_52w_high_pct() -> Column:
    """E5: percent below the 52-week high (deeper discount → larger number)."""
    hi, px = c("fiftyTwoWeekHigh"), c("currentPrice")
    return F.when(hi > 0, F.round((hi - px) / hi * 100, 2)).otherwise(_null(T.DoubleType()))


def above_200dma() -> Column:
    """Price above its 200-day average; NULL when either side is NULL."""
    px, dma = c("currentPrice"), c("twoHundredDayAverage")
    return (
        F.when(px.isNull() | dma.isNull(), _null(T.BooleanType()))
        .when(px > dma, F.lit(True))
        .otherwise(F.lit(False))
    )


def analyst_upside_pct() -> Column:
    """Percent upside from price to the mean analyst target."""
    tgt, px = c("targetMeanPrice"), c("currentPrice")
    return F.when(
        tgt.isNotNull() & (px > 0), F.round((tgt - px) / px * 100, 2)
    ).otherwise(_null(T.DoubleType()))


def is_strong_buy() -> Column:
    """Consensus rating at or below the strong-buy mark."""
    rm = c("recommendationMean")
    return (
        F.when(rm.isNull(), _null(T.BooleanType()))
        .when(rm <= STRONG_BUY_MAX, F.lit(True))
        .otherwise(F.lit(False))
    )


def net_cash_cr() -> Column:
    """(cash - debt) in crores. Exact long subtraction; overflow → NULL."""
    cash, debt = c("totalCash"), c("totalDebt")
    return F.when(
        cash.isNotNull() & debt.isNotNull(),
        F.round(F.try_subtract(cash, debt) / F.lit(CRORE), 2),
    ).otherwise(_null(T.DoubleType()))


def revenue_cr() -> Column:
    """Total revenue in crores, 2 decimals."""
    return _to_crore(c("totalRevenue"))


def earnings_yield() -> Column:
    """1 / trailing PE, 4 decimals; NULL for a NULL or zero PE."""
    pe = c("trailingPE")
    return F.when(
        pe.isNotNull() & (pe != 0), F.round(F.lit(1.0) / pe, 4)
    ).otherwise(_null(T.DoubleType()))


def _tier(x: Column, high: float, medium: float) -> Column:
    return (
        F.when(x.isNull(), _null(T.StringType()))
        .when(x >= high, F.lit("HIGH"))
        .when(x >= medium, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def roe_category() -> Column:
    """Return-on-equity tier."""
    return _tier(c("returnOnEquity"), ROE_HIGH, ROE_MEDIUM)


def revenue_growth_category() -> Column:
    """Revenue-growth tier."""
    return _tier(c("revenueGrowth"), GROWTH_HIGH, GROWTH_MEDIUM)


def avg_governance_risk() -> Column:
    """Mean of the four governance sub-scores; any NULL part → NULL."""
    total = None
    for name in GOVERNANCE_PARTS:
        part = c(name).cast(T.DoubleType())
        total = part if total is None else total + part
    return F.round(total / F.lit(4.0), 2)


def feature_columns() -> dict[str, Column]:
    """E1..E14 by output name, in the order they are added to the flat table."""
    return {
        "market_cap_cr": market_cap_cr(),
        "dividendYield": capped_dividend_yield(),
        "pe_category": pe_category(),
        "week52_position_score": week52_position_score(),
        "discount_from_52w_high_pct": discount_from_52w_high_pct(),
        "above_200dma": above_200dma(),
        "analyst_upside_pct": analyst_upside_pct(),
        "is_strong_buy": is_strong_buy(),
        "net_cash_cr": net_cash_cr(),
        "revenue_cr": revenue_cr(),
        "earnings_yield": earnings_yield(),
        "roe_category": roe_category(),
        "revenue_growth_category": revenue_growth_category(),
        "avg_governance_risk": avg_governance_risk(),
    }


def add_features(df: DataFrame) -> DataFrame:
    """Add (or, for ``dividendYield``, replace) all derived columns in one projection.

    No feature reads another feature's output, so a single ``withColumns`` is
    equivalent to applying them one after the other and keeps the plan flat.
    """
    return df.withColumns(feature_columns())


def transform(df: DataFrame) -> DataFrame:
    """Rename → flatten → features."""
    return df.transform(rename_problematic_columns).transform(flatten_df).transform(add_features)
