"""Backtesting: what each date's screener picked, and what became of it.

A pick is paired with its ticker's price as of a later day: the last snapshot
within the horizon. Prices are cut into spans as long as the horizon, so a pick
meets two spans of its own ticker by an equi-join, never a grid of dates and tickers,
and a ticker's whole history is in no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake.operators.ranking import top_n_per_group

KEY, DATE, PRICE = "ticker_id", "ingestion_date", "currentPrice"


def daily_screener(fact: DataFrame, dim: DataFrame, top_n: int = 1) -> DataFrame:
    """The screener on every date: per sector, of that date's snapshots, the lowest trailing PE
    (then highest revenue growth, then ticker). Only what was known on the date is read."""
    sectors = dim.select(F.col(KEY).alias("_ticker"), "sector")
    known = fact.select(KEY, DATE, PRICE, "trailingPE", "revenueGrowth").where(F.col("trailingPE").isNotNull())
    rows = known.join(sectors, F.col(KEY) == F.col("_ticker")).drop("_ticker")
    order = [F.col("trailingPE").asc_nulls_first(), F.col("revenueGrowth").desc_nulls_last(), F.col(KEY).asc_nulls_first()]
    return top_n_per_group(rows, [DATE, "sector"], order, n=top_n)


def _day(date: Column) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date"))


def prices_as_of(picks: DataFrame, fact: DataFrame, horizon_days: int) -> DataFrame:
    """``picks`` with exit_date and exit_price: the ticker's last snapshot with a price after the
    pick's date, at most ``horizon_days`` later; NULL where there is none.

    ``picks`` has distinct rows with ticker_id and ingestion_date.
    """
    if horizon_days < 1:
        raise ValueError("the horizon must be a day at least")
    spans = [F.floor((_day(F.col(DATE)) + d) / horizon_days) for d in (1, horizon_days)]
    asked = picks.withColumn("_span", F.explode(F.array_distinct(F.array(*spans))))
    later = fact.where(F.col(PRICE).isNotNull()).select(
        F.col(KEY).alias("_key"), F.col(DATE).alias("_date"), F.col(PRICE).alias("_price"),
        F.floor(_day(F.col(DATE)) / horizon_days).alias("_of"),
    )
    within = (F.col("_date") > F.col(DATE)) & (F.col("_date") <= F.date_add(F.col(DATE), horizon_days))
    met = asked.join(later, (F.col(KEY) == F.col("_key")) & (F.col("_span") == F.col("_of")) & within, "left")
    last = F.max(F.when(F.col("_date").isNotNull(), F.struct("_date", "_price")))
    found = met.groupBy(*[F.col(f"`{c}`") for c in picks.columns]).agg(last.alias("_last"))
    return found.select(*picks.columns, F.col("_last._date").alias("exit_date"), F.col("_last._price").alias("exit_price"))


def backtest(fact: DataFrame, dim: DataFrame, horizon_days: int = 30, top_n: int = 1) -> DataFrame:
    """Every date's picks with their price then, the price as of the horizon's end and the return
    between (rounded to 6 decimals; NULL without a later price or after a price of 0)."""
    picks = daily_screener(fact, dim, top_n).select(DATE, "sector", "rank", KEY, F.col(PRICE).alias("entry_price"))
    held = prices_as_of(picks, fact, horizon_days)
    change = F.try_divide(F.col("exit_price"), F.col("entry_price")) - 1
    return held.withColumn("forward_return", F.round(change, 6))


def backtest_summary(rows: DataFrame) -> DataFrame:
    """Per sector: picks, those with a return, how many of these gained, and their mean return."""
    return rows.groupBy("sector").agg(
        F.count(F.lit(1)).alias("picks"), F.count("forward_return").alias("settled"),
        F.count(F.when(F.col("forward_return") > 0, 1)).alias("gained"), F.round(F.avg("forward_return"), 6).alias("mean_return"),
    )
