"""Each ticker's latest snapshot date, and the rows at that date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.session import scratch_path

#: Most tickers whose latest dates are sent to every task, as hashes of 8 bytes.
SENT_TICKERS = 2_000_000


def latest_dates(fact: DataFrame, key: str = "ticker_id", date: str = "ingestion_date") -> DataFrame:
    """A1: ``max(date)`` per ticker → (``ticker_id``, ``latest_date``).

    A hash aggregate with map-side partial max: a ticker with a huge history
    still sends one row per map task.
    """
    return fact.groupBy(key).agg(F.max(date).alias("latest_date"))


def latest_rows(
    fact: DataFrame, key: str = "ticker_id", date: str = "ingestion_date", unique: bool = False
) -> DataFrame:
    """Every fact row that sits at its ticker's latest date; NULL tickers never match.

    In general a left-semi join against A1: all rows at the latest date are
    kept and none is multiplied, at the price of two scans. A1 is computed when this is called;
    where it has up to ``SENT_TICKERS`` rows, hashes of them are sent to the tasks, and only
    facts that match one are shuffled. Where (ticker,
    date) is unique — the fact table's key — the latest row is a
    ``max(struct(date, columns…))``: one scan, reduced per ticker in the map
    tasks. Select the columns needed first, as they travel in the struct.
    """
    if unique:
        others = [c for c in fact.columns if c not in (key, date)]
        packed = F.struct(F.col(date).alias("_date"), *[F.col(f"`{c}`") for c in others])
        last = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(packed).alias("_last"))
        values = {date: F.col("_last._date"), **{c: F.col(f"_last.`{c}`") for c in others}, key: F.col(key)}
        return last.select(*[values[c].alias(c) for c in fact.columns])
    latest = _stored_dates(fact.where(F.col(key).isNotNull()), key, date)
    return _at(fact, latest, key, date).join(latest, [key, date], "left_semi")


def latest_candidates(fact: DataFrame, key: str = "ticker_id", date: str = "ingestion_date") -> DataFrame:
    """All rows at their ticker's latest date (NULL is a ticker too) and few others, found without a shuffle of rows.

    A1 is computed when this is called; with more than ``SENT_TICKERS`` rows, all of ``fact`` is returned.
    What is last by ``(date, columns…)`` among these is so among all rows.
    """
    return _at(fact, _stored_dates(fact, key, date), key, date)


def _stored_dates(fact: DataFrame, key: str, date: str) -> DataFrame:
    """A1 under the names of ``fact``, in the scratch folder."""
    path = scratch_path(fact.sparkSession, "latest-dates")
    found = latest_dates(fact, key, date).select(F.col(key), F.col("latest_date").alias(date))
    found.write.parquet(path)
    return fact.sparkSession.read.schema(found.schema).parquet(path)


def _at(fact: DataFrame, latest: DataFrame, key: str, date: str) -> DataFrame:
    """Rows whose key and date hash as one of ``latest``; all rows, if these are too many to send."""
    if latest.count() > SENT_TICKERS:
        return fact
    hashes = latest.select(F.xxhash64(key, date).alias("_hash"))
    return fact.join(F.broadcast(hashes), F.xxhash64(key, date) == F.col("_hash"), "left_semi")
