"""V1–V3: the blocked, halo-based frames equal a plain whole-history window."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerlake.operators.timeseries import (
    moving_average,
    relative_52w_change,
    snapshot_positions,
    volatility,
)


@pytest.fixture(scope="module")
def history(spark):
    rnd = random.Random(7)
    rows = []
    for ticker, days in (("HOT", 400), ("B", 5), ("C", 1), ("D", 37)):
        start = dt.date(2020, 1, 1)
        picked = sorted(rnd.sample(range(900), days))  # gaps between snapshots
        for d in picked:
            rows.append((ticker, start + dt.timedelta(days=d), round(rnd.uniform(10, 500), 2)))
    return spark.createDataFrame(rows, "ticker_id string, ingestion_date date, currentPrice double")


def _plain_ma(df, n):
    w = Window.partitionBy("ticker_id").orderBy("ingestion_date").rowsBetween(-(n - 1), 0)
    return df.select("ticker_id", "ingestion_date", F.round(F.avg("currentPrice").over(w), 6).alias("m"))


def _plain_vol(df, n):
    w = Window.partitionBy("ticker_id").orderBy("ingestion_date")
    r = df.withColumn("r", F.col("currentPrice") / F.lag("currentPrice").over(w) - 1)
    return r.select("ticker_id", "ingestion_date",
                    F.round(F.stddev_samp("r").over(w.rowsBetween(-(n - 1), 0)), 6).alias("m"))


def _as_dict(df, col):
    return {(r.ticker_id, r.ingestion_date): r[col] for r in df.collect()}


def test_positions_are_dense(history):
    pos = snapshot_positions(history)
    by = {}
    for r in pos.collect():
        by.setdefault(r.ticker_id, []).append((r.ingestion_date, r.pos))
    for rows in by.values():
        rows.sort()
        assert [p for _, p in rows] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("n,block", [(5, 5), (5, 8), (20, 32), (1, 4), (3, 512)])
def test_moving_average_matches_plain_window(history, n, block):
    got = _as_dict(moving_average(history, n, block=block), f"ma_{n}")
    assert got == _as_dict(_plain_ma(history, n), "m")


@pytest.mark.parametrize("n,block", [(5, 6), (5, 16), (10, 11)])
def test_volatility_matches_plain_window(history, n, block):
    got = _as_dict(volatility(history, n, block=block), f"volatility_{n}")
    assert got == _as_dict(_plain_vol(history, n), "m")


def test_block_must_cover_frame(history):
    with pytest.raises(ValueError):
        moving_average(history, 10, block=4)


def test_relative_change(spark):
    df = spark.createDataFrame([("A", dt.date(2026, 1, 1), 0.3, 0.1)],
                               "ticker_id string, ingestion_date date, week52_change double, sandp_52week_change double")
    assert relative_52w_change(df).first().relative_52w_change == pytest.approx(0.2)


def test_rows_without_ticker_and_prices_of_zero(spark):
    day = lambda i: dt.date(2026, 1, i)
    rows = [("A", day(1), 2.0), ("A", day(2), 0.0), ("A", day(3), 4.0), (None, day(1), 7.0), (None, day(1), 8.0)]
    df = spark.createDataFrame(rows, "ticker_id string, ingestion_date date, currentPrice double")
    ma = sorted((r.ticker_id or "", r.currentPrice, r.ma_2) for r in moving_average(df, 2).collect())
    assert ma == [("", 7.0, 7.0), ("", 8.0, 8.0), ("A", 0.0, 1.0), ("A", 2.0, 2.0), ("A", 4.0, 2.0)]
    vol = {(r.ticker_id, r.currentPrice): r.daily_return for r in volatility(df, 2).collect()}
    assert vol == {("A", 2.0): None, ("A", 0.0): -1.0, ("A", 4.0): None, (None, 7.0): None, (None, 8.0): None}
