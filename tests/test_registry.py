"""Driver contract at sf0.001: entry() runs, every query has an oracle, and
the fast queries equal their DuckDB statements."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, _hash

from .conftest import SF_SMALL

FAST = [
    "E1_market_cap_cr", "E4_week52_position_score", "E9_net_cash_cr", "E14_avg_governance_risk",
    "P1_rename", "P2_flatten", "P9_transform", "R5_dedup", "R5_dedup_total_order",
    "A1_latest_date", "J2_latest_rows", "A2_dimension_distinct", "A4_dimension_latest",
    "S6_ticker_universe", "R2_ledger_status", "R4_dates_to_process",
    "K4_dimension_refresh_twice", "K4_dimension_incremental_reload", "R5_dedup_latest_load", "P7_cast_date",
    "V1_moving_average_5_gaps", "V2_volatility_5_gaps",
    "Q1_fundamental_view", "Q4_undervalued_stocks_view", "W2_top3_per_sector", "K3_upsert",
    "B1_backtest_30_days", "B1_backtest_90_days_gaps", "B2_backtest_summary", "V4_rolling_beta_5_gaps", "V5_ticker_beta",
    "J2_maintained_latest_rows", "Q4_maintained_latest", "K5_catalog_views_after_next_load",
    "V1_V2_maintained_trends_5",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def test_every_query_has_an_oracle():
    """Those of the training-data operators apart, which have tests of their own."""
    own = {q for q in E.queries() if q == "pipeline" or q.startswith("op")}
    assert set(E.queries()) - own == set(E.oracle_sql()) - own


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "rank" in df.columns and all(r["rank"] == 1 for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(srows) == len(orows)
    assert _hash(srows, df.columns) == _hash(orows, res.columns)
