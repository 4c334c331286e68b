"""Boundary units for E1–E14, P1, P2, P9 (at, below and above each threshold,
with NULL, NaN, ±inf, zero and negatives)."""

import math

import pytest
from pyspark.sql import types as T

from tickerlake.functions import features as feat
from tickerlake.schema import FLAT_COLUMNS, RAW_SCHEMA

from .helpers import plan_operators

INF = float("inf")
NAN = float("nan")


def _one(spark, col, fields, rows):
    schema = T.StructType([T.StructField(n, t, True) for n, t in fields])
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


D, L, I = T.DoubleType(), T.LongType(), T.IntegerType()


def test_market_cap_cr(spark):
    out = _one(spark, feat.market_cap_cr(), [("marketCap", L)], [(None,), (0,), (123456789,), (-5_000_000,), (15_000_000,)])
    assert out == [None, 0.0, 12.35, -0.5, 1.5]


def test_dividend_yield_cap(spark):
    out = _one(spark, feat.capped_dividend_yield(), [("dividendYield", D)],
               [(None,), (100.0,), (100.0001,), (99.9,), (NAN,), (INF,), (-INF,)])
    assert out[0] is None and out[1] == 100.0 and out[2] is None and out[3] == 99.9
    assert out[4] is None  # NaN sorts above every number → capped
    assert out[5] is None and out[6] == -INF


@pytest.mark.parametrize(
    "pe,expected",
    [(None, None), (-3.0, "LOW"), (0.0, "LOW"), (14.999, "LOW"), (15.0, "MEDIUM"),
     (24.99, "MEDIUM"), (25.0, "HIGH"), (INF, "HIGH"), (NAN, "HIGH")],
)
def test_pe_category(spark, pe, expected):
    assert _one(spark, feat.pe_category(), [("trailingPE", D)], [(pe,)]) == [expected]


def test_week52_position_score(spark):
    fields = [("fiftyTwoWeekLow", D), ("fiftyTwoWeekHigh", D), ("currentPrice", D)]
    rows = [(10.0, 20.0, 15.0), (10.0, 10.0, 10.0), (20.0, 10.0, 15.0), (None, 20.0, 15.0),
            (10.0, 20.0, 25.0), (10.0, 20.0, None), (10.0, 20.0, 11.005)]
    out = _one(spark, feat.week52_position_score(), fields, rows)
    assert out[:6] == [50.0, None, None, None, 150.0, None]  # not clamped above 100
    assert out[6] == 10.05


def test_discount_and_upside(spark):
    fields = [("fiftyTwoWeekHigh", D), ("currentPrice", D), ("targetMeanPrice", D)]
    rows = [(200.0, 150.0, 180.0), (0.0, 150.0, None), (-1.0, 0.0, 10.0), (None, -5.0, 10.0)]
    disc = _one(spark, feat.discount_from_52w_high_pct(), fields, rows)
    up = _one(spark, feat.analyst_upside_pct(), fields, rows)
    assert disc == [25.0, None, None, None]
    assert up == [20.0, None, None, None]


def test_above_200dma(spark):
    fields = [("currentPrice", D), ("twoHundredDayAverage", D)]
    rows = [(10.0, 9.0), (9.0, 9.0), (8.0, 9.0), (None, 9.0), (9.0, None), (NAN, 9.0)]
    assert _one(spark, feat.above_200dma(), fields, rows) == [True, False, False, None, None, True]


def test_strong_buy(spark):
    rows = [(None,), (1.0,), (1.5,), (1.5000001,), (4.0,)]
    assert _one(spark, feat.is_strong_buy(), [("recommendationMean", D)], rows) == [None, True, True, False, False]


def test_net_cash_and_revenue(spark):
    fields = [("totalCash", L), ("totalDebt", L), ("totalRevenue", L)]
    rows = [(50_000_000, 20_000_000, 125_000_000), (None, 1, None), (1, None, 0),
            (-(2**63), 1, 10)]  # long overflow in cash - debt → NULL, not an error
    assert _one(spark, feat.net_cash_cr(), fields, rows) == [3.0, None, None, None]
    assert _one(spark, feat.revenue_cr(), fields, rows) == [12.5, None, 0.0, 0.0]


def test_earnings_yield(spark):
    rows = [(None,), (0.0,), (8.0,), (-4.0,), (3.0,), (INF,)]
    assert _one(spark, feat.earnings_yield(), [("trailingPE", D)], rows) == [None, None, 0.125, -0.25, 0.3333, 0.0]


@pytest.mark.parametrize(
    "x,roe,growth",
    [(None, None, None), (0.25, "HIGH", "HIGH"), (0.2499, "MEDIUM", "HIGH"), (0.20, "MEDIUM", "HIGH"),
     (0.15, "MEDIUM", "MEDIUM"), (0.1499, "LOW", "MEDIUM"), (0.10, "LOW", "MEDIUM"),
     (0.0999, "LOW", "LOW"), (-1.0, "LOW", "LOW")],
)
def test_tiers(spark, x, roe, growth):
    fields = [("returnOnEquity", D), ("revenueGrowth", D)]
    assert _one(spark, feat.roe_category(), fields, [(x, x)]) == [roe]
    assert _one(spark, feat.revenue_growth_category(), fields, [(x, x)]) == [growth]


def test_avg_governance_risk(spark):
    fields = [(n, I) for n in feat.GOVERNANCE_PARTS]
    rows = [(1, 2, 3, 4), (1, 2, 3, None), (10, 10, 10, 9), (1, 1, 1, 2)]
    assert _one(spark, feat.avg_governance_risk(), fields, rows) == [2.5, None, 9.75, 1.25]


def test_round_half_up_on_decimal_text(spark):
    # 1.005 is stored as 1.00499999…; Spark rounds its decimal text half up.
    out = _one(spark, feat.market_cap_cr(), [("marketCap", L)], [(10_050_000,)])
    assert out == [1.01]


def test_rename_flatten_transform(spark):
    df = spark.createDataFrame([], RAW_SCHEMA)
    flat = feat.transform(df)
    assert [(f.name, f.dataType.simpleString()) for f in flat.schema.fields] == [
        (n, {"string": "string", "double": "double", "long": "bigint", "integer": "int",
             "date": "date", "boolean": "boolean"}[k]) for n, k in FLAT_COLUMNS
    ]
    assert len(flat.columns) == 107
    assert feat.rename_problematic_columns(df.drop("52WeekChange")).columns.count("sandp_52week_change") == 1


def test_flatten_structs_and_collisions(spark):
    df = spark.createDataFrame([((1, "x"), 5)], "p struct<a:int,b:string>, q int")
    assert feat.flatten_df(df).columns == ["p_a", "p_b", "q"]
    clash = spark.createDataFrame([((1,), 5)], "p struct<a:int>, p_a int")
    with pytest.raises(ValueError):
        feat.flatten_df(clash)


def test_features_are_one_projection(spark):
    df = spark.createDataFrame([], RAW_SCHEMA)
    ops = plan_operators(feat.transform(df))
    assert not {"Exchange", "HashAggregate", "SortAggregate", "Window"} & ops
    assert not {"BatchEvalPython", "ArrowEvalPython"} & ops


def test_special_values(spark):
    fields = [("fiftyTwoWeekLow", D), ("fiftyTwoWeekHigh", D), ("currentPrice", D),
              ("targetMeanPrice", D), ("trailingPE", D)]
    rows = [
        (10.0, NAN, 15.0, 20.0, -0.0),   # NaN range compares greater than 0 → NaN score
        (10.0, INF, 15.0, INF, -INF),    # inf high → NaN discount; inf target → inf upside
        (-INF, 20.0, 15.0, 10.0, NAN),   # -inf low → span inf → NaN score
    ]
    score = _one(spark, feat.week52_position_score(), fields, rows)
    disc = _one(spark, feat.discount_from_52w_high_pct(), fields, rows)
    up = _one(spark, feat.analyst_upside_pct(), fields, rows)
    ey = _one(spark, feat.earnings_yield(), fields, rows)
    pe = _one(spark, feat.pe_category(), fields, rows)
    assert math.isnan(score[0]) and math.isnan(score[2]) and score[1] == 0.0
    assert math.isnan(disc[1]) and disc[2] == 25.0
    assert up[1] == INF and up[2] == -33.33
    assert ey[0] is None and ey[1] == -0.0 and math.isnan(ey[2])
    assert pe == ["LOW", "LOW", "HIGH"]
