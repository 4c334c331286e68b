"""V1–V3: trend analytics over each ticker's snapshot history.

A plain ``Window.partitionBy(ticker).orderBy(date)`` would hold a ticker's
entire history in one task. Here every window is bounded:

1. Position of each snapshot in its ticker's history, from per-(ticker,
   month) counts (a partial aggregate), a running sum over the months of a
   ticker (one row per month), and a row number inside each (ticker, month)
   (at most one row per day: the fact key is (ticker, date)).
2. Positions are cut into fixed blocks of ``block`` rows; the last ``n - 1``
   rows of each block are copied into the next block as a halo, so every row
   sees its ``n - 1`` predecessors inside its own (ticker, block) partition.
3. The frame functions run per (ticker, block) over at most
   ``block + n - 1`` rows; halo rows are dropped afterwards.

The result equals the unbounded window row for row, whatever the history
length, and no task ever holds more than one block of one ticker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY, DATE = "ticker_id", "ingestion_date"


def snapshot_positions(fact: DataFrame, value: str = "currentPrice") -> DataFrame:
    """(ticker, date, value, pos): 1-based position in the ticker's history."""
    rows = fact.where(F.col(KEY).isNotNull()).select(KEY, DATE, value).withColumn("_month", F.trunc(DATE, "month"))
    per_month = rows.groupBy(KEY, "_month").agg(F.count(F.lit(1)).alias("_n"))
    by_month = Window.partitionBy(KEY).orderBy("_month").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_month.withColumn("_offset", F.coalesce(F.sum("_n").over(by_month), F.lit(0)))
    in_month = Window.partitionBy(KEY, "_month").orderBy(DATE)
    ranked = rows.withColumn("_rn", F.row_number().over(in_month))
    return ranked.join(offsets.select(KEY, "_month", "_offset"), [KEY, "_month"]).select(
        KEY, DATE, value, (F.col("_offset") + F.col("_rn")).alias("pos")
    )


def with_halo(pos: DataFrame, n: int, block: int) -> DataFrame:
    """Each row in its own block, and once more in the next where it is one of
    the last ``n - 1`` of its block. Positions are computed once."""
    if block < n:
        raise ValueError("block must hold at least n rows")
    blk = F.floor((F.col("pos") - 1) / block)
    own = F.struct(blk.alias("_blk"), F.lit(True).alias("_own"))
    halo = F.struct((blk + 1).alias("_blk"), F.lit(False).alias("_own"))
    tail = (F.col("pos") - 1) % block >= block - (n - 1)
    return pos.withColumn("_b", F.explode(F.when(tail, F.array(own, halo)).otherwise(F.array(own)))).select(
        *pos.columns, "_b.*"
    )


def _keyless(fact: DataFrame, value: str) -> DataFrame:
    """Facts without a ticker: each is a history of its own."""
    return fact.where(F.col(KEY).isNull()).select(KEY, DATE, value)


def moving_average(
    fact: DataFrame, n: int, value: str = "currentPrice", block: int = 512
) -> DataFrame:
    """V1: mean of ``value`` over the last ``n`` snapshots (the current one
    included; fewer at the start of a history), rounded to 6 decimals."""
    framed = with_halo(snapshot_positions(fact, value), n, block)
    w = Window.partitionBy(KEY, "_blk").orderBy("pos").rowsBetween(-(n - 1), 0)
    out = framed.withColumn(f"ma_{n}", F.round(F.avg(value).over(w), 6))
    alone = _keyless(fact, value).withColumn(f"ma_{n}", F.round(F.col(value).cast("double"), 6))
    return out.where("_own").select(KEY, DATE, value, f"ma_{n}").unionByName(alone)


def volatility(
    fact: DataFrame, n: int, value: str = "currentPrice", block: int = 512
) -> DataFrame:
    """V2: sample standard deviation of snapshot-to-snapshot returns
    (``value / previous value - 1``) over the last ``n`` returns, rounded to
    6 decimals. After a value of 0 there is no return. Needs ``n``
    predecessors, so the halo is ``n`` rows."""
    framed = with_halo(snapshot_positions(fact, value), n + 1, block)
    by_pos = Window.partitionBy(KEY, "_blk").orderBy("pos")
    ret = F.try_divide(F.col(value), F.lag(value).over(by_pos)) - 1
    with_ret = framed.withColumn("daily_return", ret)
    w = by_pos.rowsBetween(-(n - 1), 0)
    out = with_ret.withColumn(f"volatility_{n}", F.round(F.stddev_samp("daily_return").over(w), 6))
    none = F.lit(None).cast("double")
    alone = _keyless(fact, value).withColumns({"daily_return": none, f"volatility_{n}": none})
    return out.where("_own").select(
        KEY, DATE, value, F.round("daily_return", 6).alias("daily_return"), f"volatility_{n}"
    ).unionByName(alone)


def trends(fact: DataFrame, n: int, value: str = "currentPrice", block: int = 512) -> DataFrame:
    """V1 and V2 of the same ``n`` from one set of frames: each snapshot's moving average,
    return and volatility, as the two give them apart."""
    framed = with_halo(snapshot_positions(fact, value), n + 1, block)
    by_pos = Window.partitionBy(KEY, "_blk").orderBy("pos")
    w = by_pos.rowsBetween(-(n - 1), 0)
    out = framed.withColumn("_return", F.try_divide(F.col(value), F.lag(value).over(by_pos)) - 1).withColumns({
        f"ma_{n}": F.round(F.avg(value).over(w), 6),
        f"volatility_{n}": F.round(F.stddev_samp("_return").over(w), 6),
        "daily_return": F.round("_return", 6),
    })
    none = F.lit(None).cast("double")
    mean = F.round(F.col(value).cast("double"), 6)
    alone = _keyless(fact, value).withColumns({f"ma_{n}": mean, "daily_return": none, f"volatility_{n}": none})
    columns = [KEY, DATE, value, f"ma_{n}", "daily_return", f"volatility_{n}"]
    return out.where("_own").select(*columns).unionByName(alone)


def relative_52w_change(fact: DataFrame) -> DataFrame:
    """V3: ``week52_change - sandp_52week_change`` per (ticker, date): the
    stock's 52-week change relative to the index. Row-local, no shuffle."""
    return fact.select(
        KEY,
        DATE,
        (F.col("week52_change") - F.col("sandp_52week_change")).alias("relative_52w_change"),
    )
