"""The ticker universe (tickers expected to land each day)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ticker_universe(master: DataFrame, column: str = "ticker") -> DataFrame:
    """Distinct non-NULL tickers of a ticker master table.

    Stays a DataFrame (a hash aggregate with map-side de-duplication): the
    universe feeds joins (R1 coverage), it is never collected to the driver.
    """
    return master.select(F.col(column)).where(F.col(column).isNotNull()).distinct()
