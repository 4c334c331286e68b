"""A2, A4: company dimension built from the flat snapshot history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.schema import DIMENSION_COLUMNS


def dimension_distinct(
    flat: DataFrame,
    columns: Sequence[str] = tuple(DIMENSION_COLUMNS),
    date: str = "ingestion_date",
    keep_date: bool = False,
) -> DataFrame:
    """A2: ``SELECT DISTINCT`` over the descriptive columns, as the warehouse does.

    A ticker whose attributes changed over time gets one row per variant.
    Distinct is a hash aggregate with map-side de-duplication. With
    ``keep_date`` each variant also carries the last date it was seen
    (``as_of_date``), which lets the dimension be updated incrementally.
    """
    cols = [F.col(f"`{c}`") for c in columns]
    if not keep_date:
        return flat.select(*cols).distinct()
    return flat.groupBy(*cols).agg(F.max(date).alias("as_of_date"))


def dimension_latest(
    flat: DataFrame,
    columns: Sequence[str] = tuple(DIMENSION_COLUMNS),
    key: str = "ticker_id",
    date: str = "ingestion_date",
    keep_date: bool = False,
) -> DataFrame:
    """A4: one row per ticker, the attributes of its latest snapshot.

    Ties at the latest date go to the greatest attribute tuple (NULL lowest),
    so the choice does not depend on row order. ``max(struct(date, attrs…))``
    is an aggregate: map tasks reduce their rows per ticker before the
    shuffle, however many snapshots one ticker has.
    """
    attrs = [c for c in columns if c != key]
    packed = F.struct(F.col(date).alias("_d"), *[F.col(f"`{c}`") for c in attrs])
    extra = [F.col("_w._d").alias("as_of_date")] if keep_date else []
    return (
        flat.groupBy(key)
        .agg(F.max(packed).alias("_w"))
        .select(F.col(key), *[F.col(f"_w.`{c}`").alias(c) for c in attrs], *extra)
    )


def build_dimension(flat: DataFrame, mode: str = "latest", keep_date: bool = False) -> DataFrame:
    """``mode`` is ``latest`` (one row per ticker) or ``distinct`` (as coded upstream)."""
    if mode == "latest":
        return dimension_latest(flat, keep_date=keep_date)
    if mode == "distinct":
        return dimension_distinct(flat, keep_date=keep_date)
    raise ValueError(f"unknown dimension mode {mode!r}")
