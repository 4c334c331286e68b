"""Day layout, repeated runs after a failed archive, outdated versions in later batches."""

import datetime as dt
import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerlake.plans.daily_load import Warehouse, run_daily_load
from tickerlake.sinks.landing import land_snapshots
from tickerlake.sinks.ledger import read_ledger
from tickerlake.sinks.tables import _clustered, day_sizes, read_fact
from tickerlake.streaming.incremental import start_incremental_load

DAY = dt.date(2026, 4, 22)


def _docs(spark, price, days=(DAY,), tickers=("AAA", "BBB")):
    rows = [(t, d, price) for t in tickers for d in days]
    return spark.createDataFrame(rows, "ticker_id string, ingestion_date date, currentPrice double")


def _prices(spark, wh):
    return sorted((r.ticker_id, r.ingestion_date, r.currentPrice) for r in read_fact(spark, wh.fact).collect())


def test_large_days_are_split_by_ticker(spark, tmp_uri):
    other = DAY + dt.timedelta(days=1)
    rows = [(f"T{i:05d}", DAY) for i in range(32_000)] + [("T1", other), ("T2", other)]
    df = spark.createDataFrame(rows, "ticker_id string, ingestion_date date")
    _clustered(df, {DAY: 32_000, other: 2}, 4_000).write.partitionBy("ingestion_date").parquet(f"{tmp_uri}/t")
    files = {d: glob.glob(f"{tmp_uri}/t/ingestion_date={d}/part-*") for d in (DAY, other)}
    assert 6 <= len(files[DAY]) <= 8 and len(files[other]) == 1
    spans = sorted(tuple(spark.read.parquet(f).selectExpr("min(ticker_id)", "max(ticker_id)").first()) for f in files[DAY])
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_run_is_repeated_after_failed_archive(spark, tmp_uri):
    raw, archive, wh = f"{tmp_uri}/raw", f"{tmp_uri}/archive", Warehouse(f"{tmp_uri}/wh")
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    names = [d.isoformat() for d in days]
    land_snapshots(_docs(spark, 1.0, days), raw)
    os.makedirs(archive)
    blocked = f"{archive}/date={names[1]}"
    open(blocked, "w").close()
    with pytest.raises(Exception):
        run_daily_load(spark, raw, wh, names, archive_base=archive)
    assert not os.path.exists(f"{raw}/date={names[0]}") and os.path.exists(f"{raw}/date={names[1]}")
    os.remove(blocked)
    assert run_daily_load(spark, raw, wh, names, archive_base=archive).dates == tuple(days)
    assert _prices(spark, wh) == sorted((t, d, 1.0) for t in ("AAA", "BBB") for d in days)
    assert not glob.glob(f"{raw}/date=*/*.json") and len(glob.glob(f"{archive}/date=*/*.json")) == 6
    states = [r.status for r in read_ledger(spark, wh.ledger).collect()]
    assert states.count("FAILED") == 3 and states.count("SUCCESS") == 3
    # A date landed anew after all that is loaded again.
    land_snapshots(_docs(spark, 2.0, days[:1]), raw)
    run_daily_load(spark, raw, wh, names[0], archive_base=archive)
    assert [p for _, d, p in _prices(spark, wh) if d == days[0]] == [2.0, 2.0]


def test_outdated_version_in_a_later_batch_changes_nothing(spark, tmp_uri):
    raw, wh = f"{tmp_uri}/raw", Warehouse(f"{tmp_uri}/wh")
    for price, version, tickers in ((1.0, None, ("AAA", "BBB")), (5.0, 5, ("AAA",)), (3.0, 3, ("AAA", "BBB"))):
        land_snapshots(_docs(spark, price, tickers=tickers), raw, version)
        query = start_incremental_load(spark, raw, wh, f"{tmp_uri}/ckpt", archive_dir=f"{tmp_uri}/archive")
        query.awaitTermination()
        assert query.exception() is None
    assert _prices(spark, wh) == [("AAA", DAY, 5.0), ("BBB", DAY, 3.0)]


def test_small_files_are_dealt_to_bounded_tasks(spark, tmp_uri):
    """Files of few rows: several a date, in several tasks, and not a task for each."""
    start = dt.date(2026, 1, 1)
    days = spark.range(60).select(F.expr(f"date_add(date'{start}', cast(id as int))").alias("ingestion_date"))
    tickers = spark.range(40).select(F.concat(F.lit("T"), "id").alias("ticker_id"), F.col("id").alias("n"))
    few = spark.createDataFrame([("T1", 1), (None, 2)], "ticker_id string, n long").withColumn("ingestion_date", F.lit(dt.date(2025, 1, 1)))
    rows = days.crossJoin(tickers).select("ticker_id", "ingestion_date", "n").unionByName(few.select("ticker_id", "ingestion_date", "n"))
    sizes = day_sizes(rows)
    laid = _clustered(rows, sizes, rows_per_file=10)
    parts = laid.select(F.spark_partition_id().alias("task"), "ingestion_date", "ticker_id", "n")
    assert sorted(map(tuple, parts.select("ticker_id", "ingestion_date", "n").collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert laid.rdd.getNumPartitions() <= 8 + 8 + 4  # of 240 files, and the small date's
    by_date = parts.groupBy("ingestion_date").agg(F.countDistinct("task").alias("files"), F.count("*").alias("rows")).collect()
    assert all(r.files >= 3 for r in by_date if r.rows == 40)
    for task, in_task in pd.DataFrame(parts.collect(), columns=parts.columns).groupby("task"):
        assert list(in_task.ingestion_date) == sorted(in_task.ingestion_date)


def test_large_buckets_are_written_without_shuffling_rows(spark, tmp_uri, monkeypatch):
    from tests.helpers import plan_operators
    from tickerlake.plans import views

    rows = [(f"T{i % 50}" if i % 9 else None, DAY + dt.timedelta(days=i % 7), i) for i in range(700)]
    df = spark.createDataFrame(rows, "ticker_id string, ingestion_date date, n int").repartition(5)
    dim = spark.createDataFrame([(f"T{i}", f"s{i % 4}") for i in range(50)], "ticker_id string, sector string")
    df.write.parquet(f"{tmp_uri}/rows")
    df = spark.read.parquet(f"{tmp_uri}/rows")
    seen = []
    for most in (32 << 20, 0):
        monkeypatch.setattr(views, "BUCKET_BYTES", most)
        database = f"clustered_{bool(most)}".lower()
        spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_uri}/{database}'")
        fact, dimension = (spark.table(t) for t in views.store_clustered(spark, df, dim, database, 4))
        seen.append(sorted(map(str, fact.collect())))
        assert fact.count() == 700 and dimension.count() == 50
        joined = fact.hint("merge").join(dimension.hint("merge"), "ticker_id")
        assert "Exchange" not in plan_operators(joined) and joined.count() == sum(r[0] is not None for r in rows)
        files = len(fact.inputFiles())
        assert files <= 4 if most else files > 4  # a file a bucket, or a file a task and bucket
        spark.sql(f"DROP DATABASE {database} CASCADE")
    assert seen[0] == seen[1]
