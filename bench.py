"""Benchmark the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf", ...}. Each query is fully materialised
(``noop`` sink or a table write); the median is reported, of ``$BENCH_REPEAT``
runs, or fewer where tables are written (``repeat`` names them).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tickerlake.operators.dedup import dedup_by_key  # noqa: E402
from tickerlake.operators.dimension import dimension_latest  # noqa: E402
from tickerlake.operators.timeseries import moving_average, volatility  # noqa: E402
from tickerlake.plans.daily_load import Warehouse, run_daily_load  # noqa: E402
from tickerlake.plans.market import LINEAGE_ORDER  # noqa: E402
from tickerlake.plans.registry import deduped, flat_rows, flat_with_lineage  # noqa: E402
from tickerlake.plans.views import (  # noqa: E402
    analyst_view,
    fundamental_view,
    technical_view,
    undervalued_stocks_view,
)
from tickerlake.session import build_session, scratch_path  # noqa: E402
from tickerlake.sinks.landing import land_snapshots  # noqa: E402
from tickerlake.sinks.tables import (  # noqa: E402
    dates_of,
    read_dimension,
    read_fact,
    read_flat,
    refresh_dimension,
    upsert_fact,
    write_flat,
)
from tickerlake.plans.market import raw_snapshots  # noqa: E402


def timed(fn, repeat: int) -> float:
    runs = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def split_tables(spark, sf_dir: str) -> str:
    """Test setup, not measured: the base tables in as many files as a real input
    would have. The driver's are single row groups, which one task reads."""
    copy = scratch_path(spark, "bench-tables")
    for name in ("lineitem", "part"):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        table.repartition(32).write.parquet(f"{copy}/{name}.parquet")
    return copy


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    few = min(2, repeat)  # for what writes whole tables
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(
        master=f"local[{cpus}]", app_name="tickerlake-bench", shuffle_partitions=2 * cpus, extra=extra
    )
    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    q: dict[str, float] = {}
    sf_dir = split_tables(spark, sf_dir)

    # Warm-up: JVM, codegen caches and file metadata, not measured.
    noop(flat_rows(spark, sf_dir))

    # --- transform + de-dup (in memory, fully materialised) ----------------
    q["p9_transform"] = timed(lambda: noop(flat_rows(spark, sf_dir)), repeat)
    q["r5_dedup"] = timed(lambda: noop(deduped(spark, sf_dir)), repeat)
    q["a4_dimension_latest"] = timed(lambda: noop(dimension_latest(flat_rows(spark, sf_dir))), repeat)

    # --- warehouse build through the sinks ---------------------------------
    holder: dict[str, Warehouse] = {}
    days = dates_of(raw_snapshots(spark, sf_dir))

    def build() -> None:
        wh = Warehouse(scratch_path(spark, "bench-warehouse"))
        write_flat(flat_rows(spark, sf_dir), wh.flat, "append")
        upsert_fact(spark, deduped(spark, sf_dir).drop(*LINEAGE_ORDER), wh.fact, dates=days)
        refresh_dimension(read_flat(spark, wh.flat), wh.dimension, "latest")
        holder["wh"] = wh

    q["k1_k3_k4_build_warehouse"] = timed(build, few)
    wh = holder["wh"]
    fact, dim = read_fact(spark, wh.fact), read_dimension(spark, wh.dimension)

    # --- the four views over the tables -------------------------------------
    q["q1_fundamental_view"] = timed(lambda: noop(fundamental_view(fact, dim)), repeat)
    q["q2_technical_view"] = timed(lambda: noop(technical_view(fact)), repeat)
    q["q3_analyst_view"] = timed(lambda: noop(analyst_view(fact, dim)), repeat)
    q["q4_undervalued_stocks_view"] = timed(lambda: noop(undervalued_stocks_view(fact, dim)), repeat)

    # --- trend analytics over the whole fact (bounded windows) --------------
    q["v1_moving_average_20"] = timed(lambda: noop(moving_average(fact, 20)), repeat)
    q["v2_volatility_20"] = timed(lambda: noop(volatility(fact, 20)), repeat)

    # --- restatement: upsert revision-1 rows of every date into the fact ----
    restated = dedup_by_key(flat_with_lineage(spark, sf_dir, 1), order=LINEAGE_ORDER).drop(*LINEAGE_ORDER)
    q["k3_upsert_all_dates"] = timed(lambda: upsert_fact(spark, restated, wh.fact, dates=days), few)

    # --- the daily run: one landed day, JSON → flat → fact → dimension ------
    docs = dedup_by_key(raw_snapshots(spark, sf_dir, lineage=True), order=LINEAGE_ORDER).drop(*LINEAGE_ORDER)
    last_day = docs.agg(F.max("ingestion_date")).first()[0]
    raw_base = scratch_path(spark, "bench-landing")
    land_snapshots(docs.where(F.col("ingestion_date") == last_day), raw_base)
    # A new day (the normal daily run): the last day's documents landed under
    # the following date, so the fact upsert takes its insert-only branch.
    next_day = last_day + dt.timedelta(days=1)
    land_snapshots(
        docs.where(F.col("ingestion_date") == last_day).withColumn("ingestion_date", F.lit(next_day)),
        raw_base,
    )
    q["q5_daily_load_new_day"] = timed(
        lambda: run_daily_load(spark, raw_base, wh, next_day.isoformat()), 1
    )  # the day is new once only
    # A re-run of a day already in the fact (merge branch).
    q["q5_daily_load_one_day_incremental_dimension"] = timed(
        lambda: run_daily_load(spark, raw_base, wh, last_day.isoformat()), few
    )
    q["q5_daily_load_one_day"] = timed(
        lambda: run_daily_load(spark, raw_base, wh, last_day.isoformat(), dimension_refresh="full"), few
    )

    once = {"q5_daily_load_new_day"}
    whole = {n for n in q if n.startswith(("k1", "k3", "q5"))} - once
    repeats = {n: 1 if n in once else few if n in whole else repeat for n in q}
    total = round(sum(q.values()), 3)
    print(
        json.dumps(
            {
                "metric": "sum_of_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": q,
                "sf": float(sf_match.group(1)) if sf_match else sf_dir,
                "cpus": cpus,
                "repeat": repeats,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
