"""The flat table, the fact table and the dimension on parquet.

The flat and fact tables are folders of parquet partitioned by
``ingestion_date``; the dimension is partitioned by a hash bucket of the
ticker (so it can be updated bucket by bucket) and carries the date each
row was seen at. Readers always pass the declared schema, so an empty table
reads as an empty frame and no footer has to be opened to learn the columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.operators.dimension import build_dimension
from tickerlake.operators.latest import latest_candidates
from tickerlake.operators.upsert import merge_plan
from tickerlake.schema import (
    DIMENSION_COLUMNS,
    DOC_VERSION,
    FACT_SCHEMA,
    FILE_PATH,
    FILE_ROW,
    FLAT_SCHEMA,
    FLAT_STORED_SCHEMA,
    KEY_COLUMNS,
    LOAD_ID,
    LOAD_TIME,
    UPDATE_COLUMNS_FULL,
)

PARTITION_COLUMN = "ingestion_date"
CLUSTER_COLUMN = "ticker_id"


def _require_date(df: DataFrame) -> DataFrame:
    """Fail the job on a NULL partition date instead of writing it to the
    default partition. The check is a filter inside the write's own plan
    (no extra pass); being a filter, it leaves the column — and so any hash
    partitioning on it — untouched."""
    d = F.col(PARTITION_COLUMN)
    if not isinstance(df.schema[PARTITION_COLUMN].dataType, T.DateType):
        df = df.withColumn(PARTITION_COLUMN, d.cast(T.DateType()))
    return df.where(
        F.when(d.isNull(), F.raise_error(F.lit("NULL ingestion_date cannot be written"))).otherwise(
            F.lit(True)
        )
    )


#: Codec of the flat and fact tables' files: about a sixth smaller than with Spark's default.
COMPRESSION = "zstd"
#: Makes the rows of a table of narrower ones.
Widen = Callable[[DataFrame], DataFrame]
#: Rows of a date that one file holds, about; a date with more is split by ticker.
ROWS_PER_FILE = 1_000_000
#: Rows of large dates that a task writes, about, where files are smaller than that.
ROWS_PER_TASK = 20_000


#: False lets a join take sides that are hashed alike by some of its keys as they are, not shuffled anew by all.
JOIN_BY_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: True removes the files of a write's shuffles when it ends, not when the driver happens to collect its garbage.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what is run meanwhile."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def write_files(writer: DataFrameWriter, spark: SparkSession, path: str) -> None:
    """Write parquet; the files of its shuffles are gone afterwards."""
    with _setting(spark, REMOVE_SHUFFLES, "true"):
        writer.parquet(path)


def day_sizes(df: DataFrame) -> dict[dt.date, int]:
    """Rows a date: one value a day, bounded by the calendar."""
    return {r[0]: r[1] for r in df.groupBy(PARTITION_COLUMN).count().collect()}


def _clustered(
    df: DataFrame, sizes: Mapping[dt.date, int] | None = None, rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Lay rows out for a date-partitioned write.

    A date of up to ``rows_per_file`` rows meets in one task and makes one file, instead of one
    per (task, date) pair. The number of tasks is the session's shuffle
    partitions, stated so that AQE keeps it: with many small dates the cost is
    the files, not the bytes, and coalescing by bytes would leave one task
    to write them all. Larger dates, by ``sizes`` (rows a date, an estimate
    will do), are dealt by ranges of (date, ticker), a range for so many rows, so one day
    is many tasks' work. Where files are to hold fewer rows than a task should (``ROWS_PER_TASK``), a
    task gets a range of tickers of a run of dates instead, and writes a file for each of them: as many files, which
    lie in several tasks for each date, of about as many rows. Within a task,
    rows are sorted by (date, ticker): one open file at a time, and
    ticker-ordered row groups whose min/max statistics let readers skip by ticker.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [PARTITION_COLUMN, CLUSTER_COLUMN]
    large = {d: n for d, n in (sizes or {}).items() if d is not None and n > rows_per_file}
    if not large:
        return df.repartition(tasks, PARTITION_COLUMN).sortWithinPartitions(*order)
    is_large = F.coalesce(F.col(PARTITION_COLUMN).isin(list(large)), F.lit(False))
    ranges = sum(-(-n // rows_per_file) for n in large.values())
    keys = order
    files_a_date = max(2, round(ranges / len(large)))
    fit = sum(large.values()) / max(rows_per_file, ROWS_PER_TASK)
    runs = min(len(large), max(1, round(max(tasks, fit) / files_a_date)))
    if rows_per_file < ROWS_PER_TASK and runs * files_a_date < ranges:
        ranges, keys = runs * files_a_date, [_run_of_dates(large, runs), CLUSTER_COLUMN, PARTITION_COLUMN]
    split = df.where(is_large).repartitionByRange(ranges, *keys).sortWithinPartitions(*order)
    if len(large) == len(sizes):
        return split
    return split.unionByName(df.where(~is_large).repartition(tasks, PARTITION_COLUMN).sortWithinPartitions(*order))


def _run_of_dates(sizes: Mapping[dt.date, int], runs: int) -> Column:
    """The number of the run a date is in, of ``runs`` runs of neighbouring dates that hold about as many rows each."""
    most, before, no = sum(sizes.values()) / runs, 0, 0
    run = None
    for day in sorted(sizes):
        if before >= (no + 1) * most and no + 1 < runs:
            later = F.col(PARTITION_COLUMN) < F.lit(day)
            run = F.when(later, no) if run is None else run.when(later, no)
            no += 1
        before += sizes[day]
    return F.lit(no) if run is None else run.otherwise(no)


# ------------------------------------------------------------------- K1 --

def write_flat(
    df: DataFrame, path: str, mode: str = "append", load_id: str | None = None,
    sizes: Mapping[dt.date, int] | None = None, rows_per_file: int = ROWS_PER_FILE, widen: Widen | None = None,
) -> None:
    """K1: write flat rows partitioned by date, stamped with load time and id.

    With ``widen`` (one row for one row, keys unchanged) ``df`` has the narrower rows, with their keys, that it makes
    flat rows of: these are shuffled and sorted, and widened by the tasks that write.
    ``sizes`` (rows a date, see ``day_sizes``) lets large dates be written by many tasks.

    ``append`` adds rows as the upstream job does; a retried load then holds
    its rows twice, and R5 by load time picks the later before the upsert.
    ``replace_dates`` overwrites exactly the dates present in ``df`` (dynamic
    partition overwrite), so re-running a date is idempotent.
    """
    laid = _clustered(_require_date(df), sizes, rows_per_file)
    rows = laid if widen is None else widen(laid)
    version = F.col(DOC_VERSION) if DOC_VERSION in rows.columns else F.lit(None).cast("long")
    stamped = rows.withColumns(
        {LOAD_TIME: F.current_timestamp(), LOAD_ID: F.lit(load_id).cast("string"), DOC_VERSION: version}
    )
    writer = stamped.write.option("compression", COMPRESSION).partitionBy(PARTITION_COLUMN)
    if mode == "append":
        write_files(writer.mode("append"), df.sparkSession, path)
    elif mode == "replace_dates":
        write_files(writer.mode("overwrite").option("partitionOverwriteMode", "dynamic"), df.sparkSession, path)
    else:
        raise ValueError(f"unknown flat write mode {mode!r}")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a table folder under its declared schema."""
    return spark.read.schema(schema).parquet(path)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """The flat table's 107 columns."""
    return read_flat_loads(spark, path).select(*FLAT_SCHEMA.fieldNames())


def read_flat_loads(spark: SparkSession, path: str) -> DataFrame:
    """The flat table with each row's load time and id."""
    return read_table(spark, path, FLAT_STORED_SCHEMA)


def located(scan: DataFrame) -> DataFrame:
    """Rows of a table scan with the file each lies in and its number there, for ``latest_load``."""
    return scan.withColumns({FILE_PATH: F.col("_metadata.file_path"), FILE_ROW: F.col("_metadata.row_index")})


def table_exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or ``None`` where its path does not exist; any other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_dates(
    spark: SparkSession, path: str, schema: T.StructType, dates: Sequence[dt.date]
) -> DataFrame | None:
    """The rows of ``dates`` in a date-partitioned table, or ``None`` when none
    of those dates has a folder yet.

    One path pattern names the dates, however many: the table's folder is
    listed (one entry a day), and of its date folders only those of ``dates``.
    """
    days = sorted(set(dates))
    if not days:
        return None
    glob = f"{path.rstrip('/')}/{PARTITION_COLUMN}={{{','.join(d.isoformat() for d in days)}}}"
    return table_exists(lambda: spark.read.schema(schema).option("basePath", path).parquet(glob))


# ------------------------------------------------------------------- K2 --

def ensure_fact_table(spark: SparkSession, path: str) -> None:
    """K2: create the fact table if absent (declared 67 columns, partitioned
    by date). Appending an empty frame creates the folder and nothing else,
    so the call is idempotent and works on any Hadoop filesystem."""
    spark.createDataFrame([], FACT_SCHEMA).write.mode("append").partitionBy(
        PARTITION_COLUMN
    ).parquet(path)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, FACT_SCHEMA)


def to_fact_columns(flat: DataFrame) -> DataFrame:
    """Project flat rows onto the fact contract by name, casting each column
    to its declared type (two integer counts widen to bigint, the date is
    cast as the warehouse statement does)."""
    types = {f.name: f.dataType for f in flat.schema.fields}
    return flat.select(
        *[
            F.col(f"`{f.name}`")
            if types.get(f.name) == f.dataType
            else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
            for f in FACT_SCHEMA.fields
        ]
    )


# ------------------------------------------------------------------- K3 --

def dates_of(df: DataFrame) -> list[dt.date]:
    """The distinct dates of a load or a table scan: a set bounded by the
    calendar (one value per day), never the rows themselves."""
    return sorted(r[0] for r in df.select(PARTITION_COLUMN).distinct().collect())


def upsert_fact(
    spark: SparkSession,
    source_flat: DataFrame,
    fact_path: str,
    update_columns: Sequence[str] = tuple(UPDATE_COLUMNS_FULL),
    dates: Sequence[dt.date] | None = None,
    sizes: Mapping[dt.date, int] | None = None,
    widen: Widen | None = None,
) -> None:
    """K3: merge flat rows into the fact table by (ticker_id, ingestion_date).

    Only the fact partitions of the loaded dates are read, by the names of
    their folders, and only those are rewritten (dynamic partition overwrite).
    Untouched dates are never read nor written. ``dates`` may be passed when
    the caller knows them (the daily load does); otherwise they are taken from
    the source, which costs an evaluation of it. ``sizes`` are the source's rows a
    date, where the caller knows them: large dates are then written by many tasks.

    If no loaded date has a fact partition yet nothing can match, and the rows
    are inserted: no target read, no join, no shuffle but the write's. With ``widen`` the source has
    the narrower rows that flat rows are made of (see ``write_flat``), and these are
    shuffled as such, to the write or to the join. A normal daily run (a new day) is therefore a plain partitioned
    write. Otherwise all rows go through one full outer join, in which rows of
    new dates have no partner. Of many dates (a task of the write has several) both sides are dealt to
    the join by date, as the write needs its rows, so merged rows are not shuffled again; of few, by the whole key.
    Either way the source is evaluated once.

    Not atomic across partitions: load one date (or one batch of dates) per
    call, and re-run the same call after a failure — the merge is
    idempotent.
    """
    ensure_fact_table(spark, fact_path)
    src = _require_date(source_flat)
    days = list(dates) if dates is not None else dates_of(src)
    if not days:
        return
    if dates is not None:
        src = src.where(F.col(PARTITION_COLUMN).isin(days))

    def facts(rows: DataFrame) -> DataFrame:
        return to_fact_columns(rows if widen is None else widen(rows))

    target = read_dates(spark, fact_path, FACT_SCHEMA, days)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if target is not None and len(days) >= tasks and max((sizes or {}).values(), default=0) <= ROWS_PER_FILE:
        target, src = (side.repartition(tasks, PARTITION_COLUMN) for side in (target, src))
        merged = merge_plan(target, facts(src), update_columns, KEY_COLUMNS, dealt=True)
        with _setting(spark, JOIN_BY_ALL_KEYS, "false"):
            _write_facts(merged.sortWithinPartitions(PARTITION_COLUMN, CLUSTER_COLUMN), fact_path)
        return
    if target is not None:
        # Narrower rows meet by key first: the join takes them as they are dealt then.
        source = facts(src if widen is None else src.repartition(*KEY_COLUMNS))
        rows = _clustered(merge_plan(target, source, update_columns, KEY_COLUMNS), sizes)
    elif widen is not None:
        rows = facts(_clustered(src, sizes))
    else:
        rows = _clustered(facts(src), sizes)
    _write_facts(rows, fact_path)


def _write_facts(rows: DataFrame, path: str) -> None:
    """Replace the partitions that ``rows`` holds."""
    writer = (
        rows.write.mode("overwrite")
        .option("compression", COMPRESSION)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
    )
    write_files(writer, rows.sparkSession, path)


# ------------------------------------------------------------------- K4 --

DIMENSION_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in DIMENSION_COLUMNS])
AS_OF = "as_of_date"
BUCKET = "bucket"
DIMENSION_BUCKETS = 16
# Stored layout of the dimension: the 17 columns, the date each row was seen
# at, and a hash bucket of the ticker used as the partition column.
DIMENSION_STORED_SCHEMA = T.StructType(
    DIMENSION_SCHEMA.fields
    + [T.StructField(AS_OF, T.DateType(), True), T.StructField(BUCKET, T.IntegerType(), True)]
)


def _with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64("ticker_id"), F.lit(buckets)).cast("int"))


def _write_dimension(df: DataFrame, path: str, overwrite: str) -> None:
    """One or a few files per bucket (AQE-sized), sorted by ticker. ``static``
    replaces the table, ``dynamic`` the buckets that ``df`` holds."""
    writer = (
        df.select(*[f.name for f in DIMENSION_STORED_SCHEMA.fields])
        .hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, "ticker_id")
        .write.partitionBy(BUCKET)
        .option("partitionOverwriteMode", overwrite)
        .mode("overwrite")
    )
    write_files(writer, df.sparkSession, path)


def refresh_dimension(
    flat: DataFrame, path: str, mode: str = "latest", buckets: int = DIMENSION_BUCKETS
) -> None:
    """K4: full refresh of the dimension from the whole flat history. What is
    not in that history any more is gone afterwards. In mode ``latest``, only rows at a
    ticker's last date are shuffled, as ``latest_candidates`` finds them."""
    if mode == "latest":
        flat = latest_candidates(flat)
    dim = build_dimension(flat, mode, keep_date=True)
    _write_dimension(_with_bucket(dim, buckets), path, "static")


def update_dimension(
    spark: SparkSession,
    new_rows: DataFrame,
    path: str,
    history: DataFrame,
    dates: Sequence[dt.date],
    mode: str = "latest",
    buckets: int = DIMENSION_BUCKETS,
) -> None:
    """K4, incremental: fold the rows of a load of ``dates`` into the dimension.

    Both dimensions are associative over the history — the latest attributes
    are a ``max(struct(date, attrs…))`` and the distinct rows a set union — so
    ``dim(history + new day) = dim(dim(history) + day)``: a new day costs the
    dimension plus the day.

    A date that is loaded again may take back what it gave before. Rows that
    were last seen on one of ``dates`` are therefore dropped, and their tickers
    are built from ``history`` (the flat table with the load in it) — unless
    mode is ``latest`` and the load has the ticker on that date or later,
    which settles it. Only the buckets of tickers concerned are rewritten.
    """
    days_rows = new_rows.select(PARTITION_COLUMN, *DIMENSION_COLUMNS)
    old = table_exists(lambda: read_table(spark, path, DIMENSION_STORED_SCHEMA))
    if old is None:  # first load, nothing to fold into
        refresh_dimension(history, path, mode, buckets)
        return
    last_seen = F.col(AS_OF).isin(list(dates))
    unsettled = old.where(last_seen).groupBy("ticker_id").agg(F.max(AS_OF).alias("_seen"))
    if mode == "latest":
        newest = days_rows.groupBy(F.col("ticker_id").alias("_t")).agg(F.max(PARTITION_COLUMN).alias("_new"))
        unsettled = unsettled.join(
            newest, F.col("ticker_id").eqNullSafe(F.col("_t")) & (F.col("_new") >= F.col("_seen")), "left_anti"
        )
    unsettled = unsettled.select(F.col("ticker_id").alias("_u"))
    new = days_rows
    if unsettled.limit(1).count():
        again = history.select(PARTITION_COLUMN, *DIMENSION_COLUMNS).join(
            unsettled, F.col("ticker_id").eqNullSafe(F.col("_u")), "left_semi"
        )
        new = days_rows.unionByName(again)
    gone = old.where(last_seen).select("ticker_id")
    touched = _with_bucket(days_rows.select("ticker_id").unionByName(gone).distinct(), buckets)
    in_buckets = [r[0] for r in touched.select(BUCKET).distinct().collect()]  # at most ``buckets`` values
    kept = old.where(F.col(BUCKET).isin(in_buckets) & ~last_seen).select(
        F.col(AS_OF).alias(PARTITION_COLUMN), *DIMENSION_COLUMNS
    )
    merged = build_dimension(kept.unionByName(new), mode, keep_date=True)
    _write_dimension(_with_bucket(merged, buckets), path, "dynamic")


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The 17 dimension columns (storage columns left out)."""
    return read_table(spark, path, DIMENSION_STORED_SCHEMA).select(*DIMENSION_COLUMNS)
