"""K2/K3 upsert properties, R5 dedup, K1 flat modes, K4 dimension."""

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from tickerlake.operators.dedup import dedup_by_key, duplicate_keys
from tickerlake.operators.dimension import dimension_distinct, dimension_latest
from tickerlake.operators.latest import latest_candidates
from tickerlake.operators.upsert import merge_plan
from tickerlake.schema import FACT_SCHEMA, UPDATE_COLUMNS_FULL
from tickerlake.sinks.tables import read_fact, read_flat, upsert_fact, write_flat
from tickerlake.schema import FLAT_SCHEMA

from .helpers import plan_text

D1, D2, D3 = dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2026, 1, 3)


def flat(spark, rows):
    """Flat rows from (ticker, date, currentPrice, previousClose, trailingPE)."""
    base = spark.createDataFrame([], FLAT_SCHEMA)
    df = spark.createDataFrame(
        rows, "ticker_id string, ingestion_date date, currentPrice double, previousClose double, trailingPE double"
    )
    return base.unionByName(df, allowMissingColumns=True)


def facts(spark, path):
    return {
        (r.ticker_id, r.ingestion_date): (r.currentPrice, r.previousClose, r.trailingPE)
        for r in read_fact(spark, path).collect()
    }


def test_upsert_semantics(spark, tmp_uri):
    path = f"{tmp_uri}/fact"
    upsert_fact(spark, flat(spark, [("A", D1, 1.0, 10.0, 5.0), ("B", D1, 2.0, 20.0, 6.0), ("C", D2, 3.0, 30.0, 7.0)]), path)
    before_d2 = sorted(map(tuple, read_fact(spark, path).where(F.col("ingestion_date") == D2).collect()))
    upsert_fact(spark, flat(spark, [("A", D1, 1.5, 99.0, None), ("D", D1, 4.0, 40.0, 8.0), (None, D1, 9.0, 9.0, 9.0)]), path)
    got = facts(spark, path)
    # matched: listed columns from the source, even NULL; unlisted (previousClose) kept
    assert got[("A", D1)] == (1.5, 10.0, None)
    assert got[("B", D1)] == (2.0, 20.0, 6.0)  # target-only row on a loaded date survives
    assert got[("D", D1)] == (4.0, 40.0, 8.0)  # not matched → inserted whole
    assert got[(None, D1)] == (9.0, 9.0, 9.0)  # NULL key never matches, inserted
    # a date the source does not touch is byte-for-byte the same rows
    after_d2 = sorted(map(tuple, read_fact(spark, path).where(F.col("ingestion_date") == D2).collect()))
    assert after_d2 == before_d2
    assert len(read_fact(spark, path).columns) == 67


def test_upsert_is_idempotent(spark, tmp_uri):
    path = f"{tmp_uri}/fact"
    src = flat(spark, [("A", D1, 1.0, 10.0, 5.0), ("B", D3, 2.0, 20.0, None)])
    upsert_fact(spark, src, path)
    once = facts(spark, path)
    upsert_fact(spark, src, path)
    upsert_fact(spark, src, path)
    assert facts(spark, path) == once and len(once) == 2


def test_duplicate_matched_key_raises_and_writes_nothing(spark, tmp_uri):
    path = f"{tmp_uri}/fact"
    upsert_fact(spark, flat(spark, [("A", D1, 1.0, 10.0, 5.0)]), path)
    dup = flat(spark, [("A", D1, 2.0, 1.0, 1.0), ("A", D1, 3.0, 1.0, 1.0)])
    with pytest.raises(Exception) as e:
        upsert_fact(spark, dup, path)
    assert "MERGE_CARDINALITY_VIOLATION" in str(e.value)
    assert facts(spark, path) == {("A", D1): (1.0, 10.0, 5.0)}
    # after de-duplication (R5) the same source loads
    upsert_fact(spark, dedup_by_key(dup), path)
    assert facts(spark, path)[("A", D1)][0] == 2.0


def test_null_date_is_rejected(spark, tmp_uri):
    with pytest.raises(Exception) as e:
        upsert_fact(spark, flat(spark, [("A", None, 1.0, 1.0, 1.0)]), f"{tmp_uri}/fact")
    assert "NULL ingestion_date" in str(e.value)


def test_upsert_reads_only_source_dates(spark, tmp_uri):
    path = f"{tmp_uri}/fact"
    upsert_fact(spark, flat(spark, [("A", D1, 1.0, 1.0, 1.0), ("A", D2, 1.0, 1.0, 1.0)]), path)
    target = read_fact(spark, path).where(F.col("ingestion_date").isin([D1]))
    plan = plan_text(target)
    (line,) = [x for x in plan.splitlines() if x.startswith("PartitionFilters")]
    assert "2026-01-01" in line and "2026-01-02" not in line


def test_dedup_picks_first_in_order(spark):
    df = spark.createDataFrame(
        [("A", D1, 3.0, "z"), ("A", D1, 1.0, "y"), ("A", D1, None, "x"), ("B", D1, 5.0, "w")],
        "ticker_id string, ingestion_date date, px double, tag string",
    )
    got = {r.ticker_id: r.tag for r in dedup_by_key(df, order=["px"]).collect()}
    assert got == {"A": "x", "B": "w"}  # NULLs first, ascending
    got = {r.ticker_id: r.tag for r in dedup_by_key(df, order=[-F.col("px")]).collect()}
    assert got["A"] == "x"  # NULL still first; then the largest px
    got = {r.ticker_id: r.tag for r in dedup_by_key(df, order=[F.col("px").isNull(), -F.col("px")]).collect()}
    assert got["A"] == "z"
    assert {(r.ticker_id, r.copies) for r in duplicate_keys(df).collect()} == {("A", 3)}


def test_flat_modes(spark, tmp_uri):
    path = f"{tmp_uri}/flat"
    rows = flat(spark, [("A", D1, 1.0, 1.0, 1.0), ("B", D2, 2.0, 2.0, 2.0)])
    write_flat(rows, path, "append")
    write_flat(rows, path, "append")
    assert read_flat(spark, path).count() == 4  # plain append keeps a retried load twice
    path2 = f"{tmp_uri}/flat2"
    write_flat(rows, path2, "replace_dates")
    write_flat(flat(spark, [("C", D1, 3.0, 3.0, 3.0)]), path2, "replace_dates")
    got = sorted((r.ticker_id, r.ingestion_date) for r in read_flat(spark, path2).collect())
    assert got == [("B", D2), ("C", D1)]  # D1 replaced, D2 untouched


def test_dimension_latest_vs_distinct(spark):
    df = spark.createDataFrame(
        [("A", D1, "Tech", "X"), ("A", D2, "Tech", "Y"), ("A", D2, "Tech", "Z"), ("B", D1, None, None)],
        "ticker_id string, ingestion_date date, sector string, exchange string",
    )
    cols = ["ticker_id", "sector", "exchange"]
    assert dimension_distinct(df, cols).count() == 4
    latest = {r.ticker_id: (r.sector, r.exchange) for r in dimension_latest(df, cols).collect()}
    assert latest == {"A": ("Tech", "Z"), "B": (None, None)}
    assert FACT_SCHEMA["ingestion_date"].dataType.simpleString() == "date"


def test_merge_plan_shuffles_each_side_once(spark, tmp_uri):
    """De-dup, per-key copy count and the merge join share one hash
    partitioning on the key: one exchange per side, plus the write's
    shuffle."""
    from tickerlake.sinks.tables import _clustered, _require_date, to_fact_columns

    path = f"{tmp_uri}/fact"
    upsert_fact(spark, flat(spark, [("A", D1, 1.0, 1.0, 1.0)]), path)
    src = _require_date(to_fact_columns(dedup_by_key(flat(spark, [("A", D1, 2.0, 1.0, 1.0)]))))
    target = read_fact(spark, path).where(F.col("ingestion_date").isin([D1]))
    text = plan_text(_clustered(merge_plan(target, src, UPDATE_COLUMNS_FULL)), "simple")
    exchanges = [x for x in text.splitlines() if "Exchange " in x]
    assert len(exchanges) == 3, text  # source key, target key, layout by date


def test_mixed_new_and_existing_dates(spark, tmp_uri):
    from tickerlake.sinks.tables import dates_of

    path = f"{tmp_uri}/fact"
    upsert_fact(spark, flat(spark, [("A", D1, 1.0, 10.0, 5.0), ("B", D1, 2.0, 20.0, 6.0)]), path)
    assert dates_of(read_fact(spark, path)) == [D1]
    upsert_fact(spark, flat(spark, [("A", D1, 1.5, 0.0, None), ("A", D2, 7.0, 70.0, 7.0),
                                    ("C", D2, 8.0, 80.0, 8.0)]), path)
    got = facts(spark, path)
    assert got == {("A", D1): (1.5, 10.0, None), ("B", D1): (2.0, 20.0, 6.0),
                   ("A", D2): (7.0, 70.0, 7.0), ("C", D2): (8.0, 80.0, 8.0)}
    # duplicates on a new date cannot match anything: inserted, as MERGE does
    upsert_fact(spark, flat(spark, [("Z", D3, 1.0, 1.0, 1.0), ("Z", D3, 2.0, 2.0, 2.0)]), path)
    assert read_fact(spark, path).where(F.col("ingestion_date") == D3).count() == 2


@pytest.mark.parametrize("days", [2, 66])
def test_upsert_reads_named_folders_for_any_number_of_dates(spark, tmp_uri, days):
    """One code path: only the folders of the loaded dates are in the scan."""
    from tickerlake.sinks.tables import read_dates

    path = f"{tmp_uri}/fact"
    dates = [D1 + dt.timedelta(days=i) for i in range(70)]
    upsert_fact(spark, flat(spark, [("A", d, 1.0, 1.0, 1.0) for d in dates]), path)
    found = read_dates(spark, path, FACT_SCHEMA, dates[:days])
    assert found.select("ingestion_date").distinct().count() == days
    upsert_fact(spark, flat(spark, [("A", d, 2.0, 1.0, 1.0) for d in dates[:days]]), path)
    got = [r.currentPrice for r in read_fact(spark, path).collect()]
    assert sorted(got) == [1.0] * (70 - days) + [2.0] * days
    assert read_dates(spark, path, FACT_SCHEMA, [D1 - dt.timedelta(days=9)]) is None


def test_other_analysis_errors_are_raised(spark, tmp_uri):
    from tickerlake.sinks.tables import table_exists

    frame = spark.range(1)
    assert table_exists(lambda: spark.read.parquet(f"{tmp_uri}/nothing")) is None
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        table_exists(lambda: frame.select("absent"))


def test_null_keys_spread_and_never_match(spark, tmp_uri):
    path = f"{tmp_uri}/fact"
    rows = [(None, D1, float(i), 1.0, 1.0) for i in range(50)] + [("A", D1, 0.0, 1.0, 1.0)]
    upsert_fact(spark, flat(spark, rows), path)
    upsert_fact(spark, flat(spark, rows), path)  # NULL keys are inserted again, A is updated
    assert read_fact(spark, path).count() == 101


def test_full_dimension_refresh_forgets(spark, tmp_uri):
    from tickerlake.sinks.tables import read_dimension, refresh_dimension

    path = f"{tmp_uri}/dimension"
    refresh_dimension(flat(spark, [(f"T{i}", D1, 1.0, 1.0, 1.0) for i in range(200)]), path)
    assert read_dimension(spark, path).count() == 200
    refresh_dimension(flat(spark, [("T7", D2, 1.0, 1.0, 1.0)]), path)
    assert [r.ticker_id for r in read_dimension(spark, path).collect()] == ["T7"]


def test_latest_load_wins(spark, tmp_uri):
    from tickerlake.operators.dedup import latest_load
    from tickerlake.sinks.tables import read_flat_loads

    path = f"{tmp_uri}/flat"
    write_flat(flat(spark, [("A", D1, 1.0, 1.0, 1.0), ("B", D1, 5.0, 1.0, 1.0)]), path)
    write_flat(flat(spark, [("A", D1, 101.0, 1.0, 1.0), ("A", D1, None, None, None)]), path)
    got = {r.ticker_id: r.currentPrice for r in latest_load(read_flat_loads(spark, path)).collect()}
    assert got == {"A": 101.0, "B": 5.0}  # the later load, and not its empty row


def test_default_order_carries_each_value_once(spark):
    df = spark.createDataFrame([("A", D1, 1.0, "x")], "ticker_id string, ingestion_date date, px double, tag string")
    text = plan_text(dedup_by_key(df), "simple")
    assert "_row" not in text and text.count("struct(px") <= 2


def test_keys_that_occur_once_are_not_shuffled(spark, monkeypatch):
    from tickerlake.operators import dedup

    keyed = [("A", D1, 2.0, "late"), ("A", D1, 1.0, "first"), (None, D1, 4.0, "b"), (None, D1, 3.0, "a"), ("B", None, 5.0, "n")]
    df = spark.createDataFrame(keyed + [("C", D2, 6.0, "c")], "ticker_id string, ingestion_date date, px double, tag string")
    expected = {("A", D1, 1.0, "first"), (None, D1, 3.0, "a"), ("B", None, 5.0, "n"), ("C", D2, 6.0, "c")}
    alone = dedup_by_key(df.where("ticker_id = 'C'"))
    assert "Exchange" not in plan_text(alone, "simple")
    found = dedup_by_key(df)
    assert plan_text(found, "simple").count("LeftAnti") == 1
    assert sorted(map(str, found.collect())) == sorted(map(str, spark.createDataFrame(list(expected), df.schema).collect()))
    monkeypatch.setattr(dedup, "REPEATED_KEYS", 1)  # two keys repeat: all rows meet by key
    found = dedup_by_key(df)
    assert "LeftAnti" not in plan_text(found, "simple")
    assert {tuple(r) for r in found.collect()} == expected


def test_rows_are_widened_after_the_shuffle(spark, tmp_uri):
    """The sinks shuffle the narrow rows; what they write is what the wide rows give."""
    narrow = spark.createDataFrame(
        [("B", D1, 2.0), ("A", D1, 1.0), ("A", D2, 3.0)], "ticker_id string, ingestion_date date, px double")
    seen = []

    def widen(rows):
        seen.append(plan_text(rows, "simple"))
        wide = rows.select("ticker_id", "ingestion_date", F.col("px").alias("currentPrice"), (F.col("px") * 2).alias("trailingPE"))
        return spark.createDataFrame([], FLAT_SCHEMA).unionByName(wide, allowMissingColumns=True)

    write_flat(narrow, f"{tmp_uri}/narrow", widen=widen)
    write_flat(widen(narrow), f"{tmp_uri}/wide")
    assert "Exchange" in seen[0] and "trailingPE" not in seen[0]
    tables = [sorted(map(str, read_flat(spark, f"{tmp_uri}/{n}").collect())) for n in ("narrow", "wide")]
    assert tables[0] == tables[1] and len(tables[0]) == 3
    upsert_fact(spark, narrow, f"{tmp_uri}/fact", widen=widen)  # inserts
    assert "Exchange" in seen[2]
    upsert_fact(spark, narrow.withColumn("px", F.col("px") + 1), f"{tmp_uri}/fact", widen=widen)  # updates
    assert facts(spark, f"{tmp_uri}/fact") == {("A", D1): (2.0, None, 4.0), ("A", D2): (4.0, None, 8.0), ("B", D1): (3.0, None, 6.0)}


def test_narrow_rows_meet_the_target_before_they_are_widened(spark, tmp_uri, monkeypatch):
    def widen(rows):
        named = rows.withColumn("currentPrice", F.col("px")).drop("px")
        return named.select(
            *[F.col(f"`{f.name}`") if f.name in named.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FLAT_SCHEMA.fields]
        )

    plans = []

    def planned(*args, **kwargs):
        rows = merge_plan(*args, **kwargs)
        plans.append(plan_text(rows, "formatted"))
        return rows

    monkeypatch.setattr("tickerlake.sinks.tables.merge_plan", planned)
    for px in (1.0, 2.0):
        narrow = spark.createDataFrame([("A", D1, px), (None, D1, px)], "ticker_id string, ingestion_date date, px double")
        upsert_fact(spark, narrow, f"{tmp_uri}/fact", widen=widen)
    moved = [line.count(",") + 1 for line in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plans[0])]
    assert sorted(moved) == [3, 67] or sorted(moved) == [3, 68]  # narrow source, whole target
    got = [tuple(r) for r in read_fact(spark, f"{tmp_uri}/fact").select("ticker_id", "currentPrice").collect()]
    assert sorted(got, key=str) == sorted([("A", 2.0), (None, 1.0), (None, 2.0)], key=str)


def test_only_rows_at_the_last_date_are_latest_candidates(spark, monkeypatch):
    rows = [("A", D1, 1), ("A", D2, 2), ("A", D2, 3), ("B", D1, 4), (None, D1, 5), (None, D3, 6), ("C", None, 7)]
    fact = spark.createDataFrame(rows, "ticker_id string, ingestion_date date, n int")
    assert sorted(r.n for r in latest_candidates(fact).collect()) == [2, 3, 4, 6, 7]
    monkeypatch.setattr("tickerlake.operators.latest.SENT_TICKERS", 3)
    assert latest_candidates(fact).count() == len(rows)


def test_rows_of_earlier_loads_are_dropped_before_any_shuffle_of_rows(spark, tmp_uri, monkeypatch):
    from tickerlake.operators import dedup
    from tickerlake.sinks.tables import located, read_flat_loads

    path = f"{tmp_uri}/flat"
    keys = [(f"T{i:03d}" if i else None, d) for i in range(90) for d in (D1, D2)]
    write_flat(flat(spark, [(t, d, 1.0, 1.0, 1.0) for t, d in keys]), path)
    again = [(t, d, 2.0 + i % 3, 1.0, 1.0) for i, (t, d) in enumerate(keys) if i % 5]
    tied = [("T001", D1, 9.0, 0.5, 1.0), ("T001", D2, 7.0, None, None), ("T002", D1, None, None, None)]
    write_flat(flat(spark, again + tied[2:]), path)
    expected = {(t, d): 1.0 for t, d in keys} | {(t, d): px for t, d, px, *_ in again}
    monkeypatch.setattr(dedup, "REPEATED_KEYS", 2)  # more repeat: all rows would meet by key
    monkeypatch.setattr(dedup, "BITMAP_ROWS", 16)  # a file has several bitmaps

    def found():
        return dedup.latest_load(located(read_flat_loads(spark, path)))

    def prices(rows):
        return {(r.ticker_id, r.ingestion_date): r.currentPrice for r in rows.collect()}

    assert "hashpartitioning" not in plan_text(found(), "simple")  # nothing ties, and no row is shuffled
    assert found().columns == FLAT_SCHEMA.fieldNames() and found().count() == len(expected)
    assert prices(found()) == expected
    write_flat(flat(spark, tied + [tied[0]]), path)  # the last load has two equal rows of a key
    expected |= {("T001", D1): 9.0, ("T001", D2): 7.0, ("T002", D1): None}
    assert prices(found()) == expected and found().count() == len(expected)
    monkeypatch.setattr(dedup, "SENT_BITMAPS", 1)  # too many bitmaps: all rows meet by key
    assert prices(found()) == expected and "hashpartitioning" in plan_text(found(), "simple")


def test_merge_of_many_dates_shuffles_no_merged_rows(spark, tmp_uri, monkeypatch):
    """Both sides are dealt by date, as the write needs them; the merge is the one by whole keys."""
    from tickerlake.sinks import tables

    days = [D1 + dt.timedelta(days=i) for i in range(30)]
    old = [(t, d, 1.0, 1.0, 1.0) for d in days[:20] for t in ("A", "B", None)]
    new = [(t, d, 2.0, None, 2.0) for d in days[5:] for t in ("B", "C", None)]
    seen, write = [], tables._write_facts

    def written(rows, path):
        seen.append(plan_text(rows, "simple"))
        write(rows, path)

    got = []
    for by_date in (True, False):
        path = f"{tmp_uri}/fact{by_date}"
        monkeypatch.setattr(tables, "ROWS_PER_FILE", 1_000_000 if by_date else -1)
        upsert_fact(spark, flat(spark, old), path)
        with monkeypatch.context() as m:
            m.setattr(tables, "_write_facts", written)
            upsert_fact(spark, flat(spark, new), path, dates=days)
        got.append(sorted((str(tuple(r)) for r in read_fact(spark, path).collect())))
        files = [f for d in days for f in glob.glob(f"{path}/ingestion_date={d}/part-*")]
        assert len(files) == len(days)
    assert got[0] == got[1] and len(got[0]) == 20 * 3 + 25 * 3 - 15
    assert [text.count("Exchange hashpartitioning") for text in seen] == [2, 3]  # sides, and their merged rows
    twice = [("A", days[0], 3.0, 3.0, 3.0), ("A", days[0], 4.0, 3.0, 3.0)]
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 1_000_000)
    with pytest.raises(Exception, match="MERGE_CARDINALITY_VIOLATION"):
        upsert_fact(spark, flat(spark, twice), f"{tmp_uri}/factTrue", dates=days)


def test_a_write_leaves_no_shuffle_files(spark, tmp_uri):
    import time

    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = left(), spark.conf.get(setting)
    rows = flat(spark, [(f"T{i}", d, 1.0, 1.0, 1.0) for i in range(50) for d in (D1, D2, D3)])
    for _ in range(2):
        write_flat(rows, f"{tmp_uri}/flat", "replace_dates")
        upsert_fact(spark, rows, f"{tmp_uri}/fact", dates=[D1, D2, D3])
    for _ in range(40):  # files are removed by another thread
        if not (found := left() - before):
            break
        time.sleep(0.25)
    assert not found and spark.conf.get(setting) == was
    assert read_fact(spark, f"{tmp_uri}/fact").count() == 150
