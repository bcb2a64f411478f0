"""Upserts, scalar rules, screening, sources and sinks."""

import datetime as dt
import json
import os
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from candlegrid.functions.numeric import change_at_least, ratio_to_high, truncate
from candlegrid.operators.upsert import merge_report, upsert
from candlegrid.plans.fundamentals import normalise
from candlegrid.plans.reports import ingest_outcome, screen_summary
from candlegrid.schemas import MEASURES, RATING_KEY
from candlegrid.operators.screen import screen
from candlegrid.sinks.export import export_table
from candlegrid.sinks.tables import current_version, read_current, staged_update, write_table
from candlegrid.sources.incremental import read_changed_files
from candlegrid.sources.symbols import read_symbols_json
from candlegrid.sources.tables import read_table

KEYS = ("Date", "ticker", "period")
PRICE = "Date date, ticker string, period string, Close double"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def values(spark, column, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    return [r[0] for r in df.select(column).collect()]


def test_truncate(spark):
    got = values(spark, truncate(F.col("x"), 2), [1.15, -1.15, 1e12, None, float("nan"), 12.34, 1e300, -0.001])
    assert got == [1.14, -1.14, 1e12, None, None, 12.34, 1e300, 0.0]


def test_change_and_ratio(spark):
    df = spark.createDataFrame([(1.7, 1.0), (1.0, 0.0), (0.0, 0.0), (1.6, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(change_at_least(F.col("a"), F.col("b"), 70)).collect()] == [True, True, False, False]
    got = df.select(ratio_to_high(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [1.7, None, None, 1.6]


def test_first_run_returns_the_batch(spark):
    new = spark.createDataFrame([(day(1), "A", "D", 1.0)], PRICE)
    for policy in ("overwrite", "keep_old", "delete_tail_merge"):
        assert rows(upsert(None, new, KEYS, policy)) == rows(new)


def test_null_keys_are_refused(spark):
    good = spark.createDataFrame([(day(1), "A", "D", 1.0)], PRICE)
    bad = spark.createDataFrame([(day(1), None, "D", 1.0)], PRICE)
    for old, new in ((good, bad), (bad, good)):
        with pytest.raises(Exception, match="NULL in key columns"):
            upsert(old, new, KEYS).collect()


def test_keep_old_and_merge_policies(spark):
    old = [(day(d), t, "D", float(d)) for t in "AB" for d in range(6)]
    new = [(day(d), "A", "D", 100.0 + d) for d in range(2, 8)]
    o, n = spark.createDataFrame(old, PRICE), spark.createDataFrame(new, PRICE)
    kept = {(r["Date"], r["ticker"]): r["Close"] for r in upsert(o, n, KEYS, "keep_old").collect()}
    assert kept[day(3), "A"] == 3.0  # the old row wins
    assert kept[day(4), "A"] == 104.0 and kept[day(7), "A"] == 107.0  # tail and new days
    assert kept[day(5), "B"] == 5.0 and len(kept) == 8 + 6
    merged = {(r["Date"], r["ticker"]): r["Close"] for r in upsert(o, n, KEYS, "delete_tail_merge").collect()}
    assert merged[day(3), "A"] == 103.0 and merged[day(1), "A"] == 1.0 and len(merged) == 14
    report = merge_report(o, n).collect()[0]
    assert (report["deleted"], report["updated"], report["inserted"]) == (2, 2, 4)


def test_merge_deletes_dates_of_any_batch_ticker(spark):
    old = [(day(d), "A", "D", 0.0) for d in range(6)] + [(day(d), "B", "D", 0.0) for d in range(3)]
    new = [(day(9), t, "D", 1.0) for t in "AB"]
    got = upsert(spark.createDataFrame(old, PRICE), spark.createDataFrame(new, PRICE), KEYS, "delete_tail_merge")
    # tails: A 4, 5; B 1, 2 -- so A also loses 1 and 2
    assert sorted(r["Date"] for r in got.where("ticker = 'A'").collect()) == [day(0), day(3), day(9)]


def test_tail_is_per_ticker_over_periods_unless_asked(spark):
    old = [(day(9), "A", "W", 0.0), (day(8), "A", "ME", 0.0), (day(7), "A", "D", 0.0), (day(6), "A", "D", 0.0)]
    new = [(day(20), "A", "D", 1.0)]
    o, n = spark.createDataFrame(old, PRICE), spark.createDataFrame(new, PRICE)
    assert [r[0] for r in rows(upsert(o, n, KEYS, "keep_old"))] == [day(6), day(7), day(20)]
    per_period = upsert(o, n, KEYS, "keep_old", tail_n=1, tail_keys=("ticker", "period"))
    assert [r[0] for r in rows(per_period)] == [day(6), day(8), day(9), day(20)]


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([(day(d), "A", "D", 0.0) for d in range(5)], PRICE)
    new = spark.createDataFrame([(day(d), "A", "D", 1.0) for d in range(3, 8)], PRICE)
    for policy in ("overwrite", "delete_tail_merge"):
        once = upsert(old, new, KEYS, policy)
        assert rows(upsert(once, new, KEYS, policy)) == rows(once)


def test_mark_inactive(spark):
    schema = "cik bigint, ticker string, is_active boolean"
    old = spark.createDataFrame([(1, "A", True), (2, "B", True)], schema)
    new = spark.createDataFrame([(2, "B", True), (3, "C", True)], schema)
    assert rows(upsert(old, new, ("cik", "ticker"), "mark_inactive")) == [(1, "A", False), (2, "B", True), (3, "C", True)]


def test_normalise_then_screen(spark):
    passing = {
        "market_cap": "2e9", "price_to_sales": "5", "roe": "0.2", "current_ratio": "2.5004", "debt_to_equity": "10.0009",
        "roa_ttm": "0.1", "eps_ttm": "1", "operating_cash_flow": "5", "institutional_pct": "0.4", "analyst_rating_mean": "3",
        "trailing_pe": "Infinity", "forward_pe": "n/a",
    }
    failing = {**passing, "current_ratio": "2.4999"}
    data = [("2024-01-01", t, *(p.get(m) for m in MEASURES), "none") for t, p in
            (("X", passing), ("Y", failing), ("AAPL", failing), ("SPY", failing))]
    cols = ", ".join(f"{c} string" for c in ("created_at", "ticker", *MEASURES, RATING_KEY))
    normal = normalise(spark.createDataFrame(data, cols))
    x = normal.where("ticker = 'X'").first()
    assert x["debt_to_equity"] == 10.0 and x["trailing_pe"] is None and x["forward_pe"] is None and x[RATING_KEY] is None
    picked = screen(normal)
    assert {r["ticker"]: r["is_selected"] for r in picked.collect()} == {
        "X": "HighGrowth", "AAPL": "Magnificent_8", "SPY": "ETF_1",
    }
    assert {r["total"] for r in screen_summary(picked).collect()} == {3}


def test_ingest_outcome(spark):
    expected = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    arrived = spark.createDataFrame([("A",), ("A",)], "ticker string")
    tries = spark.createDataFrame([("B", True), ("C", False)], "ticker string, rate_limited boolean")
    assert rows(ingest_outcome(expected, arrived, tries)) == [("A", 2, "success"), ("B", 0, "retry"), ("C", 0, "failed")]


def test_staged_update_reads_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "fund")
    new = spark.createDataFrame([(day(1), "A", "D", 1.0)], PRICE)
    assert read_current(spark, path) is None
    staged_update(spark, path, lambda old: upsert(old, new, KEYS))
    later = spark.createDataFrame([(day(2), "A", "D", 2.0), (day(1), "A", "D", 9.0)], PRICE)
    for _ in range(3):
        staged_update(spark, path, lambda old: upsert(old, later, KEYS))
    assert rows(read_current(spark, path)) == rows(later)
    assert len(os.listdir(path)) == 2
    os.makedirs(f"{path}/version=00000099")  # a job lost half-way
    assert current_version(spark, path).endswith("00000004")


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert read_table(spark, path) is None
    write_table(spark.createDataFrame([(day(1), "A", "D", 1.0), (day(1), "A", "W", 1.0)], PRICE), path, ["period"])
    write_table(spark.createDataFrame([(day(1), "A", "W", 2.0)], PRICE), path, ["period"])
    got = {r["period"]: r["Close"] for r in read_table(spark, path).collect()}
    assert got == {"D": 1.0, "W": 2.0}


def test_changed_files_only(spark, tmp_path):
    zone = ZoneInfo("Asia/Taipei")
    made = {"us_2W": dt.datetime(2024, 3, 5, 0, 30, tzinfo=zone), "us_W": dt.datetime(2024, 3, 4, 23, 30, tzinfo=zone),
            "final_all_2W": dt.datetime(2024, 3, 5, 12, tzinfo=zone)}
    import pyarrow as pa
    import pyarrow.parquet as pq

    for stem, when in made.items():
        file = tmp_path / f"{stem}.parquet"
        pq.write_table(pa.table({"x": [1]}), file)
        os.utime(file, (when.timestamp(), when.timestamp()))
    got = read_changed_files(spark, str(tmp_path), dt.date(2024, 3, 5), "Asia/Taipei", ("final_all", "conclusion")).collect()
    assert [(r["x"], r["file_stem"], r["file_period"]) for r in got] == [(1, "us_2W", "2W")]


def test_symbols_json(spark, tmp_path):
    file = tmp_path / "tickers.json"
    file.write_text(json.dumps({"0": {"cik_str": 21344, "ticker": "KO", "title": "COCA COLA CO"}}))
    got = read_symbols_json(spark, str(file), F.lit("2024-01-01").cast("timestamp")).first()
    assert (got["cik"], got["ticker"], got["is_active"]) == (21344, "KO", True)


def test_export_orders_and_spells_out_missing(spark, tmp_path):
    df = spark.createDataFrame(
        [("B", day(1), None), ("A", day(1), "Long"), ("C", day(2), None)], "ticker string, Date_D date, Side_1_D string"
    )
    out = export_table(df, "Date_D", str(tmp_path / "csv")).collect()
    assert [tuple(r) for r in out] == [
        ("C", "2024-01-03", "None"), ("A", "2024-01-02", "Long"), ("B", "2024-01-02", "None"),
    ]


def _rows(*rows):
    return [(day(d), t, p, c) for d, t, p, c in rows]


def test_staged_updates_of_a_partitioned_table_keep_old_rows(spark, tmp_path):
    path = str(tmp_path / "prices")
    batches = [_rows((1, "A", "D", 1.0), (1, "A", "W", 1.0)), _rows((1, "B", "D", 2.0)), _rows((1, "A", "W", 3.0))]
    for rows in batches:
        batch = spark.createDataFrame(rows, PRICE)
        staged_update(
            spark, path, lambda old, new: upsert(old, new, KEYS), ["period"], batch=batch, sort_by=("ticker", "Date")
        )
    got = sorted((r["ticker"], r["period"], r["Close"]) for r in read_current(spark, path).collect())
    assert got == [("A", "D", 1.0), ("A", "W", 3.0), ("B", "D", 2.0)]
    assert sorted(p.name for p in (tmp_path / "prices").iterdir() if not p.name.startswith(".")) == [
        "version=00000002", "version=00000003",
    ]


def test_a_merge_computes_its_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    for policy in ("overwrite", "keep_old", "delete_tail_merge"):
        path = str(tmp_path / policy)
        staged_update(spark, path, lambda old: spark.createDataFrame(_rows((1, "A", "D", 1.0)), PRICE))
        new = spark.createDataFrame(_rows((2, "A", "D", 1.0), (3, "B", "D", 1.0)), PRICE)
        before = seen.value
        staged_update(
            spark, path, lambda old, new, policy=policy: upsert(old, new, KEYS, policy), batch=new.mapInArrow(count, new.schema)
        )
        assert seen.value - before == 2, policy


def test_the_second_writer_of_a_version_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(_rows((1, "A", "D", 1.0)), PRICE)

    def update(old):
        with pytest.raises(FileExistsError):
            staged_update(spark, path, lambda _: rows)
        return rows

    staged_update(spark, path, update)
    assert read_current(spark, path).count() == 1


def test_exclusion_looks_below_the_root(spark, tmp_path):
    root = tmp_path / "conclusion_lake"
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(str(root / "prices"))
    spark.createDataFrame([(2,)], "x int").coalesce(1).write.parquet(str(root / "conclusion"))
    today = dt.datetime.now(ZoneInfo("UTC")).date()
    got = read_changed_files(spark, str(root), today, "UTC", ("conclusion",)).collect()
    assert [r["x"] for r in got] == [1]


def test_keep_old_leaves_one_row_a_key(spark):
    old = spark.createDataFrame(
        _rows((1, "A", "D", 1.0), (1, "A", "D", 5.0), (2, "A", "D", 1.0), (3, "A", "D", 1.0), (1, "Z", "D", 2.0), (1, "Z", "D", 3.0)), PRICE
    )
    new = spark.createDataFrame(_rows((4, "A", "D", 7.0), (4, "A", "D", 8.0), (1, "A", "D", 9.0)), PRICE)
    got = sorted((r["Date"], r["ticker"], r["Close"]) for r in upsert(old, new, KEYS, "keep_old").collect())
    assert got == [(day(1), "A", 5.0), (day(1), "Z", 3.0), (day(4), "A", 8.0)]
