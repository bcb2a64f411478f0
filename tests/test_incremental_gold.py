"""Gold kept up to date by ticker, and the tables in buckets under it."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlegrid.operators.upsert import MergeKeys, merge_counts, observed_merge
from candlegrid.plans.gold import build_gold
from candlegrid.plans.incremental import MEASURES, changed_tickers, refresh_gold, ticker_digests
from candlegrid.sinks import tables
from candlegrid.sinks.tables import read_buckets, replace_keys, staged_update, write_buckets


def bars(spark, tickers, first=0, days=90):
    rows = [
        (t, dt.date(2024, 1, 1) + dt.timedelta(days=d), *(float(10 + (d * (k + 3) + len(t)) % 17) for k in range(len(MEASURES))), dt.datetime(2024, 6, 1))
        for t in tickers
        for d in range(first, days)
    ]
    names = ", ".join(f"`{m}` double" for m in MEASURES)
    return spark.createDataFrame(rows, f"ticker string, Date date, {names}, created_at timestamp")


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def files(path):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_changes_are_told_apart(spark):
    before = bars(spark, ["SAME", "LONGER", "EDITED", "GONE"], first=5).unionByName(bars(spark, ["MOVED"], first=9))
    now = bars(spark, ["SAME", "EDITED"], first=5).unionByName(bars(spark, ["MOVED"], first=2)).unionByName(bars(spark, ["LONGER"], first=5, days=91))
    now = now.unionByName(bars(spark, ["NEW"]))
    now = now.withColumn("Close", F.when((F.col("ticker") == "EDITED") & (F.dayofmonth("Date") == 7), F.col("Close") + 1).otherwise(F.col("Close")))
    found = {r.ticker: r.change for r in changed_tickers(ticker_digests(before), ticker_digests(now)).collect()}
    assert found == {"LONGER": "changed", "EDITED": "changed", "GONE": "gone", "MOVED": "moved", "NEW": "new"}


def test_two_rows_that_swap_a_value_are_a_change(spark):
    one = bars(spark, ["A"])
    first, second = dt.date(2024, 1, 3), dt.date(2024, 1, 4)
    values = {r.Date: r.Close for r in one.collect()}
    swapped = F.when(F.col("Date") == first, F.lit(values[second])).when(F.col("Date") == second, F.lit(values[first])).otherwise(F.col("Close"))
    assert changed_tickers(ticker_digests(one), ticker_digests(one.withColumn("Close", swapped))).count() == 1


def test_only_touched_buckets_are_rewritten_and_stranded_labels_go(spark, tmp_path):
    path = str(tmp_path / "prices")
    names = [f"T{i}" for i in range(12)]
    before = bars(spark, names, first=20).unionByName(bars(spark, ["GONE"]))
    assert refresh_gold(spark, path, before, build_gold, buckets=8) is None
    old = files(f"{path}/gold")
    labels = {r.Date for r in read_buckets(spark, f"{path}/gold").where("ticker = 'T3' and period = '2W'").collect()}
    # an earlier first day moves the bins of T3
    now = bars(spark, [n for n in names if n != "T3"], first=20).unionByName(bars(spark, ["T3"], first=11))
    held = refresh_gold(spark, path, now, build_gold, buckets=8)
    assert 1 <= len(held) <= 2
    table = read_buckets(spark, f"{path}/gold")
    assert rows(table) == rows(build_gold(now))
    assert labels - {r.Date for r in table.where("ticker = 'T3' and period = '2W'").collect()}
    kept = {f: t for f, t in files(f"{path}/gold").items() if f in old}
    assert kept and all(old[f] == t for f, t in kept.items())
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in old if f not in kept} <= set(held)
    assert refresh_gold(spark, path, now, build_gold, buckets=8) == []


def test_a_lost_move_is_finished_by_the_next_call(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(40).withColumn("v", F.lit("old"))
    write_buckets(table, path, "id", 4)
    # buckets of a finished write that have not been moved yet
    write_buckets(table.where("id % 2 = 0").withColumn("v", F.lit("lost")).unionByName(table.where("id % 2 = 1")), path + tables.BESIDE, "id", 4)
    none = table.limit(0)
    assert replace_keys(spark, path, none, none, "id", 4) == []
    assert sorted((r.id, r.v) for r in read_buckets(spark, path).collect()) == [(i, "old" if i % 2 else "lost") for i in range(40)]
    replace_keys(spark, path, table.where("id = 3").withColumn("v", F.lit("new")), spark.createDataFrame([(3,), (4,)], "id long"), "id", 4)
    left = {r.id: r.v for r in read_buckets(spark, path).collect()}
    assert left[3] == "new" and 4 not in left and len(left) == 39


def test_a_paused_writer_does_not_overwrite(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    staged_update(spark, path, lambda _: spark.range(1))
    real, stale = tables._versions, [[], None]

    def paused(session, at):
        # the first look is from before another writer's whole update
        return stale.pop(0) if len(stale) > 1 else real(session, at)

    monkeypatch.setattr(tables, "_versions", paused)
    with pytest.raises(FileExistsError):
        staged_update(spark, path, lambda _: spark.range(2))
    assert tables.read_current(spark, path).count() == 1
    # its marker is gone, so the next writer goes on; what a lost writer left goes with it
    os.makedirs(f"{path}/version=00000002")
    staged_update(spark, path, lambda _: spark.range(3))
    assert tables.read_current(spark, path).count() == 3
    assert not os.path.exists(f"{path}/version=00000002")


def test_a_table_being_written_has_no_second_writer(spark, tmp_path):
    path = str(tmp_path / "t")

    def update(_):
        with pytest.raises(FileExistsError):
            staged_update(spark, path, lambda _: spark.range(9))
        return spark.range(1)

    staged_update(spark, path, update)
    assert tables.read_current(spark, path).count() == 1


def test_merge_keys_from_data():
    assert MergeKeys.from_mapping({}) == MergeKeys(("ticker", "period"), "Date", ("period",))
    by = MergeKeys.from_mapping({"series": "cik", "order": "created_at", "within": ()})
    assert by.keys == ("created_at", "cik") and by.within == ()
    for wrong in ({"series": []}, {"series": "a", "order": "a"}, {"within": ["x"]}, {"key": "a"}):
        with pytest.raises(ValueError):
            MergeKeys.from_mapping(wrong)


def test_merge_over_other_keys_reports_as_it_writes(spark):
    kind = "created_at int, cik long, part string, v int"
    old = spark.createDataFrame([(d, c, p, 0) for d in (1, 2, 3) for c in (1, 2, 3) for p in "ab"], kind)
    new = spark.createDataFrame([(1, 1, "a", 9), (3, 1, "a", 9), (4, 1, "a", 9), (2, 2, "b", 9)], kind)
    by = MergeKeys(("cik", "part"), "created_at", ("part",))
    merged, seen = observed_merge(old, new, "m", ["a", "b"], 1, by, "part")
    got = {(r.created_at, r.cik, r.part): r.v for r in merged.collect()}
    # part a: day 3 of cik 1 goes; part b: day 3 of cik 2
    want = {(r.created_at, r.cik, r.part): r.v for r in old.collect()}
    del want[3, 1, "a"], want[3, 2, "b"]
    want |= {(r.created_at, r.cik, r.part): r.v for r in new.collect()}
    assert got == want
    assert merge_counts(seen) == [("a", 1, 1, 2, 3), ("b", 1, 1, 0, 1)]
