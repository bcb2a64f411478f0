"""How often rows are laid out: exchanges and frames of the plans over bars folded from line items."""

import datetime as dt
import re

import pytest

from candlegrid.operators.upsert import merge_report, upsert
from workloads import derive
from workloads.queries import QUERIES

KEYS = ("Date", "ticker", "period")
PRICE = "Date date, ticker string, period string, Close double"


@pytest.fixture
def sf(spark, tmp_path):
    """Line items of 30 suppliers on 40 days, some with several trades of a day."""
    lines = [
        (i, i % 3, i % 30, 1.0 + i % 7, 100.0 + i % 11, 0.01 * (i % 5), 0.01 * (i % 8), dt.datetime(2001, 1, 1) + dt.timedelta(days=i * 7 % 40))
        for i in range(1_500)
    ]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp"
    spark.createDataFrame(lines, names).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def planned(df) -> str:
    """The plan with all nodes, before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def layouts(df) -> int:
    """Exchanges by keys that ran; one that is used again counts once."""
    df.collect()
    final = planned(df).split("\n+- == Initial Plan")[0]
    return len(re.findall(r"^[\s:+*-]*Exchange hashpartitioning", final, re.M))


def test_a_rank_of_the_merge_grows_row_by_row(spark):
    def frame(*rows):
        return spark.createDataFrame([(dt.date(2001, 1, d), t, "D", c) for d, t, c in rows], PRICE)

    old, new = frame((1, "A", 1.0), (2, "A", 2.0), (3, "A", 3.0), (3, "A", 3.5), (2, "B", 4.0)), frame((3, "A", 9.0), (4, "A", 9.5))
    for out in (upsert(old, new, KEYS, "delete_tail_merge"), merge_report(old, new)):
        plan = planned(out)
        assert not re.search(r"specifiedwindowframe\(\w+, currentrow\$\(\), unboundedfollowing", plan)
        assert plan.count("BroadcastExchange") == 1
    # both rows of the third day are the last two
    got = upsert(old, new, KEYS, "delete_tail_merge").collect()
    assert sorted((r["Date"].day, r["ticker"], r["Close"]) for r in got) == [(1, "A", 1.0), (2, "A", 2.0), (2, "B", 4.0), (3, "A", 9.0), (4, "A", 9.5)]


def test_bars_are_laid_out_once(spark, sf):
    assert layouts(derive.all_periods(spark, sf)) == 1


def test_sides_of_a_merge_share_their_exchanges(spark, sf):
    full = derive.all_periods(spark, sf).select(*KEYS, "Close")
    # one of the keys alone, one of all columns; the few days by day and by period
    assert layouts(upsert(full, full, KEYS, "delete_tail_merge")) == 4


def test_refreshed_gold_is_not_laid_out_again(spark, sf):
    at = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(at)
    spark.conf.set(at, "-1")
    try:
        plan = planned(QUERIES["gold_refreshed"](spark, sf))
    finally:
        spark.conf.set(at, kept)
    gold = plan[: plan.index("MapInArrow")]
    assert "SortMergeJoin" not in gold and "Exchange hashpartitioning" not in gold, gold
