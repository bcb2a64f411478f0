"""Registered queries against their SQL on the smallest driver tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scripts.check_oracles import canonical

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

# one of each family; scripts/check_oracles.py runs them all
CHECKED = (
    "clean_bars", "resample_2w", "resample_keep_empty", "adx", "sma", "sides", "asof_3w", "entry_conclusion",
    "screen", "price_ratios", "upsert_symbols", "upsert_prices_keep_old", "merge_report", "ingest_outcome",
)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, con, name):
    got = canonical(queries()[name](spark, SF).toPandas())
    want = canonical(con.execute(oracle_sql()[name]).df())
    assert got.shape == want.shape and got.equals(want)


def test_entry_runs(spark):
    assert len(entry(spark).columns) == 29


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
