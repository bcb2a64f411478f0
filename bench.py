"""Times the headline queries; prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores.

Each query is run once on the smallest tables first, so that none pays for the start of another; queries under
`REPEAT_UNDER` seconds are timed three times and their median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candlegrid.operators.clean import clean_bars  # noqa: E402
from candlegrid.operators.upsert import PRICE_KEYS, upsert  # noqa: E402
from candlegrid.plans.gold import build_gold  # noqa: E402
from candlegrid.session import build_session  # noqa: E402
from candlegrid.sinks.tables import staged_update  # noqa: E402
from workloads import derive  # noqa: E402
from workloads.queries import QUERIES  # noqa: E402

REPEAT_UNDER = 6.0

HEADLINE = (
    "clean_bars",
    "clean_report",
    "resample_w",
    "resample_3me",
    "resample_keep_empty",
    "adx",
    "sides",
    "gold",
    "asof_w",
    "entry_conclusion",
    "export_conclusion",
    "fundamentals_normalize",
    "screen",
    "price_ratios",
    "upsert_symbols",
    "upsert_fundamentals",
    "upsert_prices_keep_old",
    "merge_prices",
    "merge_report",
    "ingest_outcome",
    "stored_gold",
)


def stored_gold(spark, sf_dir: str) -> None:
    """End to end: the gold table is built and merged twice into a stored table, old rows kept."""
    with tempfile.TemporaryDirectory() as folder:
        for _ in range(2):
            gold = build_gold(clean_bars(derive.bars(spark, sf_dir)))
            merge = lambda old, new: upsert(old, new, PRICE_KEYS, "keep_old", tail_keys=("ticker", "period"))
            staged_update(spark, f"{folder}/prices", merge, ["period"], batch=gold, sort_by=("ticker", "Date"))


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    if name == "stored_gold":
        stored_gold(spark, sf_dir)
    else:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=cpus,
        # the tables are small: let them spread over the cores nevertheless
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        run(spark, name, small if os.path.isdir(small) else sf_dir)
        took = [run(spark, name, sf_dir)]
        if took[0] < REPEAT_UNDER:
            took += [run(spark, name, sf_dir) for _ in range(2)]
        seconds[name] = round(statistics.median(took), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )


if __name__ == "__main__":
    main()
