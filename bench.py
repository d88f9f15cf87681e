"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default all),
``BENCH_RUNS`` (default 3, the median counts), ``BENCH_QUERIES`` (comma list).
Each query runs once unmeasured on the same data first. ``--sql`` also times the
SQL twins in DuckDB.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from assetweave.oracle import ORACLE
from assetweave.queries import QUERIES
from assetweave.session import session

HEADLINE = [
    "a15_asset_metrics",
    "a15_refresh_metadata",
    "a07_trailing_returns",
    "a09_beta",
    "a03_dedupe",
    "a11_describe",
    "a12_correlation",
    "k05_upsert",
    "p06_standardize_dates",
    "w03_sma",
    "w08_ema",
    "w18_basic_features",
    "w18_basic_features_blocked",
    "w19_advanced_features",
    "w19_advanced_features_blocked",
    "w20_enhanced_bars",
    "j04_asof_join",
    "m02_elbow",
    "m03_cluster_5",
    "m03_cluster_10",
    "m06_m07_train_and_score",
    "m08_attribution",
    "m08_attribution_all_rows",
    "m11_build_portfolio",
    "m14_signal",
    "t01_market_snapshots",
]


def seconds(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(runs)), 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if "--sql" in sys.argv:
        line["sql"] = sql_times(sf_dir, [n for n in names if n in ORACLE], runs, int(cpus))
    print(json.dumps(line))
    spark.stop()


def sql_times(sf_dir: str, names: list[str], runs: int, threads: int) -> dict[str, float]:
    import duckdb

    con = duckdb.connect(config={"threads": threads})
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{sf_dir}/{file}'")

    def run(name: str) -> None:
        con.execute(f"create or replace temp table result as {ORACLE[name]}")

    return {n: round(statistics.median(seconds(lambda: run(n)) for _ in range(runs)), 3) for n in names}


if __name__ == "__main__":
    main()
