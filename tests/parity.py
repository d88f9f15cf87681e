"""Compare registered queries with their SQL twins: ``python tests/parity.py <sf dir> [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(plain(row[i])) for i in order) for row in rows))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    """Whether both engines agree, with a note on the difference."""
    from assetweave.oracle import ORACLE
    from assetweave.queries import QUERIES

    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_time = time.time() - start
    if name not in ORACLE:
        return bool(rows), f"rows only: {len(rows)} ({spark_time:.1f}s)"
    start = time.time()
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    note = f"{len(rows)} rows ({spark_time:.1f}s, sql {time.time() - start:.1f}s)"
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    ours, theirs = canonical(df.columns, rows), canonical(columns, expected)
    if ours == theirs:
        return True, note
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return False, f"{note}; {len(ours)} / {len(theirs)} rows, {len(different)} differ, first {different[:2]}"


def main(sf_dir: str, names: list[str]) -> int:
    from assetweave.queries import QUERIES
    from assetweave.session import session

    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "20g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = session("parity", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names or QUERIES:
        try:
            good, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failures += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
