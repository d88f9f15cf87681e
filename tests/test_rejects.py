"""Lines that don't fit a schema are kept with their reason, and those that do are read as ever."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from assetweave.sources.rejects import audit, read_csv_checked

LINES = [
    "a,2020-01-01,1.5",
    'b,2020-01-02,"2"',
    "c,,",
    "d,2020-13-01,1.0",
    "e,2020-01-03,abc",
    "f,2020-01-03",
    "g,2020-01-03,1.0,more",
    '"x,y",2020-01-04,3.0',
    '"x,y",2020-01-04,broken',
]


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "one.csv").write_text("\n".join(["asset,dt,close", *LINES[:5]]) + "\n")
    (folder / "two.csv").write_text("\n".join(["asset,dt,close", *LINES[5:]]) + "\n")
    schema = T.StructType(
        [T.StructField("asset", T.StringType()), T.StructField("dt", T.DateType()), T.StructField("close", T.DoubleType())]
    )
    return read_csv_checked(spark, str(folder), schema)


def test_rows_that_fit(read):
    got = sorted(tuple(r) for r in read.rows.collect() if r.dt)
    assert got == [("a", dt.date(2020, 1, 1), 1.5), ("b", dt.date(2020, 1, 2), 2.0), ("x,y", dt.date(2020, 1, 4), 3.0)]
    assert [tuple(r) for r in read.rows.collect() if not r.dt] == [("c", None, None)]


def test_rejects_have_file_line_and_reason(read):
    got = sorted((r.line, r.reason, r.file.split("/")[-1]) for r in read.rejects.collect())
    assert got == sorted(
        [
            (LINES[3], "not a date: dt", "one.csv"),
            (LINES[4], "not a double: close", "one.csv"),
            (LINES[5], "fields: 2", "two.csv"),
            (LINES[6], "fields: 4", "two.csv"),
            (LINES[8], "not a double: close", "two.csv"),
        ]
    )


def test_audit_adds_up(read):
    counts = {r.reason: r.n for r in audit(read).collect()}
    assert counts["ok"] == 4 and sum(counts.values()) == len(LINES)
    assert counts["not a double: close"] == 2
