"""Every asset has a row for every market quarter-hour, also when the job stops and goes on."""

import datetime as dt
import random

import pytest

from assetweave.streaming import quotes as stream
from assetweave.streaming.market_clock import every_interval

SCHEMA = "event_id long, event_type string, ts timestamp, value double"
QUARTER = dt.timedelta(minutes=15)


def at(hour, minute, day=2):
    return dt.datetime(2024, 1, day, hour, minute)  # UTC; New York is five hours behind


def plain(quotes, lateness):
    """(start, asset, price, n) for every interval that has ended before the watermark."""
    quotes = [q for q in quotes if is_open(q[2])]
    watermark = max(q[2] for q in quotes) - lateness
    out = []
    for asset in sorted({q[1] for q in quotes}):
        own = [q for q in quotes if q[1] == asset]
        start = min(q[2] for q in own)
        start -= dt.timedelta(minutes=start.minute % 15, seconds=start.second)
        while start + QUARTER <= watermark:
            if is_open(start):
                some = sorted((ts, i, price) for i, _, ts, price in own if start <= ts < start + QUARTER)
                out.append((start, asset, some[-1][2] if some else None, len(some)))
            start += QUARTER
    return sorted(out, key=repr)


def is_open(ts):
    local = ts - dt.timedelta(hours=5)
    return local.weekday() < 5 and 570 <= local.hour * 60 + local.minute < 960


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, landed, out, checkpoint, lateness="1 hour"):
    quotes = stream.as_quotes(stream.stream_table(spark, landed, SCHEMA, files_per_batch=1))
    feed = stream.quotes_once(stream.during_market(quotes), lateness)
    stream.append_to(every_interval(feed), out, checkpoint).awaitTermination()


def rows(spark, out):
    return sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=repr)


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("landed", "out", "checkpoint")]


def batches(seed=1):
    rng, parts, n = random.Random(seed), [], 0
    for day in (2, 3, 4, 5, 8):
        part = []
        for _ in range(14):
            n += 1
            asset = rng.choice(["busy", "busy", "busy", "b", "c"])
            part.append((n, asset, at(rng.randrange(13, 23), rng.randrange(60), day), rng.choice([1.0, 2.5, None])))
        parts.append(part)
    parts[1].append((500, "late starter", at(16, 7, 3), 9.0))  # seen once, silent ever after
    return parts


def test_silent_intervals_and_restart(spark, paths, tmp_path):
    landed, out, checkpoint = paths
    parts = batches()
    for part in parts[:2]:
        land(spark, landed, part + part[:3])  # delivered twice
    run(spark, landed, out, checkpoint)
    half = rows(spark, out)
    for part in parts[2:]:
        land(spark, landed, part)
    run(spark, landed, out, checkpoint)
    everything = [q for part in parts for q in part]
    expected = plain(everything, dt.timedelta(hours=1))
    assert rows(spark, out) == expected
    assert 0 < len(half) < len(expected)
    assert sum(r[1] == "late starter" and r[2] is None for r in expected) > 60
    # in one go
    run(spark, landed, str(tmp_path / "out2"), str(tmp_path / "checkpoint2"))
    assert rows(spark, str(tmp_path / "out2")) == expected


def test_an_earlier_quote_before_the_first_row_moves_the_start(spark, paths):
    landed, out, checkpoint = paths
    parts = [[(1, "a", at(17, 40), 1.0)], [(2, "a", at(17, 1), 2.0)], [(3, "a", at(20, 30), 3.0)]]
    for part in parts:
        land(spark, landed, part)
    run(spark, landed, out, checkpoint, "2 hours")
    assert rows(spark, out) == plain([q for p in parts for q in p], dt.timedelta(hours=2))
    assert rows(spark, out)[0][0] == at(17, 0)
