"""Near duplicates are decided row by row, whatever the ids."""

import random
import time

import numpy as np
import pyarrow as pa

from assetweave.llm import ngram_join


def text(seed, n=60):
    words = random.Random(seed)
    return " ".join(f"w{words.randrange(10**6)}" for _ in range(n))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.without_near_duplicates(docs)
    assert out.schema == docs.schema
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_different_texts_without_an_id_all_stay(spark):
    rows = [(None, text(i)) for i in range(6)] + [(1, text(50)), (2, text(51))]
    assert kept(spark, rows) == sorted(rows, key=repr)


def test_a_copy_without_an_id_does_not_come_back(spark):
    copied = text(0)
    near = copied + " w1"
    rows = [(1, copied), (None, copied), (None, near), (None, text(1)), (None, text(2))]
    assert kept(spark, rows) == sorted([rows[0], rows[3], rows[4]], key=repr)


def test_copies_without_any_id_leave_one(spark):
    rows = [(None, text(0))] * 5 + [(None, text(1)), (None, text(1) + " w1"), (None, text(2))]
    got = kept(spark, rows)
    assert len(got) == 3 and len(set(got)) == 3
    assert (None, text(0)) in got and (None, text(2)) in got


def test_one_id_with_different_texts(spark):
    rows = [(7, text(0)), (7, text(1)), (7, text(1)), (3, text(0)), (9, text(0) + " w1"), (9, text(3))]
    assert kept(spark, rows) == sorted([(3, text(0)), (7, text(1)), (9, text(3))], key=repr)


def test_rows_without_words_stay(spark):
    rows = [(None, None), (None, ""), (None, " "), (4, ""), (4, text(0)), (4, text(0)), (5, text(0))]
    assert kept(spark, rows) == sorted(rows[:5], key=repr)


def test_without_any_broadcast(spark):
    rows = [(None, text(i)) for i in range(4)] + [(1, text(0)), (2, text(9)), (2, text(9))]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert kept(spark, rows) == sorted([*rows[1:4], rows[4], rows[5]], key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_many_members_of_a_group_without_links():
    """Sets of 30 tokens that share only one are told apart by their tokens, not one by one."""
    rng = np.random.default_rng(1)
    sets = [np.unique(np.append(rng.integers(2, 1 << 60, 29, dtype=np.uint64), np.uint64(1))) for _ in range(16_000)]
    # pairs of near copies among them, and what each shares with another one
    sets += [np.append(s[:-1], s[-1] + np.uint64(1)) for s in sets[:50]]
    sets += [s[: len(s) // 2] for s in sets[50:16_000]]
    rows = [{"class": i, "g": 1, "sub": 0, "tokens": s.tobytes()} for i, s in enumerate(sets)]
    begin = time.perf_counter()
    (found,) = ngram_join._search_groups(80)(iter([pa.RecordBatch.from_pylist(rows)]))
    assert time.perf_counter() - begin < 20
    group = dict(zip(found["class"].to_pylist(), found["group"].to_pylist()))
    assert all(group[16_000 + i] == i for i in range(50)) and len(set(group.values())) == len(sets) - 50
