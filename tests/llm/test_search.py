"""Op 11: shared term sets, and rankings against a plain version."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from assetweave.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [] if text is None else TERM.findall(brute.lower(text))


def ranking(docs, items, k=20):
    """(item_id, rank, doc_id, score), item by item and document by document."""
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, length = len(found), sum(n for _, _, n in found)
    df = Counter(w for _, c, _ in found for w in c)
    out = []
    for item_id, text in items:
        scored = []
        for d, c, n in found:
            m = 75 + 25 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 12 * m))
                for w in terms(text)
                if w in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


DOCS = [(i, " ".join(f"w{(i * j) % 17}" for j in range(1, 4 + i % 9))) for i in range(60)]
DOCS += [(5, DOCS[5][1]), (None, "w1 w2 W3"), (None, None), (100, None), (101, ""), (102, "w1, w1; w2"), (103, "w2 w1-w1")]
DOCS += [(104, "é É ß w1 " * 30), (105, "w9 " * 5000)]
ITEMS = [(1, "w1 w2 w3"), (2, "W1 w2 w3 w4 w4"), (2, "w1 w2"), (None, "w1 w2 w3 w16"), (3, None), (4, ""), (5, "unknown"), (6, "w9 É")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in DOCS], "doc_id long, text string, n int, terms string")
    items = spark.createDataFrame([(i, t, 2) for i, t in ITEMS], "item_id long, text string, row int")
    return docs.repartition(5), items


@pytest.mark.parametrize("k", [1, 3, 20])
def test_ranking(tables, k):
    docs, items = tables
    assert rows(search.ranked(docs, items, k)) == ranking(DOCS, ITEMS, k)


def test_small_blocks_and_batches_change_nothing(tables, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 1)
    docs, items = tables
    assert rows(search.ranked(docs, items, block_bytes=8)) == ranking(DOCS, ITEMS)


def test_empty_tables(tables):
    docs, items = tables
    assert search.ranked(docs.limit(0), items).count() == 0
    assert search.ranked(docs, items.limit(0)).count() == 0
    assert search.ranked(docs.limit(0), items).dtypes == search.ranked(docs, items).dtypes


def test_large_ids_beside_nulls_stay_exact(spark, tables):
    big = 2**53 + 1
    items = spark.createDataFrame([(big, "w1"), (None, "w2")], "item_id long, text string")
    assert {r.item_id for r in search.ranked(tables[0], items).collect()} == {big, None}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 11), max_size=14), max_size=12), st.integers(1, 20))
def test_graph_adds_up(items, paired):
    graph = search.SharedTerms(items, 12, paired)
    values = np.random.default_rng(3).integers(0, 1000, (12, 4))
    expected = np.array([values[item].sum(axis=0) for item in items]).reshape(len(items), 4)
    assert (graph.scores(values) == expected).all()
    assert graph.additions() <= sum(max(len(item) - 1, 0) for item in items)


def test_shared_sets_are_added_once():
    shared = list(range(10))
    items = [[*shared, 10 + i] for i in range(8)]
    graph = search.SharedTerms(items, 18)
    assert graph.additions() == 9 + 8  # the shared set, then one more term each


def test_benchmark_items_share(spark, sf_dir):
    block = next(search.blocks(spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")))
    direct = sum(len(terms(r.text)) - 1 for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect())
    assert block.graph.additions() < 0.9 * direct
