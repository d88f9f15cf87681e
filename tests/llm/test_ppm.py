"""Prediction by partial matching against a plain version, over slices, buckets and parts of any size."""

import math

import numpy as np
import pytest

import brute
from assetweave.llm import ppm
from test_odd_rows import EXTRA, TEXTS

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def found(df):
    return sorted(((*r[:5], round(r[5], 5), round(r[6], 2)) for r in df.select(*COLUMNS).collect()), key=repr)


def exact(docs, depth=ppm.DEPTH):
    model = brute.Language(docs, depth)
    out = []
    for d, t in docs:
        n, known, base = model.base(t)
        out.append((d, brute.remainder(d, 7) == 2, n, known, model.n, round(base, 5), round(model.score(t), 2)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, None, "s", None, 0.5, 7, "a", "b", "c", 1, None, "d", 2) for d, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.mark.parametrize("depth", [3, 5, 6])
def test_odd_rows(odd, depth):
    assert found(ppm.log_probabilities(odd, hot_words=3, depth=depth)) == exact(TEXTS, depth)


def test_small_slices_buckets_and_parts(odd):
    """Several slices, several buckets, each of many parts: nothing else changes."""
    got = ppm.log_probabilities(odd.repartition(3), hot_words=0, slice_bytes=5000, bucket_bytes=20_000, part_keys=100)
    assert found(got) == exact(TEXTS)


def test_empty_table_and_no_training_texts(spark, odd):
    assert ppm.log_probabilities(odd.limit(0)).count() == 0
    held = next(d for d in range(1000) if brute.remainder(d, 7) == 2)
    got = ppm.log_probabilities(spark.createDataFrame([(held, "abc")], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)]
    assert got[0].score == pytest.approx(-4 * math.log10(257), abs=1e-5)


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found(ppm.op7_ppm_scores(spark, sf_dir)) == exact([tuple(r) for r in rows])


def test_long_texts_in_pieces():
    data = np.frombuffer(b"abracadabra" * 3 + b"xyz", np.uint8)
    offsets = np.array([0, 0, 11, 36])
    whole = list(ppm.keys_of(data, offsets, 5))
    pieces = list(ppm.keys_of(data, offsets, 5, piece=4))
    assert len(whole) == 1 and len(pieces) > 5
    for a, b in zip(whole[0], zip(*pieces)):
        assert (a == np.concatenate(b)).all()
    assert len(whole[0][0]) == 36 + 3


@pytest.mark.parametrize("depth", [3, 5])
def test_next_symbol_probabilities_sum_to_one(depth):
    text = b"abracadabra abrakadabra aber kadabra " * 3 + bytes(range(256))
    (key, _), = ppm.keys_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]), depth)
    key, n = ppm.merged([key], [np.ones(len(key), np.int64)])
    code, count = ppm.merged([key // 257 ** (depth - 1) * 257 + key % 257], [n])
    short = ppm.Short(code, count)
    # every symbol after every context seen, and after one that is not
    contexts = np.unique(np.append(key // 257, 97 * 257 ** (depth - 1) + 5))
    every = (contexts[:, None] * 257 + np.arange(257)).ravel()
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, key)] = n
    logs = ppm.log_probabilities_of(every, counts, short, depth)
    assert np.allclose((10.0 ** logs.reshape(-1, 257)).sum(axis=1), 1, atol=1e-9)


def test_packed_arrays():
    for values in ([], [5], [0, 1, 1 << 48, (1 << 49) - 1], [7, 7, 3, 0]):
        assert ppm.unpack(ppm.pack(np.array(values, np.int64))).tolist() == values


def test_longer_contexts_and_more_texts_predict_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

    def bits(df, depth):
        rows = ppm.log_probabilities(df.select("doc_id", "text"), depth=depth).where("held_out").select("doc_id", "score")
        r = rows.join(docs.select("doc_id", "text"), "doc_id").selectExpr("-sum(score) / sum(octet_length(text) + 1) as b").first()
        return r.b / math.log10(2)

    five, three = bits(docs, 5), bits(docs, 3)
    few = bits(docs.where("doc_id % 4 = 0"), 5)
    assert five < 2.4 and five < three and five < few
