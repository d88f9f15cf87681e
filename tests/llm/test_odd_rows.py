"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import uuid
import zlib

import pyarrow as pa
import pytest

import brute
from assetweave.llm import ann, decontam, licenses, ngram_join, packing, quality, secrets, token_counts, wavelet
from test_queries import check_packing

LONG = "alpha beta gamma delta " * 4000 + "token = deadbeefdeadbeef99 end"
SIX = "one two three four five six seven eight nine ten eleven twelve"
KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\r "),
    (4, "x"),
    (5, "Two words"),
    (6, LONG),
    (7, SIX),
    (8, SIX.upper()),
    (8, SIX.upper()),  # a repeated row
    (9, SIX + " thirteen"),
    (9, "another text with the same id, " + SIX),
    (None, SIX),
    (None, "a text without an id, not like the others at all"),
    (10, f"password = {KEY} AKIA{'B7' * 8} {KEY} api_key:short"),
    (11, "café ÀÉ ß 日本語 テキスト 🙂 ſecret: notakeyword K"),
    (12, "\x00\x01 control\x1fcharacters     and <|endoftext|> marks"),
    (-13, "!!!! |||| ....\n\n\n\n" + "Line line line\n" * 50),
]
EXTRA = "score double, n_words long, spans string, items string, class string, part int, query string, kept_id string, rank int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, None, "s", None, 0.5, 7, "a", "b", "c", 1, None, "d", 2) for d, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(100, SIX, 1), (100, SIX, 1), (101, None, 1), (102, ""), (103, "Two WORDS!", 2), (None, "beta gamma", 3)]
    rows = [(r[0], r[1], 0) for r in rows]
    return spark.createDataFrame(rows, "item_id long, text string, n_words int")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(7, 1, None), (7, 0, 1), (4, 1, 0), (-13, 0, 0), (5, None, 0), (None, 1, 1), (6, 1, 0), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


def test_secrets(odd, empty):
    got = rows_of(secrets.secret_spans(odd), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == sorted(((d, *brute.secrets(t)) for d, t in TEXTS), key=repr)
    assert secrets.secret_spans(empty).count() == 0
    clean = {r.doc_id: r for r in secrets.redacted(odd).collect()}
    assert clean[10].text == "[SECRET] [SECRET] [SECRET] api_key:short" and clean[10].n_chars == len(clean[10].text)
    assert clean[1].text is None and clean[6].text.endswith("delta [SECRET] end") and clean[4].n_chars is None
    assert secrets.redacted(odd).schema == odd.schema


def test_novel_strings_only_count_near_sensitive_words(spark):
    value = "Zx81QmPv07LtRw35KdHy92"
    rows = [(1, f"the credential was {value} yesterday"), (2, f"the bird was {value} yesterday")]
    rows.append((3, "the credential was aaaaaaaa1aaaaaaaa1aaaaaaaa1 yesterday aaaaaaaa1aaaaaaaa1aaaaaaaa1"))
    got = dict(rows_of(secrets.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "spans"))
    start = rows[0][1].index(value)
    assert got == {1: f"novel:{start}:{start + len(value)}", 2: "", 3: ""}


def test_common_identifiers_are_not_novel(spark):
    name = "customer_session_lookup_table_v2"
    rows = [(i, f"row {i} of {name} here") for i in range(40)] + [(99, f"the credential was {name} yesterday")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert secrets.identifier_dictionary(docs) == name.encode() + b" "
    assert {r.spans for r in secrets.secret_spans(docs).collect()} == {""}


def test_neighbours(spark, odd):
    nan, inf = float("nan"), float("inf")
    vectors = [(20 * i, [float(i % 7), 1.0, float(i)], i) for i in range(1, 30)]
    vectors += [(1, None, 0), (2, [0.0, 0.0, 0.0], 0), (3, [nan, 1.0, 1.0], 0), (4, [inf, 1.0, 1.0], 0), (5, [None, 1.0, 1.0], 0)]
    vectors += [(6, [1.0], 0), (7, [], 0), (None, [1.0, 2.0, 3.0], 0), (40, [2.0, 1.0, 2.0], 0), (41, [2.0, 1.0, 2.0], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, rank int")
    exact = brute.neighbours([(v, e) for v, e, _ in vectors])
    found = [(vectors[i][0], r, v, s) for i, best in exact.items() for r, (v, s) in enumerate(best, 1)]
    got = rows_of(ann.neighbours(df, recall=1.0), "query_id", "rank", "vec_id", "score")
    assert got == sorted(found, key=repr)
    few = ann.neighbours(df.where("vec_id in (20, 21, 40, 60)"))
    assert rows_of(few, "query_id", "rank").count((20, 3)) == 1 and few.count() == 12
    assert ann.neighbours(df.limit(0)).count() == 0 and ann.neighbours(df.where("vec_id = 20")).count() == 0


def test_leaves_are_cut_and_ties_stay(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 50)
    vectors = [(i, [1.0, 2.0]) for i in range(300)]  # all alike: one leaf
    got = ann.neighbours(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    best = {}
    for r in got.collect():
        best.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    for q, found in best.items():
        assert [v for _, v in sorted(found)] == [v for v in range(22) if v != q][:20]
    assert len(best) == 15


def test_licenses(spark, odd, empty, tmp_path):
    import duckdb

    from parity import canonical

    texts = [
        "MIT license MIT License general public license",
        'Licensed under the Apache License, Version 2.0 (the "License"). SPDX-License-Identifier: GPL-3.0-or-later',
        "Released under the terms of the GNU Lesser General Public License v2.1. CC-BY-SA 4.0. All rights reserved",
        "MKT license mit licenſe LICENİSE gnu general public license version 2 mit LICENSEé",
        "permission is hereby granted, free of charge, to any person obtaining a copy under the mit license " * 40,
    ]
    more = spark.createDataFrame([(50 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionAll(more)
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    cursor = con.execute(licenses.oracle())
    got = licenses.license_labels(docs)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(names, cursor.fetchall())
    labels = {r.doc_id: r.labels for r in got.where("doc_id >= 50").collect()}
    assert labels[51] == "apache,apache-2.0,gpl-3.0" and labels[52] == "cc-by-sa,gpl,lgpl-2.1,proprietary"
    assert licenses.license_labels(odd).count() == len(TEXTS) and licenses.license_labels(empty).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_every_license_match_holds_a_gate_word():
    import re
    import warnings

    from hypothesis import strategies as st

    from assetweave.llm.license_rules import GATE, REACH, rules

    for rule in rules()[::7]:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            text = st.from_regex(re.compile(rule.pattern.replace(".{1,60}?", "x"), re.ASCII), fullmatch=True).example()
        words = text.split()
        assert words[0] == rule.keyword and {*words} & {*GATE} and len(words) <= REACH, (rule, text)


def test_near_duplicates(odd, empty):
    got = rows_of(ngram_join.near_duplicates(odd))
    assert got == sorted(brute.near_duplicates(TEXTS), key=repr)
    assert ngram_join.near_duplicates(empty).count() == 0
    kept = ngram_join.without_near_duplicates(odd)
    assert kept.schema == odd.schema
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and {1, 2, 3, 4, 5, 6, 7, 10, 11, 12, -13} <= {*ids}


def test_near_duplicates_at_the_limit(spark, monkeypatch):
    """Chains, sets just at and below the limit, and groups cut into parts."""
    import random

    random.seed(5)
    docs, base = [], [f"w{i}" for i in range(400)]
    for i in range(120):
        words = list(base if i % 3 else base[: random.randint(5, 60)])
        for _ in range(random.choice([0, 1, 2, 4, 7, 9, 10, 12, 20])):
            words[random.randrange(len(words))] = f"v{random.randint(0, 40)}"
        docs.append((i, " ".join(words)))
    words = [f"c{i}" for i in range(204)]
    for i in range(60):  # a chain: only neighbours are linked
        docs.append((200 + i, " ".join(words[3 * i : 3 * i + 24])))
    exact = sorted(brute.near_duplicates(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(rows_of(ngram_join.near_duplicates(df))) == exact
    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", 2000)
    assert sorted(rows_of(ngram_join.near_duplicates(df))) == exact


def test_contamination(spark, odd, empty, items):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    known = [(r.item_id, r.text) for r in items.collect()]
    exact = sorted(brute.contamination(TEXTS, known), key=repr)
    assert rows_of(decontam.contamination(odd, items), *columns) == exact
    blocks = decontam.find_passages(odd.select("doc_id", "text"), items, block_bytes=20)
    assert rows_of(blocks.selectExpr("doc_id", "n_words", "size(items)")) == sorted(((r[0], r[1], r[3]) for r in exact), key=repr)
    assert decontam.contamination(empty, items).count() == 0
    nothing = decontam.contamination(odd, items.limit(0))
    assert nothing.where("contaminated").count() == 0 and nothing.count() == len(TEXTS)
    kept = decontam.without_contaminated(odd, items)
    assert kept.schema == odd.schema and kept.count() == sum(not r[-1] for r in exact)


def test_quality(odd, empty, labels):
    got = quality.quality_scores(odd, labels)
    assert got.count() == len(TEXTS) and got.where("score between 0 and 1").count() == len(TEXTS)
    one = {r.doc_id: r.score for r in got.collect()}
    assert one[1] == one[2]  # null is empty
    assert quality.quality_scores(empty, labels).count() == 0
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.good_documents(odd, labels).schema == odd.schema


def test_scores_do_not_see_ids(spark, odd, labels):
    """The same text has the same score under any doc_id, and held-out labels change nothing."""
    import pyspark.sql.functions as F

    held = labels.where(quality.held_out(F.col("doc_id")))
    chain = quality.fit_quality(odd, labels)
    again = quality.fit_quality(odd, labels.join(held, "doc_id", "left_anti"))
    assert (chain.weights == again.weights).all()


def test_token_counts(odd, empty):
    import pyarrow as pa
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_counts.vocabulary(token_counts.default_model())
    unigram = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    unigram.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = rows_of(token_counts.token_counts(odd), "doc_id", "n_tokens")
    assert got == sorted(((d, len(unigram.encode(t or "").ids)) for d, t in TEXTS), key=repr)
    assert token_counts.token_counts(empty).count() == 0
    more = ["  a  b ", "▁x ▁", "▁", "́x", "<s> <0x41>", "日本 語🙂🙂"]
    n, _ = token_counts.word_counts(token_counts.default_model()).column(pa.array(more))
    assert n.tolist() == [len(unigram.encode(t).ids) for t in more]


def test_unigram_ties_take_the_earliest_start():
    viterbi = token_counts.Viterbi([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("ba", -2.0)])
    assert viterbi.count("aba") == (1, -3.0) and viterbi.count("ab") == (1, -2.0)
    assert viterbi.count("xx") == (2, -26.0)


def test_packing(odd, empty):
    rows = [r.asDict() for r in packing.packed_digest(odd.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()]
    kept = [(r.doc_id, r.text) for r in odd.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    check_packing(rows, kept)
    everything = packing.packed_digest(odd)
    total = sum(len(brute.ids(t, 2)) for _, t in TEXTS)
    assert everything.groupBy().sum("length").first()[0] == total
    assert everything.select("sequence_id", "offset").distinct().count() == everything.count()
    assert packing.packed_digest(empty).count() == 0


def test_packed_pieces_keep_their_ids(odd):
    rows = packing.pack(packing.pieces(odd.where("doc_id = 6"), size=100), size=100).orderBy("start").collect()
    assert b"".join(bytes(r.ids) for r in rows) == brute.ids(LONG, 2).tobytes()


def test_patterns_hold_every_piece():
    import random

    random.seed(3)
    histogram = {random.randint(1, 4096): random.randint(1, 5000) for _ in range(400)}
    patterns = packing.pack_histogram(histogram)
    placed = {}
    for count, lengths in patterns:
        assert sum(lengths) <= 4096
        for n in lengths:
            placed[n] = placed.get(n, 0) + count
    assert placed == histogram


def test_token_shards(spark, odd, empty, tmp_path):
    wavelet.write_shards(odd, str(tmp_path / "a"), shard=100)
    got = rows_of(wavelet.read_documents(spark, str(tmp_path / "a")))
    order = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode()))
    at, exact = 0, []
    for d, t in order:
        tokens = brute.ids(t, 1)
        exact.append((d, at, len(tokens), zlib.crc32(tokens)))
        at += len(tokens)
    assert got == sorted(exact, key=repr)
    wavelet.write_shards(empty, str(tmp_path / "b"))
    assert wavelet.read_documents(spark, str(tmp_path / "b")).count() == 0


def test_wavelet_matrix():
    import numpy as np

    random = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 5000):
        values = random.integers(0, 40, n).astype(np.uint16) * 1200
        matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values).to_bytes())
        assert (matrix.decode() == values).all()
        for value in {*values[:5].tolist(), 7, 1200}:
            places = np.flatnonzero(values == value)
            assert matrix.count(value) == len(places)
            assert [matrix.select(value, k) for k in range(min(4, len(places)))] == places[:4].tolist()
            assert matrix.rank(value, n // 2) == (values[: n // 2] == value).sum()
        for i in range(0, n, 97):
            assert matrix.access(i) == values[i]
        if n:
            ends = random.integers(0, n + 1, 20)
            some = values[random.integers(0, n, 20)].astype(np.int64)
            assert matrix.rank_many(some, ends).tolist() == [matrix.rank(int(v), int(e)) for v, e in zip(some, ends)]
            assert matrix.access_many(np.arange(n)).tolist() == values.tolist()


def test_index_finds_what_a_scan_finds():
    import numpy as np

    random = np.random.default_rng(2)
    sequence = random.integers(1, 4, 500)
    index = decontam.FMIndex(sequence, sample=8)
    patterns = [sequence[i : i + n] for i, n in ((0, 3), (10, 5), (490, 10), (499, 1))] + [np.array([3] * 9), np.array([9])]
    width = max(map(len, patterns))
    table = np.zeros((len(patterns), width), np.int64)
    for row, p in zip(table, patterns):
        row[width - len(p) :] = p
    low, high = index.search(table, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high):
        places = [i for i in range(len(sequence) - len(p) + 1) if (sequence[i : i + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_components(spark):
    from assetweave.llm.graph import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (200, 3)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_token_ids_are_the_librarys():
    import pyarrow as pa

    from assetweave.llm.token_ids import TokenIds, default_tokenizer

    texts = ["It's a dog's (life), isn't it? x.'s '' 'tis we'LL'dx !!'s", "a—,b ….  x y ＡＢ，日本語", "ΣΑΣ, Σ İSTANBUL"]
    texts += ["24be64ab: x=5;y<|endoftext|> ok", "a" * 3000, "x́!y ≠ é,a ÷a,× ÀÉ!É?ß,œ.Œ", *[t for _, t in TEXTS]]
    encoder = TokenIds(default_tokenizer(), most=30)
    for _ in range(2):
        ids, offsets = encoder.encode(pa.array(texts))
        for text, a, b in zip(texts, offsets, offsets[1:]):
            assert ids[a:b].tolist() == brute.tokenizer().encode(text or "", add_special_tokens=False).ids


def test_large_item_ids_beside_null_ids(spark):
    big = 2**53 + 1
    docs = spark.createDataFrame([(1, SIX), (2, "beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(big, SIX), (big - 1, SIX), (None, "beta gamma")], "item_id long, text string")
    got = sorted(tuple(r) for r in decontam.contamination(docs, items).collect())
    assert got == sorted(brute.contamination([(1, SIX), (2, "beta gamma")], [(big, SIX), (big - 1, SIX), (None, "beta gamma")]))


def test_packing_encodes_in_small_steps(monkeypatch):
    """A batch of many texts isn't encoded at once: the arrays of a step take many times its text."""
    seen, encode = [], packing.token_ids.__wrapped__.__globals__["TokenIds"].encode

    def counted(self, column):
        seen.append(sum(len(t) for t in column.to_pylist()))
        return encode(self, column)

    monkeypatch.setattr("assetweave.llm.token_ids.TokenIds.encode", counted)
    batch = pa.record_batch([pa.array(range(30)), pa.array(["some words " * 10_000] * 30)], ["doc_id", "text"])
    out = list(packing._cut(packing.default_tokenizer(), 2, 4096)(iter([batch])))
    assert sum(seen) == 30 * 110_000 and max(seen) <= 1 << 20
    assert {i for b in out for i in b.column(0).to_pylist()} == set(range(30))


def test_packing_reads_every_text_once(spark, tmp_path):
    """Cutting the ranges takes a pass over the pieces before they are ranked; texts aren't encoded for both."""
    folder = str(tmp_path)

    def noted(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                open(f"{folder}/{i}-{uuid.uuid4().hex}", "w").close()
            yield batch

    docs = spark.createDataFrame([(i, "some words " * (i + 1)) for i in range(20)], "doc_id long, text string")
    rows = packing.packed_digest(docs.repartition(4).mapInArrow(noted, docs.schema)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(20))
    assert sorted(int(f.name.split("-")[0]) for f in tmp_path.iterdir()) == list(range(20))
