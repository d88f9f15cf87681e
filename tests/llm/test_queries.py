"""Registered queries on the small tables against plain versions."""

import re
import zlib

import pytest

import brute
from assetweave.llm.queries import ORACLE, QUERIES

NAMES = {int(name[2:].split("_")[0]): name for name in QUERIES}


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    held = {}

    def get(n):
        if n not in held:
            held[n] = [r.asDict() for r in QUERIES[NAMES[n]](spark, sf_dir).collect()]
        return held[n]

    return get


def test_one_query_for_each_operator():
    assert sorted(NAMES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_secrets(result, docs):
    got = {r["doc_id"]: r for r in result(1)}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        r = got[doc_id]
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == brute.secrets(text)
        assert {*brute.base_spans(text)} <= {*r["spans"].split(",")} - {""}


def test_neighbours(spark, sf_dir, result):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    exact = brute.neighbours([(r.vec_id, r.embedding) for r in rows])
    by_query = {}
    for r in sorted(result(2), key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append(r)
    hits = 0
    for i, best in exact.items():
        found = by_query[rows[i].vec_id]
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hits += len({r["vec_id"] for r in found} & {v for v, _ in best})
    assert len(by_query) == len(exact)
    assert hits >= 0.9 * 20 * len(exact)


@pytest.mark.parametrize("n", [int(name[2:].split("_")[0]) for name in ORACLE])
def test_agrees_with_sql(spark, sf_dir, result, n):
    from parity import canonical, connect

    cursor = connect(sf_dir).execute(ORACLE[NAMES[n]])
    columns = [d[0] for d in cursor.description]
    rows = result(n)
    names = list(rows[0])
    assert sorted(names) == sorted(columns)
    assert canonical(names, [tuple(r.values()) for r in rows]) == canonical(columns, cursor.fetchall())


def test_near_duplicates(result, docs):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in result(4))
    assert got == sorted(brute.near_duplicates(docs))


def test_contamination(spark, sf_dir, result, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted(tuple(r[c] for c in columns) for r in result(5))
    assert got == sorted(brute.contamination(docs, items))


def test_quality_on_held_out_documents(spark, sf_dir, result):
    got = {r["doc_id"]: r for r in result(6)}
    assert all(r["held_out"] == (brute.remainder(d, 4) == 2) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    test = [r for r in labels if got[r.doc_id]["held_out"]]
    assert sum(got[r.doc_id]["predicted"] == r.quality for r in test) >= 0.95 * len(test)


def test_log_probabilities(result, docs):
    model = brute.Language(docs)
    got = {r["doc_id"]: r for r in result(7)}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        r = got[doc_id]
        n, known, base = model.base(text)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, model.n)
        assert r["held_out"] == (brute.remainder(doc_id, 7) == 2)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model.score(text), rel=1e-5)


def test_token_counts(result, docs):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from assetweave.llm.token_counts import default_model, vocabulary

    unigram = Tokenizer(models.Unigram(vocabulary(default_model()), unk_id=0, byte_fallback=True))
    unigram.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    got = {r["doc_id"]: r["n_tokens"] for r in result(8)}
    assert got == {d: len(unigram.encode(t).ids) for d, t in docs}


def check_packing(rows, docs, size=4096):
    """Every id in one piece, sequences gapless and within the size."""
    tokens = {d: brute.ids(t, 2) for d, t in docs}
    pieces, sequences = {}, {}
    for r in rows:
        part = tokens[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part) == r["ids_crc32"]
        assert r["doc_tokens"] == len(tokens[r["doc_id"]])
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found, total in [*((pieces[d], len(t)) for d, t in tokens.items()), *((s, None) for s in sequences.values())]:
        at = 0
        for start, length in sorted(found):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= size
    return sum(map(len, tokens.values())) / size / len(sequences)


def test_packing(result, docs):
    assert check_packing(result(9), docs) > 0.9


def test_token_shards(result, docs):
    at, expected = 0, []
    for doc_id, text in docs:
        tokens = brute.ids(text, 1)
        expected.append((doc_id, at, len(tokens), zlib.crc32(tokens)))
        at += len(tokens)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in result(10)) == expected


def test_whole_pipeline(spark, sf_dir, result, docs):
    import corpus_pipeline

    rows = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    good = {r["doc_id"] for r in result(6) if r["predicted"]}
    kept = [(d, t) for d, t in docs if d in good]
    one = {c for _, _, c in brute.near_duplicates(kept)}
    kept = [(d, t) for d, t in kept if d in one]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {r[0] for r in brute.contamination(kept, items) if r[-1]}
    kept = [(d, t) for d, t in kept if d not in hit]
    spans = {r["doc_id"]: r["spans"] for r in result(1)}
    clean = []
    for d, t in kept:
        for span in reversed(spans[d].split(",") if spans[d] else []):
            _, a, b = span.split(":")
            t = t[: int(a)] + "\0" * (int(b) - int(a)) + t[int(b) :]
        clean.append((d, re.sub("\0+", "[SECRET]", t)))
    check_packing(rows, clean)


def test_every_stage_keeps_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).schema == docs.schema, name
