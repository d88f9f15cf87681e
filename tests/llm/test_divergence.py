"""Op 12: base rules against a plain version, distances against a plain version, guards."""

import math
import re
import unicodedata
from collections import Counter

import pytest

import brute
from assetweave.llm import divergence
from test_odd_rows import TEXTS


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = brute.SPACED.findall(text)
    lines = [line for line in text.split("\n") if brute.SPACED.search(line)]
    seen, again = set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit), failed


def classes(text):
    out = [0] * 8
    for c in text or "":
        kind = unicodedata.category(c)
        if kind == "Ll":
            out[1] += 1
        elif c in "\x20\t\n\x0b\x0c\r":
            out[0] += 1
        elif kind == "Lu":
            out[2] += 1
        else:
            out[{"L": 3, "N": 4, "P": 5, "S": 6}.get(kind[0], 7)] += 1
    return out


def distance(counts, reference):
    n, m, total = sum(counts), sum(reference), 0.0
    for a, b in zip(counts, reference):
        p, q = a / n, b / m
        total += sum(x * math.log2(2 * x / (p + q)) for x in (p, q) if x) / 2
    return math.sqrt(max(0, total - (len(counts) - 1) / (8 * math.log(2) * n)))


def frame(spark, rows):
    rows = [(d, t, lang, 3, "k", [1]) for d, t, lang in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, kept string, words array<int>")


BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules_of_odd_rows(spark):
    rows = [(d, t, None) for d, t in TEXTS]
    rows += [(50, "a b c a b c a b", "en"), (51, "a a a a", "en"), (52, "a a a", ""), (53, "x y\n\n x y\nx y\nx y", "fr")]
    rows += [(54, " ".join(f"w{i}" for i in range(49)), "en"), (55, " ".join(f"w{i}" for i in range(50)), "en")]
    rows += [(56, "\x0b\x0c #*$%&|<>     \r\n\n", "en")]
    got = divergence.quality_rules(frame(spark, rows))
    found = sorted((tuple(r[c] for c in BASE) for r in got.collect()), key=repr)
    assert found == sorted(((d, *base(t)) for d, t, _ in rows), key=repr)
    # without the long text there is too little to hold anything against a document
    got = divergence.quality_rules(frame(spark, [r for r in rows if len(r[1] or "") < 10_000])).collect()
    assert all(r.kept is (not r.base_failed) and r.word_distance is None and r.class_distance is None for r in got)


def test_empty_table(spark):
    out = divergence.quality_rules(frame(spark, [(1, "a", "en")]).limit(0))
    assert out.count() == 0


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_distances(spark, corpus):
    """Against the definition, with languages of their own and one that has to be compared with all texts."""
    rows = [(d, t, None if d % 5 == 0 else lang) for d, t, lang in corpus]
    rows += [(9000 + i, t, f"rare{i}") for i, (_, t, _) in enumerate(corpus[:80])]
    words = {i: brute.SPACED.findall(t or "") for i, (_, t, _) in enumerate(rows)}
    by_lang, chars = {}, {}
    for i, (_, t, lang) in enumerate(rows):
        for name in (lang or "", None):
            if len(words[i]) >= 100:
                by_lang.setdefault(name, Counter()).update(words[i])
            if len(t or "") >= 200:
                chars[name] = [a + b for a, b in zip(chars.get(name, [0] * 8), classes(t))]
    sizes = sorted((-sum(c.values()), name) for name, c in by_lang.items() if name is not None)[:64]
    known = {name for _, name in sizes}
    assert len(known) == 64 and len(by_lang) > 65
    got = {(r.doc_id): r for r in divergence.quality_rules(frame(spark, rows)).collect()}
    compared = 0
    for i, (d, t, lang) in enumerate(rows):
        name = (lang or "") if (lang or "") in known else None
        total = sum(by_lang[name].values())
        common = sorted(by_lang[name].items(), key=lambda x: (-x[1], x[0].encode()))[:32]
        r, n = got[d], len(words[i])
        if total >= 10_000 and len(t or "") >= 200:
            assert r.class_distance == pytest.approx(distance(classes(t), chars[name]), abs=1e-6)
        else:
            assert r.class_distance is None
        if total >= 10_000 and n >= 100:
            own = [words[i].count(w) for w, _ in common]
            expected = distance([*own, n - sum(own)], [*(c for _, c in common), total - sum(c for _, c in common)])
            assert r.word_distance == pytest.approx(expected, abs=1e-6)
            compared += 1
        else:
            assert r.word_distance is None
        near = (r.class_distance or 0) <= divergence.CLASS_DISTANCE and (r.word_distance or 0) <= divergence.WORD_DISTANCE
        assert r.kept == (not r.base_failed and near)
    assert compared > 100


def test_verdicts_follow_labels(spark, corpus, sf_dir):
    """Clean documents that pass the base rules stay; most bad ones go. (Labels are used here only.)"""
    got = {r.doc_id: r for r in divergence.quality_rules(frame(spark, corpus)).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    clean = [got[r.doc_id] for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert all(r.kept for r in clean) and clean
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_plan_has_no_python(spark, corpus):
    plan = divergence.quality_rules(frame(spark, corpus[:5]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Exchange" not in plan  # texts never move


def test_texts_are_split_into_classes_once(spark, monkeypatch):
    """The sums of a language come from the measured rows, not from a second pass over the texts."""
    seen, counts = [], divergence._class_counts

    def counted(*args):
        seen.append(args)
        return counts(*args)

    monkeypatch.setattr(divergence, "_class_counts", counted)
    text = "plain words and 12 numbers, " * 60
    rows = divergence.quality_rules(frame(spark, [(1, text, "en"), (2, text, None), (3, None, "en")]))
    assert len(seen) == 1 and "regexp_replace" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in rows.collect()) == [1, 2, 3]


def test_sums_are_not_added_up_for_every_entry(spark):
    rows = divergence.quality_rules(frame(spark, [(1, "plain words and 12 numbers, " * 60, "en")]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" in plan
    # two sums and the sum of terms of either distance, and the sum that says how much text there is
    assert plan.count("aggregate(") <= 7
