"""Op 3: licences of documents by ordered signature rules, in DataFrame functions alone.

Texts without one of the words in ``GATE`` are only counted. Of the others every word
that is a rule's keyword is an anchor; its rules are tried on the words from
there on. Of the matches at one anchor the longest per priority stays, then a
match is dropped if another one that is at least as important spans it (of equal
spans the more important, then the earlier rule). As a match has a bounded number
of words, only the anchors just before it can span it: work and memory grow with
the text, not with the square of the matches. Nothing is shuffled.

The phrases of ``BASE`` are counted besides, wherever their words stand in a row.
Null and empty texts have no words, no labels and score 0; rows stand for
themselves, repeated ids included; an empty table gives no rows.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.license_rules import CONFIDENCE, GATE, REACH, rules

#: fixed values: phrases and labels
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RULES = "map<string, array<struct<order:int,label:string,priority:int,pattern:string>>>"


def _rule_map() -> Column:
    by_word: dict[str, list] = {}
    for r in rules():
        entry = {"order": r.order, "label": r.label, "priority": r.priority, "pattern": r.pattern}
        by_word.setdefault(r.keyword, []).append(entry)
    return F.from_json(F.lit(json.dumps(by_word)), _RULES)


def _base(words: Column) -> Column:
    """Places of the base phrases as (start, label)."""

    def at(word: Column, i: Column) -> Column:
        found = None
        for phrase, label in BASE:
            parts = phrase.split(" ")
            same = [F.get(words, i - (len(parts) - 1 - k)) == part for k, part in enumerate(parts[:-1])]
            hit = reduce(lambda a, b: a & b, same, word == parts[-1])
            place = F.struct((i - (len(parts) - 1)).cast("long").alias("start"), F.lit(label).alias("label"))
            found = F.when(hit, place) if found is None else found.when(hit, place)
        return found

    return F.filter(F.transform(words, at), lambda p: p.isNotNull())


def _matches(words: Column, by_word: Column) -> Column:
    """All matches, anchor by anchor; per anchor the longest of each priority, the earlier rule among equals."""
    anchors = F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
        lambda a: F.map_contains_key(by_word, a["w"]),
    )

    def tried(anchor: Column) -> Column:
        text = F.concat(F.array_join(F.slice(words, anchor["i"] + 1, REACH), " "), F.lit(" "))
        found = F.transform(
            F.element_at(by_word, anchor["w"]),
            lambda r: F.struct(
                r["priority"].alias("priority"),
                (1 - F.size(F.split(F.coalesce(F.regexp_substr(text, r["pattern"]), F.lit("")), " "))).alias("minus"),
                r["order"].alias("order"),
                r["label"].alias("label"),
            ),
        )
        found = F.array_sort(F.filter(found, lambda m: m["minus"] < 0))
        best = F.filter(found, lambda m, k: (k == 0) | (m["priority"] != F.get(found, k - 1)["priority"]))
        return F.transform(
            best,
            lambda m: F.struct(
                anchor["i"].alias("start"),
                (anchor["i"] - m["minus"]).alias("end"),
                m["priority"].alias("priority"),
                m["order"].alias("order"),
                m["label"].alias("label"),
            ),
        )

    return F.flatten(F.transform(anchors, tried))


def _kept(found: Column) -> Column:
    """Matches that no other one spans; at most one per priority and anchor, so few can lie within reach."""
    near = len(CONFIDENCE) * REACH

    def free(m: Column, k: Column) -> Column:
        around = F.slice(found, F.greatest(F.lit(1), k + 1 - near), near + len(CONFIDENCE))

        def spans(o: Column) -> Column:
            covers = (o["start"] <= m["start"]) & (o["end"] >= m["end"]) & (o["priority"] <= m["priority"])
            equal = (o["start"] == m["start"]) & (o["end"] == m["end"]) & (o["priority"] == m["priority"])
            return covers & (o["order"] != m["order"]) & (~equal | (o["order"] < m["order"]))

        return ~F.exists(around, spans)

    return F.filter(found, free)


def license_labels(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels of base and rules, score."""
    # lower() agrees with A-Z alone on all words the rules look for, but for the Kelvin sign, which becomes a k
    text = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("\u212a"), F.lit("\u03ba")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_all")
    )
    gated = F.arrays_overlap("_all", F.lit(GATE))
    rows = rows.select("doc_id", F.size("_all").cast("long").alias("n_words"), F.when(gated, F.col("_all")).alias("_words"))
    words = F.col("_words")
    rows = rows.select(
        "doc_id",
        "n_words",
        F.when(words.isNotNull() & F.array_contains(words, "license"), _base(words)).alias("_base"),
        F.when(words.isNotNull(), _matches(words, _rule_map())).alias("_found"),
    )
    rows = rows.select("doc_id", "n_words", "_base", F.when(F.size("_found") > 0, _kept(F.col("_found"))).alias("_kept"))
    base, kept = F.col("_base"), F.col("_kept")
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.array_sort(F.array_distinct(base["label"])), none)
    labels = F.array_sort(F.array_distinct(F.concat(base_labels, F.coalesce(kept["label"], none))))
    by_priority = F.coalesce(
        *[F.when(F.array_contains(kept["priority"], p), F.lit(c)) for p, c in sorted(CONFIDENCE.items())], F.lit(0.0)
    )
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce(F.when(base.isNotNull(), F.size(base)), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(base["start"]).alias("first_word"),
        F.array_max(base["start"]).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        by_priority.alias("score"),
    )


def op3_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """The same in SQL: rules joined by keyword, spans by a self-join of the few matches."""
    quoted = [
        f"({r.order}, '{r.label}', {r.priority}, {CONFIDENCE[r.priority]}, '{r.keyword}', '{r.pattern}')" for r in rules()
    ]
    phrases = [(p.split(" "), label) for p, label in BASE]
    hits = "\n union all ".join(
        f"select row, pos - {len(p) - 1} as start, '{label}' as label from placed where word = '{p[-1]}'"
        + "".join(f" and words[pos - {len(p) - 1 - k} + 1] = '{w}' and pos >= {len(p) - 1}" for k, w in enumerate(p[:-1]))
        for p, label in phrases
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
with rules(ord, label, priority, confidence, keyword, pattern) as (values {", ".join(quoted)}),
docs as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') as words
  from documents),
placed as (
  select row, words, unnest(words) as word, unnest(range(len(words))) as pos from docs
  where list_has_any(words, {GATE})),
base as ({hits}),
tried as (
  select row, pos as start, ord, label, priority, confidence,
         regexp_extract(array_to_string(words[pos + 1 : pos + {REACH}], ' ') || ' ', pattern) as found
  from placed join rules on word = keyword),
matched as (
  select *, start + length(found) - length(replace(found, ' ', '')) as "end" from tried where found <> ''),
kept as (
  select * from matched m where not exists (
    select 1 from matched o
    where o.row = m.row and o.start <= m.start and o."end" >= m."end" and o.priority <= m.priority and o.ord <> m.ord
      and (o.start < m.start or o."end" > m."end" or o.priority < m.priority or o.ord < m.ord))),
based as (
  select row, count(*) as n_base, min(start) as first_word, max(start) as last_word,
         list_sort(list(distinct label)) as base_labels from base group by row),
ruled as (select row, list(distinct label) as labels, max(confidence) as score from kept group by row)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(b.n_base, 0)::bigint as n_base, b.first_word, b.last_word,
       coalesce(array_to_string(b.base_labels, ','), '') as base_labels,
       coalesce(array_to_string(
         list_sort(list_distinct(coalesce(b.base_labels, []) || coalesce(r.labels, []))), ','), '') as labels,
       coalesce(r.score, 0)::double as score
from docs d left join based b using (row) left join ruled r using (row)
"""
