"""Op 12: quality rules by distance from a language's histograms, in DataFrame functions alone.

A document's character classes and its counts of the language's ``COMMON`` commonest
words (with one place for all other words) are compared with those of all documents
of its ``lang`` by the Jensen-Shannon distance (base 2, 0 to 1). A histogram of n
entries drawn from the reference itself has an expected divergence of about
(places - 1) / (8 n ln 2); that much is taken off first. Texts of fewer than
``MIN_CHARS`` characters or ``MIN_WORDS`` words are not held against the one or the
other, nor is any text if its reference has fewer than ``MIN_REFERENCE`` words.

References are sums over all documents of at least ``MIN_WORDS`` words: word counts
by (lang, word) with map-side sums, then the first ``COMMON`` per language. They
are kept for the ``LANGUAGES`` languages with most words and for all texts together,
which every other language is compared with; that bounds what the plan carries. A null
lang counts as the empty one.

The base rules (repeated lines, repeated 3-word windows, symbols, too few words) are
computed inside the row: windows are known by 64-bit hashes, sorted, and equal
neighbours are repeats. Texts never move; the only shuffles are of counts.

Null and empty texts have no words and fail the base rules; rows stand for
themselves, repeated ids included; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.session import stored

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: character classes, each taken out of what the ones before it have left; the rest is the last class
CLASSES = [
    ("white", r"[\x20\x09-\x0D]+"),
    ("lower", r"\p{Ll}+"),
    ("upper", r"\p{Lu}+"),
    ("letter", r"\p{L}+"),
    ("digit", r"\p{N}+"),
    ("punctuation", r"\p{P}+"),
    ("symbol", r"\p{S}+"),
]
COMMON = 32
LANGUAGES = 64
MIN_CHARS, MIN_WORDS, MIN_REFERENCE = 200, 100, 10_000
#: largest distances of a document that is kept
CLASS_DISTANCE, WORD_DISTANCE = 0.25, 0.3
#: base rules: least words, most words in repeated windows of a hundred
LEAST_WORDS, REPEATED = 50, 50

#: stands for all texts among the references
ALL = None

_REFERENCE = "struct<words:array<string>,counts:array<long>,classes:array<long>>"


def _words(text: Column) -> Column:
    """What ``WORD`` matches; there is an empty string before white space at the start and after it at the end."""
    return F.array_remove(F.split(text, SPACE, -1), "")


def _class_counts(df: DataFrame, text: str, name: str, symbols: str | None = None) -> DataFrame:
    """Add ``name``, the characters of each class, and take ``text`` away.

    Lower-case letters go before white space, as most of a text is then gone; neither class
    has characters of the other. ``symbols`` adds the count of ``SYMBOLS``.
    """
    left, counts = F.col(text), {}
    for number, place in enumerate([1, 0, *range(2, len(CLASSES))]):
        rest = F.regexp_replace(left, F.lit(CLASSES[place][1]), F.lit(""))
        df = df.withColumn(f"_left{number}", rest)
        counts[place] = F.length(left) - F.length(f"_left{number}")
        left = F.col(f"_left{number}")
    values = [*(counts[place] for place in range(len(CLASSES))), F.length(left)]
    df = df.withColumn(name, F.transform(F.array(*values), lambda n: n.cast("long")))
    if symbols:  # punctuation and symbols, so they are among what the first five classes leave
        df = df.withColumn(symbols, F.length(F.regexp_replace("_left4", f"[^{SYMBOLS}]+", "")).cast("long"))
    return df.drop(text, *[f"_left{i}" for i in range(len(CLASSES))])


def references(docs: DataFrame) -> dict[str | None, dict]:
    """Per language the common words and their counts with that of all other words.

    ``ALL`` is the entry of all texts.
    """
    texts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = texts.select("lang", _words(F.col("text")).alias("words")).where(F.size("words") >= MIN_WORDS)
    words = words.select("lang", F.explode("words").alias("word"))
    counted = stored(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words-of-languages")
    everything = counted.groupBy("word").agg(F.sum("n").alias("n"))
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    names = [r["lang"] for r in sizes]
    total = {**{r["lang"]: r["n"] for r in sizes}, ALL: counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]}
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = counted.where(F.col("lang").isin(names)).withColumn("rank", first).where(F.col("rank") <= COMMON)
    common = sorted((r["lang"], r["rank"], r["word"], r["n"]) for r in common.collect())
    common += [(ALL, 0, r["word"], r["n"]) for r in everything.orderBy(F.desc("n"), "word").limit(COMMON).collect()]
    out = {name: {"words": [], "counts": []} for name in total}
    for name, _, word, n in common:
        out[name]["words"].append(word)
        out[name]["counts"].append(n)
    for name, reference in out.items():
        reference["counts"].append(total[name] - sum(reference["counts"]))
    return out


def _with_classes(known: dict[str | None, dict], measured: DataFrame) -> dict[str | None, dict]:
    """The references with the sums of ``_classes`` of all texts of ``MIN_CHARS`` characters."""
    names = [name for name in known if name != ALL]
    key = F.when(F.col("_lang").isin(names), F.col("_lang")).alias("lang")
    places = range(len(CLASSES) + 1)
    sums = measured.where("_long").groupBy(key).agg(*[F.sum(F.col("_classes")[i]) for i in places])
    classes = {r[0]: list(r[1:]) for r in sums.collect()}
    classes[ALL] = [sum(c[i] for c in classes.values()) for i in places]
    return {name: {**entry, "classes": classes.get(name, [0] * len(places))} for name, entry in known.items()}


def _reference(known: dict[str | None, dict]) -> Column:
    """The reference of the row's language."""
    own = {name: entry for name, entry in known.items() if name != ALL}
    own_map = F.from_json(F.lit(json.dumps(own)), f"map<string, {_REFERENCE}>")
    everything = F.from_json(F.lit(json.dumps(known[ALL])), _REFERENCE)
    return F.coalesce(F.try_element_at(own_map, F.col("_lang")), everything)


def _sum(values: Column, start: Column) -> Column:
    return F.aggregate(values, start, lambda total, x: total + x)


def _excess(counts: Column, reference: Column, n: Column, m: Column) -> Column:
    """Jensen-Shannon divergence of two histograms of sums n and m, less what a sample of that size has by chance."""

    def part(c: Column, r: Column) -> Column:
        p, q = c / n, r / m
        middle = (p + q) / 2

        def term(x: Column) -> Column:
            return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)

        return (term(p) + term(q)) / 2

    chance = (F.size(counts) - 1) / (8 * math.log(2) * n)
    return _sum(F.zip_with(counts, reference, part), F.lit(0.0)) - chance


def _with_distance(df: DataFrame, name: str, counts: str, reference: str, enough: Column) -> DataFrame:
    """Add ``name``, on a grid of 10^-6; NULL if there is too little to compare.

    The sums are columns of their own, else they are added up again for every entry.
    """
    sums = {"_n": _sum(F.col(counts), F.lit(0).cast("long")), "_m": _sum(F.col(reference), F.lit(0).cast("long"))}
    n, m = F.col("_n"), F.col("_m")
    distance = F.sqrt(F.greatest(_excess(F.col(counts), F.col(reference), n, m), F.lit(0.0)))
    value = F.when(enough & (n > 0) & (m >= MIN_REFERENCE), F.floor(distance * 1e6 + 0.4999) / 1e6)
    return df.withColumns(sums).withColumn(name, value).drop("_n", "_m")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and verdict, both distances, and whether the document is kept."""
    text = F.coalesce("text", F.lit(""))
    known = references(docs)
    common = sorted({w for reference in known.values() for w in reference["words"]})
    lang = F.coalesce("lang", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("_lang"), text.alias("_text"))
    rows = rows.select(
        "doc_id",
        "_lang",
        "_text",
        _reference(known)["words"].alias("_common"),
        F.length("_text").cast("long").alias("_chars"),
        F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD)).alias("_lines"),
        _words(F.col("_text")).alias("_words"),
    )
    words, n = F.col("_words"), F.size("_words")
    trigrams = F.transform(
        F.slice(words, 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    some = F.filter(words, lambda w: w.isin(common))
    rows = rows.withColumns({"_tri": trigrams, "_some": some, "n_words": n.cast("long")})
    rows = rows.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    # what goes when a common word is taken out tells its count
    taken = F.transform(F.col("_common"), lambda w: (F.size("_some") - F.size(F.array_remove("_some", w))).cast("long"))
    rows = rows.withColumn("_taken", taken)
    rows = _class_counts(rows.drop("_lines", "_some", "_words"), "_text", "_classes", "n_symbols")
    tri, placed, starts = F.col("_tri"), F.col("_placed"), F.col("_starts")
    repeats = F.size(F.array_distinct(tri)) < F.size(tri)
    rows = rows.withColumn(
        "_placed", F.when(repeats, F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ).drop("_tri")
    again = F.filter(
        placed,
        lambda p, k: F.coalesce(p["h"] == F.get(placed, k - 1)["h"], F.lit(False))
        | F.coalesce(p["h"] == F.get(placed, k + 1)["h"], F.lit(False)),
    )
    rows = rows.withColumn("_starts", F.sort_array(F.transform(again, lambda p: p["i"]))).drop("_placed")
    covered = F.transform(starts, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - at, F.lit(3))))
    others = F.array(F.col("n_words") - _sum(F.col("_taken"), F.lit(0).cast("long")))
    rows = rows.select(
        "doc_id",
        "n_words",
        (F.col("_chars") - F.col("_classes")[0]).alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.coalesce(_sum(covered, F.lit(0)), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.concat("_taken", others).alias("_taken"),
        "_classes",
        "_lang",
        (F.col("_chars") >= MIN_CHARS).alias("_long"),
    )
    # the classes of a language are sums of what is known of its texts now, so texts aren't split into classes twice
    rows = stored(rows, "measured-texts")
    rows = rows.withColumn("_ref", _reference(_with_classes(known, rows))).drop("_lang")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    # the words' reference says how much text stands behind either histogram
    enough = _sum(F.col("_ref.counts"), F.lit(0).cast("long")) >= MIN_REFERENCE
    rows = rows.withColumn("base_failed", failed)
    rows = _with_distance(rows, "class_distance", "_classes", "_ref.classes", F.col("_long") & enough)
    rows = _with_distance(rows, "word_distance", "_taken", "_ref.counts", F.col("n_words") >= MIN_WORDS)
    near = (F.coalesce("class_distance", F.lit(0.0)) <= CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= WORD_DISTANCE
    )
    return rows.withColumn("kept", ~F.col("base_failed") & near).drop("_taken", "_classes", "_ref", "_long")


def op12_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """The same in SQL."""
    left, steps = "text", []
    for i, (_, pattern) in enumerate(CLASSES):
        steps.append(f"s{i} as (select *, regexp_replace({left}, '{pattern}', '', 'g') as left{i} from {f's{i - 1}' if i else 'docs'})")
        left = f"left{i}"
    names = ["text", *(f"left{i}" for i in range(len(CLASSES)))]
    counts = ", ".join([*(f"length({a}) - length({b})" for a, b in zip(names, names[1:])), f"length({left})"])
    sums = ", ".join(f"sum(classes[{i + 1}])::bigint" for i in range(len(CLASSES) + 1))

    def distance(own: str, reference: str, enough: str) -> str:
        n, m = f"list_sum({own})", f"list_sum({reference})"
        terms = f"""list_sum(list_transform(list_zip({own}, {reference}), lambda z:
              case when z[1] > 0 then z[1] / {n} * log2(z[1] / {n} / ((z[1] / {n} + z[2] / {m}) / 2)) else 0 end / 2
              + case when z[2] > 0 then z[2] / {m} * log2(z[2] / {m} / ((z[1] / {n} + z[2] / {m}) / 2)) else 0 end / 2))"""
        excess = f"{terms} - (len({own}) - 1) / (8 * ln(2) * {n})"
        return f"""case when {enough} and {n} > 0 and {m} > 0 and word_total >= {MIN_REFERENCE}
              then floor(sqrt(greatest({excess}, 0)) * 1e6 + 0.4999) / 1e6 end"""

    return f"""
with docs as (
  select row_number() over () as row, doc_id, coalesce(lang, '') as lang, coalesce(text, '') as text from documents),
{", ".join(steps)},
classed as (select row, doc_id, lang, text, [{counts}] as classes from s{len(CLASSES) - 1}),
split as (
  select *, regexp_extract_all(text, '{WORD}') as words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) as lines from classed),
long_words as (select lang, unnest(words) as word from split where len(words) >= {MIN_WORDS}),
counted as (select lang, word, count(*) as n from long_words group by all),
sizes as (select lang, sum(n)::bigint as word_total from counted group by lang order by word_total desc, lang limit {LANGUAGES}),
of_lang as (
  select lang, word, n from counted semi join sizes using (lang)
  qualify row_number() over (partition by lang order by n desc, word) <= {COMMON}),
of_all as (select word, sum(n)::bigint as n from counted group by word order by n desc, word limit {COMMON}),
class_refs as (select lang, [{sums}] as class_ref from classed where length(text) >= {MIN_CHARS} group by lang),
word_refs as (
  select lang, list(word order by n desc, word) as common, list(n order by n desc, word) as ns from of_lang group by lang),
refs as (
  select s.lang, word_total, common, list_append(ns, word_total - list_sum(ns)) as word_ref, class_ref
  from sizes s join word_refs using (lang) left join class_refs using (lang)),
all_words as (select coalesce(sum(n), 0)::bigint as word_total from counted),
all_classes as (select [{sums}] as class_ref from classed where length(text) >= {MIN_CHARS}),
all_common as (
  select list(word order by n desc, word) as common, list(n order by n desc, word) as ns, sum(n)::bigint as n from of_all),
all_ref as (
  select word_total, common, list_append(ns, word_total - n) as word_ref, class_ref from all_words, all_classes, all_common),
placed as (
  select row, unnest(range(1, len(words) - 1)) as i, words from split where len(words) >= 3),
windows as (select row, i, words[i : i + 2] as three from placed),
again as (select row, i from windows qualify count(*) over (partition by row, three) > 1),
covered as (select row, count(distinct i + d)::bigint as n from again, (values (0), (1), (2)) t(d) group by row),
rows as (
  select s.row, doc_id, len(words)::bigint as n_words, (length(text) - s.classes[1])::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
         length(text) as chars, s.classes, words,
         case when r.lang is null then a.common else r.common end as common,
         case when r.lang is null then a.word_ref else r.word_ref end as word_ref,
         case when r.lang is null then a.class_ref else r.class_ref end as class_ref,
         case when r.lang is null then a.word_total else r.word_total end as word_total
  from split s left join refs r using (lang) left join covered c using (row), all_ref a),
taken as (
  select *, list_transform(common, lambda w: len(list_filter(words, lambda x: x = w))) as found,
         n_words < {LEAST_WORDS} or 100 * n_repeat_words > {REPEATED} * n_words as base_failed
  from rows),
filled as (select *, list_append(found, n_words - coalesce(list_sum(found), 0)) as own_words from taken),
measured as (
  select *, {distance("classes", "class_ref", f"chars >= {MIN_CHARS}")} as class_distance,
         {distance("own_words", "word_ref", f"n_words >= {MIN_WORDS}")} as word_distance
  from filled)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance,
       not base_failed and coalesce(class_distance, 0) <= {CLASS_DISTANCE}
         and coalesce(word_distance, 0) <= {WORD_DISTANCE} as kept
from measured
"""
