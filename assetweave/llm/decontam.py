"""Op 5: benchmark passages in documents, found by an FM-index over each training shard.

A window is ten consecutive words of a benchmark item (all words of a shorter
item). Words that no item holds can't be part of an occurrence, so a shard (a
slice of a partition's rows) is indexed as its runs of benchmark words, long
enough for the shortest window, with separators between them. Windows are
searched backward through wavelet-matrix ranks, all at once; occurrences are
located by walking back to sampled suffix positions; their words are merged into
spans. Items go to the tasks in blocks of bounded size, one pass per block.

Null and empty texts have no words; an item without words has no window; an item
without an id marks words but isn't counted. Rows stand for themselves, repeated
ids included. An empty benchmark finds nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, fresh, map_batches
from assetweave.llm.text import ALNUM, chunks, text_of, words
from assetweave.llm.wavelet import WaveletMatrix

WINDOW = 10
#: bytes of benchmark text in one block
BLOCK_BYTES = 8 << 20
#: every so many text places keep their suffix position
SAMPLE = 16

#: columns added to the documents: words, spans of hit words, items found
FOUND = {"n_words": "long", "spans": "array<int>", "items": "array<string>"}
_ARROW = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the last symbol must be the smallest and unique."""
    n, step = len(s), 1
    _, rank = np.unique(s, return_inverse=True)
    rank = rank.astype(np.int64)
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
        rank, step = new, 2 * step
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FMIndex:
    """Index of a sequence of symbols from 1 on; 0 ends it."""

    def __init__(self, sequence: np.ndarray, sample: int = SAMPLE):
        s = np.append(sequence, 0)
        order = suffix_array(s)
        last = s[order - 1]
        self.n = len(s)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(s))])  # suffixes that begin with a smaller symbol
        self.ranks = WaveletMatrix.build(last.astype(np.uint32), max(1, int(s.max()).bit_length()))
        self.sampled = order % sample == 0
        self.number = np.cumsum(self.sampled) - 1
        self.places = order[self.sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns (rows, aligned to the right end)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        for j in range(width):
            live = np.flatnonzero((lengths > j) & (low < high))
            symbol = patterns[live, width - 1 - j]
            known = symbol < len(self.before) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.ranks.rank_many(symbol, low[live])
            high[live] = self.before[symbol] + self.ranks.rank_many(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows."""
        at, place, walked = rows.copy(), np.full(len(rows), -1, np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[at[open_]]
            hit = open_[done]
            place[hit] = self.places[self.number[at[hit]]] + walked
            open_ = open_[~done]
            symbol = self.ranks.access_many(at[open_])
            at[open_] = self.before[symbol] + self.ranks.rank_many(symbol, at[open_])
            walked += 1
        return place


class Benchmark:
    """The windows of a block of items, as symbols."""

    def __init__(self, items: pd.DataFrame, window: int = WINDOW):
        w = words(pa.array(items["text"], pa.string()), ALNUM)
        hashes = w.hashes()
        self.vocabulary = np.unique(hashes)
        symbols = np.searchsorted(self.vocabulary, hashes) + 2  # 1 separates
        ids = [None if pd.isna(i) else str(i) for i in items["item_id"]]
        owners: dict[tuple, list] = {}
        for item, a, b in zip(ids, w.first[:-1], w.first[1:]):
            for i in range(a, max(b - window, a) + 1 if b > a else a):
                found = owners.setdefault(tuple(symbols[i : min(i + window, b)].tolist()), [])
                if item is not None and item not in found:
                    found.append(item)
        self.lengths = np.array([len(k) for k in owners], np.int64)
        self.windows = np.zeros((len(owners), window), np.int64)
        for row, key in zip(self.windows, owners):
            row[window - len(key) :] = key
        self.items = list(owners.values())

    def find(self, column: pa.Array) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
        """Of each text: number of words, merged spans of hit words (start, end, start, ...), items found."""
        w = words(column, ALNUM)
        rows, n = len(column), len(w.start)
        spans, items = [[] for _ in range(rows)], [[] for _ in range(rows)]
        if not len(self.lengths) or not n:
            return w.counts, spans, items
        hashes = w.hashes()
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes
        # runs of benchmark words within a row, as long as the shortest window
        fresh = np.zeros(n + 1, bool)
        fresh[w.first] = True
        begins = np.flatnonzero(known & (fresh[:n] | ~np.concatenate([[False], known[:-1]])))
        ends = np.flatnonzero(known & (fresh[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        long_enough = ends - begins >= self.lengths.min()
        begins, ends = begins[long_enough], ends[long_enough]
        if not len(begins):
            return w.counts, spans, items
        size = ends - begins + 1
        first = np.cumsum(size) - size
        word = np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(begins, size)
        sequence = np.ones(len(word), np.int64)
        inside = word < np.repeat(ends, size)
        sequence[inside] = at[word[inside]] + 2
        index = FMIndex(sequence)
        low, high = index.search(self.windows, self.lengths)
        count = high - low
        window = np.repeat(np.arange(len(low)), count)
        row = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
        start = word[index.locate(row)]
        # words inside any occurrence
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + self.lengths[window], -1)
        hit = np.cumsum(change[:-1]) > 0
        a = np.flatnonzero(hit & (fresh[:n] | ~np.concatenate([[False], hit[:-1]])))
        b = np.flatnonzero(hit & (fresh[1:] | ~np.concatenate([hit[1:], [False]]))) + 1
        owner = np.searchsorted(w.first, a, "right") - 1
        for r, x, y in zip(owner.tolist(), (a - w.first[owner]).tolist(), (b - w.first[owner]).tolist()):
            spans[r] += [x, y]
        owner = np.searchsorted(w.first, start, "right") - 1
        for r, k in np.unique(np.stack([owner, window], 1), axis=0).tolist() if len(owner) else []:
            items[r] += self.items[k]
        return w.counts, spans, [sorted(set(x)) for x in items]


def _merged(a: list[int], b: list[int]) -> list[int]:
    out: list[list[int]] = []
    for x, y in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return [i for pair in out for i in pair]


def _blocks(benchmark: DataFrame, size: int):
    """The items in blocks of about ``size`` bytes, by hash; a longer item makes its block longer."""
    # ids as text: pandas turns numbers beside nulls into floats
    item = F.col("item_id").cast("long").cast("string").alias("item_id")
    rows = benchmark.select(item, F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // size))
    for i in range(n):
        yield rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).toPandas()


def found_names(docs: DataFrame) -> list[str]:
    return fresh(docs, *FOUND)


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All columns of ``docs``, then words, spans (word numbers, end exclusive) and items, named as ``found_names``."""
    context, added = docs.sparkSession.sparkContext, found_names(docs)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    schema = ", ".join([*schema, *(f"`{name}` {kind}" for name, kind in zip(added, FOUND.values()))])
    found = docs
    for number, items in enumerate(_blocks(benchmark, block_bytes)):
        block = context.broadcast(Benchmark(items, window))

        def search(batches: Batches, block=block, later=number > 0) -> Batches:
            for batch in chunks(batches):
                n, spans, names = block.value.find(text_of(batch))
                columns = batch.columns
                if later:
                    columns, old, known = columns[:-3], columns[-2].to_pylist(), columns[-1].to_pylist()
                    spans = [_merged(a, b) if a and b else a or b for a, b in zip(old, spans)]
                    names = [sorted({*a, *b}) for a, b in zip(known, names)]
                extra = [pa.array(x, kind) for x, kind in zip((n, spans, names), _ARROW)]
                yield pa.RecordBatch.from_arrays([*columns, *extra], [*batch.schema.names[: len(columns)], *added])

        found = map_batches(found, search, schema)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found."""
    found = find_passages(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)),
        F.lit(0).cast("long"),
        lambda sum_, i: sum_ + F.col("spans")[i + 1] - F.col("spans")[i],
    )
    return found.select(
        "doc_id",
        "n_words",
        F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with their columns."""
    n_words, spans, items = found_names(docs)
    return find_passages(docs, benchmark).where(F.size(spans) == 0).drop(n_words, spans, items)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def oracle() -> str:
    """The same in SQL: runs of words of every window length, joined to the windows."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    found = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}')"
    return f"""
with items as (select item_id, {found} as words from benchmark where text is not null),
placed as (
  select item_id, words, least({WINDOW}, len(words)) as size, unnest(range(1, greatest(len(words) - {WINDOW}, 0) + 2)) as i
  from items where len(words) > 0),
windows as (select distinct item_id, size, array_to_string(words[i : i + size - 1], ' ') as w from placed),
docs as (select row_number() over () as row, doc_id, coalesce({found}, []) as words from documents),
runs as (
  select row, size, i, array_to_string(words[i : i + size - 1], ' ') as w from (
    select row, words, size, unnest(range(1, len(words) - size + 2)) as i
    from docs, (select distinct size from windows) where len(words) >= size)),
hits as (select row, i, item_id, r.size from runs r join windows w on w.size = r.size and w.w = r.w),
hit_words as (
  select row, count(distinct place)::bigint as n_hit from (select row, unnest(range(i, i + size)) as place from hits) group by row),
hit_items as (
  select row, list_sort(list(distinct item_id::varchar)) as items from hits where item_id is not null group by row)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(items), 0)::bigint as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, n_hit is not null as contaminated
from docs left join hit_words using (row) left join hit_items using (row)
"""
