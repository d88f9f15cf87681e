"""Op 7: log probability of texts by prediction by partial matching, and by word frequencies.

Training counts every byte after the ``DEPTH`` bytes before it, over all texts that are
not held out (start marks before a text, an end mark after it). The trie of contexts
of length ``DEPTH`` to 0 gives each next byte's probability: a context with n
observations of d kinds gives an observed byte its count of n + d and escapes with d of
n + d; on escape the next shorter context counts only bytes not excluded by the longer
one; at last the rest share evenly. If nothing is left to escape to, there is no escape.

The trie grows with the corpus, so it is a table, and texts don't meet it byte by byte:

1. Texts are cut into slices of ``SLICE_BYTES`` and stored. A slice hands on each of its
   distinct keys (context and byte as one number) once, with its count in training
   texts, packed as sorted arrays by bucket of the context's last three bytes.
2. A bucket's keys are merged, in parts of ``PART_KEYS`` and then whole, so the subtree
   of three bytes is together; it has at most 257^3 keys at any size of the corpus. With
   the counts of contexts of up to two bytes (at most 257^3, broadcast) every key gets
   its probability, once.
3. Every slice's keys fetch theirs from the bucket, part by part, and go back to the
   slice, whose texts are scored as sums.

Word frequencies: counts of all training words come from one shuffle with
map-side sums. The most frequent words (at most ``HOT_WORDS``) are looked up in
the tasks, which settles most occurrences; the others' (row, word, count) join
the counts by word, so no word has more than a small part of the joined rows.
Words are known by 64-bit hashes.

Null and empty texts hold the end alone. Rows stand for themselves, repeated ids
included; a null doc_id is never held out. Without training texts every token is
unknown and every byte equally likely. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, map_batches
from assetweave.llm.text import NOT_SPACE, buffers, chunks, mix, text_of, words
from assetweave.session import stored

SYMBOLS = 257
MARK = 256
#: longest context; a key of 6 symbols is a number below 2^49
DEPTH = 5
#: contexts of up to so many bytes are broadcast; those of one more byte stay together
SHORT = 2
SLICE_BYTES = 16 << 20
#: text per bucket of keys, keys of a bucket in one task, keys whose probabilities are worked out at once
BUCKET_BYTES, PART_KEYS, STEP_KEYS = 32 << 20, 1 << 22, 1 << 18
#: bytes of text handled at once, of a long text as well
PIECE = 1 << 20
#: distinct keys of a slice and of pieces of it held before they are merged
HELD_KEYS = 1 << 21
HOT_WORDS = 1 << 18
#: words counted in a task before they are handed on
HELD = 1 << 20


def keys_of(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, row) of every byte and end of text, some positions at a time.

    A key has the nearest byte before as its highest digit, then those before it, then
    the byte itself: contexts that end alike are neighbours.
    """
    rows, lengths = len(offsets) - 1, np.diff(offsets)
    s = np.full(len(data) + (depth + 1) * rows, MARK, np.uint16)
    begin = offsets[:-1] + (depth + 1) * np.arange(rows)
    s[np.arange(len(data)) + np.repeat(begin + depth - offsets[:-1], lengths)] = data
    for a in range(0, len(s) - depth, piece):
        b = min(a + piece, len(s) - depth)
        key = s[a + depth - 1 : b + depth - 1].astype(np.int64)
        for k in [*range(depth - 2, -1, -1), depth]:
            key *= SYMBOLS
            key += s[a + k : b + k]
        low, high = np.maximum(begin, a), np.minimum(begin + lengths + 1, b)
        count = np.maximum(high - low, 0)  # what lies between reaches from one text into the next
        row = np.repeat(np.arange(rows), count)
        yield key[np.arange(len(row)) + np.repeat(low - a - (np.cumsum(count) - count), count)], row


def pack(values: np.ndarray) -> bytes:
    """Integers, small or ascending ones in few bytes."""
    planes = np.diff(values, prepend=0).astype(np.int64).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    begin = np.flatnonzero(np.diff(key, prepend=-1))
    return key[begin], np.add.reduceat(n, begin) if len(begin) else n


class Short:
    """Contexts of up to two bytes: their counts, and per context the facts that escapes need."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.counts = codes[order], counts[order].astype(np.float64)
        two, symbol = self.codes // SYMBOLS, self.codes % SYMBOLS
        size = SYMBOLS * SYMBOLS
        self.one = np.zeros((SYMBOLS, SYMBOLS))
        np.add.at(self.one, (two // SYMBOLS, symbol), self.counts)
        self.zero = self.one.sum(axis=0)
        # observations, kinds, and what the kinds have in the shorter context
        self.facts_two = np.stack(
            [
                np.bincount(two, self.counts, size),
                np.bincount(two, minlength=size),
                np.bincount(two, self.one[two // SYMBOLS, symbol], size),
            ]
        )
        self.facts_one = np.stack(
            [self.one.sum(axis=1), (self.one > 0).sum(axis=1), np.where(self.one > 0, self.zero, 0.0).sum(axis=1)]
        )
        self.facts_none = np.array([self.zero.sum(), (self.zero > 0).sum(), 0.0])

    @property
    def ends(self) -> int:
        """Training texts: each has one end."""
        return int(self.zero[MARK])

    def levels(self, keys: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(count of the byte, facts of the context) of every key, for contexts of 0, 1 and 2 bytes."""
        symbol = keys % SYMBOLS
        two = keys // SYMBOLS ** (depth - 1)
        one, code = two // SYMBOLS, two * SYMBOLS + symbol
        if len(self.codes):
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            found = np.where(self.codes[at] == code, self.counts[at], 0.0)
        else:
            found = np.zeros(len(keys))
        none = np.broadcast_to(self.facts_none[:, None], (3, len(keys)))
        return [(self.zero[symbol], none), (self.one[one, symbol], self.facts_one[:, one]), (found, self.facts_two[:, two])]


def log_probabilities_of(keys: np.ndarray, counts: np.ndarray, short: Short, depth: int = DEPTH) -> np.ndarray:
    """log10 of the probability of each key's byte after its context.

    ``keys`` are distinct and hold every key of a training text whose context ends in
    the same three bytes as one of them.
    """
    symbol, counts = keys % SYMBOLS, counts.astype(np.float64)
    levels = short.levels(keys, depth)
    for k in range(SHORT + 1, depth + 1):
        pair = keys // SYMBOLS ** (depth + 1 - k) * SYMBOLS + symbol
        unique, first, place = np.unique(pair, return_index=True, return_inverse=True)
        count = np.bincount(place, counts, len(unique))
        begin = np.diff(unique // SYMBOLS, prepend=-1) != 0
        node = np.cumsum(begin) - 1
        shorter = np.where(count > 0, levels[-1][0][first], 0.0)
        facts = np.stack([np.bincount(node, w) for w in (count, count > 0, shorter)])
        levels.append((count[place], facts[:, node[place]]))
    out, unseen = np.zeros(len(keys)), np.ones(len(keys), bool)
    taken, kinds_taken = np.zeros(len(keys)), np.zeros(len(keys))
    for count, (n, kinds, in_shorter) in reversed(levels):
        left, kinds_left = n - taken, kinds - kinds_taken
        own = unseen & (count > 0)
        total = np.where(kinds < SYMBOLS, left + kinds_left, left)
        out[own] += np.log10(count[own] / total[own])
        unseen &= ~own
        escapes = unseen & (left > 0)
        out[escapes] += np.log10(kinds_left[escapes] / total[escapes])
        taken, kinds_taken = in_shorter, kinds
    out[unseen] -= np.log10(SYMBOLS - kinds_taken[unseen])
    return out


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 7 == 2, F.lit(False))


def _rows(batches: Batches) -> Iterator[tuple]:
    """Rows one at a time, as their values are large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _batch(names: str, kinds: list[pa.DataType], values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names.split())


_SLICES = "slice long, size long, texts binary"


def _cut(slice_bytes: int):
    """Rows in order, packed, some bytes of text per slice."""

    def run(batches: Batches) -> Batches:
        number, size = TaskContext.get().partitionId() << 31, 0
        for batch in chunks(batches, size=PIECE):
            data, offsets = buffers(text_of(batch))
            if size and size + len(data) > slice_bytes:
                number, size = number + 1, 0
            size += len(data) + batch.num_rows
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(batch)
            values = [number, len(data) + batch.num_rows, sink.getvalue().to_pybytes()]
            yield _batch("slice size texts", [pa.int64(), pa.int64(), pa.binary()], values)

    return run


def _texts(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed).read_all().combine_chunks().to_batches()[0]


_KEYS = "bucket int, slice long, size long, keys binary, counts binary"


def _slice_keys(depth: int, buckets: int):
    """The distinct keys of each slice with their counts in training texts, by bucket."""

    def out(number: int, key: np.ndarray, n: np.ndarray) -> Batches:
        group = (key // SYMBOLS ** (depth - SHORT)).astype(np.uint64)
        bucket = (mix(group + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, key, n = bucket[order], key[order], n[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for a, b in zip(cuts, cuts[1:]):
            values = [int(bucket[a]), number, int(b - a), pack(key[a:b]), pack(n[a:b])]
            yield _batch("bucket slice size keys counts", kinds, values)

    def run(batches: Batches) -> Batches:
        for number, some in groupby(_rows(batches), key=lambda r: r[0]):
            keys, counts, size = [], [], 0
            for _, _, packed in some:
                batch = _texts(packed)
                train = ~text_of(batch, "held_out").to_numpy(zero_copy_only=False)
                for key, row in keys_of(*buffers(text_of(batch)), depth):
                    place, unique = pd.factorize(key)
                    keys.append(unique)
                    counts.append(np.bincount(place, train[row], len(unique)).astype(np.int64))
                    size += len(unique)
                    if size > HELD_KEYS:
                        key, n = merged(keys, counts)
                        keys, counts, size = [key], [n], 0
            yield from out(number, *merged(keys, counts))

    return run


_MERGED = "bucket int, keys binary, counts binary"


def _merge(batches: Batches) -> Batches:
    """One row per run of equal bucket (and part): its distinct keys."""
    for (bucket, _), some in groupby(_rows(batches), key=lambda r: r[:2]):
        keys, counts, size = [], [], 0
        for _, _, k, n in some:
            keys.append(unpack(k))
            counts.append(unpack(n))
            size += len(keys[-1])
            if size > PART_KEYS:  # the distinct ones are far fewer
                key, n = merged(keys, counts)
                keys, counts, size = [key], [n], 0
        key, n = merged(keys, counts)
        yield _batch("bucket keys counts", [pa.int32(), pa.binary(), pa.binary()], [bucket, pack(key), pack(n)])


def _short_counts(depth: int):
    def run(batches: Batches) -> Batches:
        for _, keys, counts in _rows(batches):
            key, n = unpack(keys), unpack(counts)
            key, n = key[n > 0], n[n > 0]
            code, n = merged([key // SYMBOLS ** (depth - 1) * SYMBOLS + key % SYMBOLS], [n])
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    return run


_FILLED = "bucket int, keys binary, logs binary"


def _fill(short, depth: int):
    """The log probability of every key of a bucket, subtree by subtree."""

    def run(batches: Batches) -> Batches:
        for bucket, keys, counts in _rows(batches):
            key, n = unpack(keys), unpack(counts)
            cuts = np.append(np.flatnonzero(np.diff(key // SYMBOLS ** (depth - SHORT), prepend=-1)), len(key))
            logs, a = np.zeros(len(key), np.float32), 0
            while a < len(key):
                after = np.searchsorted(cuts, a + STEP_KEYS, "right") - 1
                b = int(max(cuts[after], cuts[np.searchsorted(cuts, a, "right")]))
                logs[a:b] = log_probabilities_of(key[a:b], n[a:b], short.value, depth)
                a = b
            yield _batch("bucket keys logs", [pa.int32(), pa.binary(), pa.binary()], [bucket, keys, logs.tobytes()])

    return run


_FETCHED = "slice long, keys binary, logs binary"


def _fetch(batches: Batches) -> Batches:
    """The probabilities that slices ask for; a bucket's own row comes first."""
    known = logs = None
    for _, _, number, keys, values in _rows(batches):
        if values is not None:
            known, logs = unpack(keys), np.frombuffer(values, np.float32)
        else:
            found = logs[np.searchsorted(known, unpack(keys))]
            yield _batch("slice keys logs", [pa.int64(), pa.binary(), pa.binary()], [number, keys, found.tobytes()])


def text_scores(batch: pa.RecordBatch, known: np.ndarray, logs: np.ndarray, depth: int) -> np.ndarray:
    score = np.zeros(batch.num_rows)
    for key, row in keys_of(*buffers(text_of(batch)), depth):
        place, unique = pd.factorize(key)
        each = logs[np.searchsorted(known, unique)].astype(np.float64)
        score += np.bincount(row, each[place], batch.num_rows)
    return score


def key_probabilities(slices: DataFrame, depth: int, buckets: int, part_keys: int) -> tuple[DataFrame, Short]:
    """(slice, keys, logs) of every key that occurs in a slice, and the short contexts."""
    asked = stored(map_batches(slices, _slice_keys(depth, buckets), _KEYS), "slice-keys")
    parts = asked.groupBy("bucket").agg(F.ceil(F.sum("size") / part_keys).cast("int").alias("parts"))
    parts = stored(parts, "bucket-parts")
    asked = asked.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("slice"), F.col("parts")).cast("int"))

    def by_bucket(df: DataFrame, *more: str) -> DataFrame:
        return df.repartition(buckets, *more[:1], "bucket").sortWithinPartitions("bucket", *more)

    some = map_batches(by_bucket(asked.select("bucket", "part", "keys", "counts"), "part"), _merge, _MERGED)
    whole = by_bucket(some.select("bucket", F.lit(0).alias("part"), "keys", "counts"))
    whole = stored(map_batches(whole, _merge, _MERGED), "bucket-keys")
    found = map_batches(whole, _short_counts(depth), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    found = found.toPandas()  # 257^3 rows at most
    short = Short(found["code"].to_numpy(np.int64), found["n"].to_numpy(np.int64))
    shared = slices.sparkSession.sparkContext.broadcast(short)
    filled = stored(map_batches(whole, _fill(shared, depth), _FILLED), "bucket-logs")
    none = F.lit(None)
    tables = filled.join(parts, "bucket").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tables = tables.select("bucket", "part", none.cast("long").alias("slice"), "keys", "logs")
    both = tables.unionAll(asked.select("bucket", "part", "slice", "keys", none.cast("binary")))
    both = both.repartition(buckets, "part", "bucket").sortWithinPartitions("bucket", "part", F.asc_nulls_first("slice"))
    return map_batches(both, _fetch, _FETCHED), short


def _counted(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, unique = pd.factorize(np.concatenate(keys))
    return unique, np.bincount(codes, weights=np.concatenate(n)).astype(np.int64)


def _count(batches: Batches) -> Batches:
    """Counts of word hashes in training texts, summed within the task as far as memory allows."""

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    keys, counts, size = [], [], 0
    for (packed,) in _rows(batches):
        batch = _texts(packed)
        column = text_of(batch).filter(pc.invert(text_of(batch, "held_out")))
        hashes = words(column, NOT_SPACE).hashes()
        key, n = _counted([hashes], [np.ones(len(hashes))])
        keys, counts, size = [*keys, key], [*counts, n], size + len(key)
        if size > HELD:
            key, n = _counted(keys, counts)
            if len(key) > HELD // 2:
                yield rows(key, n)
                keys, counts, size = [], [], 0
            else:
                keys, counts, size = [key], [n], len(key)
    if keys:
        yield rows(*_counted(keys, counts))


@dataclass
class Hot:
    keys: np.ndarray
    counts: np.ndarray


def _hot_words(counts: DataFrame, most: int) -> Hot:
    """The most frequent words, whole ranges of frequency at a time, ``most`` words at most."""
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, cut = 0, None
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        cut = row["level"]
    found = counts.where(level >= cut if cut is not None else F.lit(False)).select("key", "n").toPandas()
    keys, n = found["key"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(keys)
    return Hot(keys[order], n[order])


_SCORED = (
    "key long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, "
    "word array<long>, times array<int>"
)


def _scored(shared, depth: int):
    def words_of(batch: pa.RecordBatch) -> list[pa.Array]:
        """Tokens; known ones and the sum of their logarithms; the other words, each once per row."""
        hot, rows = shared.value, batch.num_rows
        logs = np.log10(hot.counts + 1.0)
        w = words(text_of(batch), NOT_SPACE)
        h, row = w.hashes(), w.row
        if len(hot.keys):
            at = np.minimum(np.searchsorted(hot.keys, h), len(hot.keys) - 1)
            found = hot.keys[at] == h
        else:
            at, found = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        known = np.bincount(row[found], minlength=rows)
        sums = np.bincount(row[found], weights=logs[at[found]] if len(logs) else None, minlength=rows)
        rest, owner = h[~found], row[~found]
        order = np.lexsort((rest, owner))
        rest, owner = rest[order], owner[order]
        new = np.ones(len(rest), bool)
        new[1:] = (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        times = np.diff(begin, append=len(rest)).astype(np.int32)
        offsets = pa.array(np.searchsorted(owner[begin], np.arange(rows + 1)), pa.int32())
        counts = [pa.array(w.counts + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64())]
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (rest[begin].view(np.int64), times)]
        return counts + lists

    def run(batches: Batches) -> Batches:
        key = TaskContext.get().partitionId() << 33
        for _, some in groupby(_rows(batches), key=lambda r: r[0]):
            held, table = [], None
            for _, _, packed, keys, logs in some:
                if packed is None:
                    held.append((unpack(keys), np.frombuffer(logs, np.float32)))
                    continue
                if table is None:
                    known, logs = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(known)
                    table, held = (known[order], logs[order]), []
                for batch in chunks(iter([_texts(packed)])):
                    n_tokens, known, sums, rest, times = words_of(batch)
                    score = pa.array(text_scores(batch, *table, depth))
                    ids = pa.array(key + np.arange(batch.num_rows), pa.int64())
                    columns = [ids, text_of(batch, "doc_id"), text_of(batch, "held_out"), n_tokens, known, sums, score, rest, times]
                    key += batch.num_rows
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _SCORED.split(", ")])

    return run


def log_probabilities(
    docs: DataFrame,
    hot_words: int = HOT_WORDS,
    depth: int = DEPTH,
    slice_bytes: int = SLICE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    part_keys: int = PART_KEYS,
) -> DataFrame:
    """One row per document: known words, base_score by word frequencies, score by the trie of ``depth`` 3 to 6."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out(F.col("doc_id")))
    slices = stored(map_batches(rows, _cut(slice_bytes), _SLICES), "text-slices")
    counts = map_batches(slices.select("texts"), _count, "key long, n long")
    counts = stored(counts.groupBy("key").agg(F.sum("n").alias("n")), "word-counts")
    facts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot = context.broadcast(_hot_words(counts, hot_words))
    size = slices.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    fetched, short = key_probabilities(slices, depth, max(1, -(-size // bucket_bytes)), part_keys)
    # every text of the training set has one end
    train_tokens, distinct = int(facts[0]) + short.ends, int(facts[1]) + (short.ends > 0)

    none = F.lit(None).cast("binary")
    both = fetched.select("slice", F.lit(False).alias("is_text"), none.alias("texts"), "keys", "logs")
    both = both.unionAll(slices.select("slice", F.lit(True), "texts", none, none))
    both = both.repartition(max(1, -(-size // slice_bytes)), "slice").sortWithinPartitions("slice", "is_text")
    scored = stored(map_batches(both, _scored(hot, depth), _SCORED), "scored-texts")
    pairs = scored.select("key", F.explode(F.arrays_zip("word", "times")).alias("w")).select("key", "w.word", "w.times")
    pairs = pairs.join(counts.select(F.col("key").alias("word"), "n"), "word")
    more = pairs.groupBy("key").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("more_logs")
    )
    out = scored.drop("word", "times").join(more, "key", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + float(np.log10(short.ends + 1.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + int(short.ends > 0)).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(train_tokens + distinct + 1.0))).alias("base_score"),
        "score",
    )


def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_probabilities(spark.read.parquet(f"{sf_dir}/documents.parquet"))
