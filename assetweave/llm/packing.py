"""Op 9: pack token ids into sequences, shortest pack first over the histogram of lengths.

1. Every text becomes ids plus an end id; a text longer than a sequence is cut
   into whole sequences and a rest. Null and empty texts are the end id alone.
2. The histogram of piece lengths (one row per length, never more than the
   sequence length) goes to the driver. Lengths are placed longest first, each
   into the pack with the most room left; packs with the same content are one
   pattern with a count, so the work doesn't depend on the number of pieces.
3. Pieces of equal length are ranked, and the rank picks the pattern slot. Ranks
   come from a range partitioning by (length, doc_id, start), so a length that a
   third of all pieces share is spread over many tasks. Cutting the ranges takes a
   pass of its own, so the pieces are stored first and texts are encoded once.

Rows with equal doc_id are packed like any others; doc_id may be null. An empty
table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.tasks import map_batches
from assetweave.llm.text import chunks, text_of
from assetweave.llm.token_ids import default_tokenizer, token_ids
from assetweave.session import stored

SEQUENCE = 4096
#: bytes of text encoded at once; the arrays of a step take some fifty times that
STEP = 1 << 20
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def _cut(path: str, end_id: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(path)
        for batch in chunks(batches, size=STEP):
            flat, offsets = encoder.encode(text_of(batch))
            flat = np.insert(flat, offsets[1:], end_id).astype("<u4")
            tokens = np.diff(offsets) + 1
            begin = np.cumsum(tokens) - tokens
            n = -(-tokens // size)  # pieces of each document
            row = np.repeat(np.arange(len(n)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * size
            length = np.minimum(size, tokens[row] - start)
            at = begin[row] + start
            raw = flat.tobytes()
            ids = [raw[4 * a : 4 * b] for a, b in zip(at, at + length)]
            columns = [
                text_of(batch, "doc_id").take(pa.array(row)),
                *[pa.array(x, pa.int64()) for x in (start, length, tokens[row])],
                pa.array(ids, pa.binary()),
            ]
            yield pa.record_batch(columns, [f.split()[0] for f in PIECES.split(", ")])

    return cut


def pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, size: int = SEQUENCE) -> DataFrame:
    """Token ids of ``docs`` (doc_id, text) in pieces; ids are little-endian unsigned 32-bit integers."""
    cut = _cut(tokenizer or default_tokenizer(), end_id, size)
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, PIECES)


@dataclass
class Slots:
    """For every length the slots that take its pieces, in order of rank."""

    first: dict[int, np.ndarray]  # rank of each slot's first piece
    sequence: dict[int, np.ndarray]  # sequence id of that piece
    offset: dict[int, np.ndarray]  # place in the sequence


def pack_histogram(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """Patterns (count, lengths in order of placing), by shortest pack first."""
    groups: dict[int, list] = defaultdict(list)  # room left: [count, pattern as linked list]
    room: list[int] = []  # heap of the rooms, largest first
    for length in sorted(histogram, reverse=True):
        left, after = histogram[length], []
        while left:
            while room and not groups[-room[0]]:
                heapq.heappop(room)
            if room and -room[0] >= length:
                at = -room[0]
                count, pattern = groups[at].pop()
                take = min(left, count)
                if take < count:
                    groups[at].append((count - take, pattern))
            else:
                at, take, pattern = size, left, None
            if not groups[at - length]:
                heapq.heappush(room, length - at)
            groups[at - length].append((take, (length, pattern)))
            left -= take
    out = []
    for held in groups.values():
        for count, pattern in held:
            lengths = []
            while pattern:
                lengths.append(pattern[0])
                pattern = pattern[1]
            out.append((count, lengths[::-1]))
    return sorted(out, key=lambda p: (p[1], p[0]))


def slots(patterns: list[tuple[int, list[int]]]) -> Slots:
    first, sequence, offset, taken, base = defaultdict(list), defaultdict(list), defaultdict(list), defaultdict(int), 0
    for count, lengths in patterns:
        at = 0
        for length in lengths:
            first[length].append(taken[length])
            sequence[length].append(base)
            offset[length].append(at)
            taken[length] += count
            at += length
        base += count
    return Slots(*({k: np.array(v, np.int64) for k, v in x.items()} for x in (first, sequence, offset)))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number and each row's rank among the partition's rows of its length; rows come sorted."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        length = text_of(batch, "length").to_numpy()
        begins = np.flatnonzero(np.diff(length, prepend=length[0] - 1))
        rank = np.arange(len(length)) - np.repeat(begins, np.diff(begins, append=len(length)))
        if length[0] == last:
            rank[: begins[1] if len(begins) > 1 else len(length)] += seen
        last, seen = length[-1], int(rank[-1]) + 1
        extra = [pa.array(np.full(len(length), part), pa.int32()), pa.array(rank, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "_part", "_rank"])


def pack(rows: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with doc_id, start and length; other columns are kept."""
    spark = rows.sparkSession
    rows = stored(rows, "pieces")
    kept = [(f"`{f.name}` {f.dataType.simpleString()}") for f in rows.schema]
    sorted_rows = rows.repartitionByRange("length", "doc_id", "start").sortWithinPartitions("length", "doc_id", "start")
    numbered = stored(map_batches(sorted_rows, _number, ", ".join([*kept, "_part int", "_rank long"])), "ranked-pieces")
    # one row per length and range: at most the sequence length plus the number of ranges
    counts = numbered.groupBy("length", "_part").agg(F.count("*").alias("n")).toPandas().sort_values(["length", "_part"])
    histogram = counts.groupby("length")["n"].sum().to_dict()
    earlier = counts.groupby("length")["n"].cumsum() - counts["n"]
    before = {(int(a), int(b)): int(c) for a, b, c in zip(counts["length"], counts["_part"], earlier)}
    found = spark.sparkContext.broadcast((before, slots(pack_histogram(histogram, size))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held = found.value
        for batch in batches:
            length, part = text_of(batch, "length").to_numpy(), text_of(batch, "_part").to_numpy()
            rank = text_of(batch, "_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for key in {*zip(length.tolist(), part.tolist())}:
                some = np.flatnonzero((length == key[0]) & (part == key[1]))
                at = rank[some] + before[key]
                slot = np.searchsorted(held.first[key[0]], at, "right") - 1
                sequence[some] = held.sequence[key[0]][slot] + at - held.first[key[0]][slot]
                offset[some] = held.offset[key[0]][slot]
            columns = [*batch.columns[:-2], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "sequence_id", "offset"])

    return map_batches(numbered, place, ", ".join([*kept, "sequence_id long", "offset long"]))


def packed_digest(docs: DataFrame) -> DataFrame:
    cut = pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pack(cut).select(columns)


def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
