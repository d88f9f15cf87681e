"""Op 10: token ids of a corpus as shard files, each holding wavelet matrices with rank and select.

A shard row stores up to ``SHARD`` consecutive tokens: one bit plane per id bit,
sorted level by level, with a count of ones at every ``BLOCK`` bits. From that
one blob a reader gets a token by place, counts a token in a prefix, finds the
k-th occurrence, or decodes the whole.

Documents lie in ascending doc_id order (null first, equal ids by text). A null
or empty text has the end id alone. An empty table gives no shard and no rows.
A shard is cut between documents, so one very long text makes a longer shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.llm.tasks import map_batches
from assetweave.llm.text import chunks, text_of
from assetweave.llm.token_ids import default_tokenizer, token_ids
from assetweave.session import new_path

MAGIC = b"WVM1"
#: tokens of a shard; more only where one document has more
SHARD = 1 << 20
#: bits between stored counts of ones
BLOCK = 512

SHARDS = "part int, seq int, before long, n_tokens long, doc_ids binary, lengths binary, no_id binary, matrix binary"


class WaveletMatrix:
    """Succinct sequence of unsigned integers below 2^bits."""

    def __init__(self, n: int, bits: int, zeros: np.ndarray, planes: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.zeros, self.planes, self.ones = n, bits, zeros, planes, ones

    @classmethod
    def build(cls, values: np.ndarray, bits: int = 16) -> WaveletMatrix:
        n, at = len(values), values
        zeros = np.zeros(bits, np.int64)
        planes = np.zeros((bits, (n + 7) // 8), np.uint8)
        ones = np.zeros((bits, n // BLOCK + 1), np.uint32)
        for level in range(bits):
            bit = (at >> (bits - 1 - level)) & 1 == 1
            planes[level] = np.packbits(bit, bitorder="little")
            if n >= BLOCK:
                full = bit[: n // BLOCK * BLOCK].reshape(-1, BLOCK).sum(axis=1)
                ones[level, 1:] = np.cumsum(full)
            low = at[~bit]
            zeros[level] = len(low)
            at = np.concatenate([low, at[bit]])
        return cls(n, bits, zeros, planes, ones)

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack("<QI", self.n, self.bits)
        return head + self.zeros.astype("<i8").tobytes() + self.planes.tobytes() + self.ones.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QI", blob, 4)
        at, wide = 16, (n + 7) // 8
        zeros = np.frombuffer(blob, "<i8", bits, at)
        planes = np.frombuffer(blob, np.uint8, bits * wide, at + 8 * bits).reshape(bits, wide)
        ones = np.frombuffer(blob, "<u4", bits * (n // BLOCK + 1), at + 8 * bits + bits * wide)
        return cls(n, bits, zeros, planes, ones.reshape(bits, -1))

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        begin, whole = block * BLOCK // 8, i >> 3
        count = int(self.ones[level, block]) + int(np.bitwise_count(self.planes[level, begin:whole]).sum())
        if i & 7:
            count += (int(self.planes[level, whole]) & ((1 << (i & 7)) - 1)).bit_count()
        return count

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``end`` lie below the last level."""
        begin = 0
        for level in range(self.bits):
            a, b = self._ones(level, begin), self._ones(level, end)
            if value >> (self.bits - 1 - level) & 1:
                begin, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def rank(self, value: int, end: int) -> int:
        """How often ``value`` stands before place ``end``."""
        begin, end = self._range(value, end)
        return end - begin

    def count(self, value: int) -> int:
        return self.rank(value, self.n) if 0 <= value < 1 << self.bits else 0

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that kind in a plane."""
        low, high = 0, self.n
        while low < high:  # the smallest prefix with more than k such bits
            mid = (low + high) // 2
            ones = self._ones(level, mid + 1)
            low, high = (low, mid) if (ones if bit else mid + 1 - ones) > k else (mid + 1, high)
        return low

    def select(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``value``."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        at = self._range(value, self.n)[0] + k
        for level in reversed(range(self.bits)):
            bit = value >> (self.bits - 1 - level) & 1
            at = self._select_bit(level, bit, at - int(self.zeros[level]) if bit else at)
        return at

    def _prefix(self) -> list[np.ndarray]:
        """Ones before every place of every plane, unpacked once for queries in bulk."""
        if not hasattr(self, "_sums"):
            self._sums = [
                np.concatenate([[0], np.cumsum(np.unpackbits(p, count=self.n, bitorder="little"), dtype=np.int32)])
                for p in self.planes
            ]
        return self._sums

    def rank_many(self, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``rank`` for arrays of values and places."""
        begin, end = np.zeros(len(ends), np.int64), ends
        for level, sums in enumerate(self._prefix()):
            one = values >> (self.bits - 1 - level) & 1 == 1
            a, b = sums[begin], sums[end]
            begin = np.where(one, self.zeros[level] + a, begin - a)
            end = np.where(one, self.zeros[level] + b, end - b)
        return end - begin

    def access_many(self, places: np.ndarray) -> np.ndarray:
        values = np.zeros(len(places), np.int64)
        for level, sums in enumerate(self._prefix()):
            ones = sums[places]
            one = sums[places + 1] > ones
            places = np.where(one, self.zeros[level] + ones, places - ones)
            values = values << 1 | one
        return values

    def decode(self) -> np.ndarray:
        """All values, by undoing the levels from the last to the first."""
        values = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zeros, out = int(self.zeros[level]), np.empty_like(values)
            out[~bit] = values[:zeros]
            out[bit] = values[zeros:] | values.dtype.type(1 << (self.bits - 1 - level))
            values = out
        return values


def _write(path: str, end_id: int, shard: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = token_ids(path), TaskContext.get().partitionId()
        seq = before = held = 0
        ids, docs, none, lengths = [], [], [], []

        def row() -> pa.RecordBatch:
            values = np.concatenate(ids)
            blob = WaveletMatrix.build(values).to_bytes()
            columns = [[part], [seq], [before], [len(values)]]
            columns += [[np.concatenate(x).tobytes()] for x in (docs, lengths, none)] + [[blob]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            names = [f.split()[0] for f in SHARDS.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in chunks(batches):
            flat, offsets = encoder.encode(text_of(batch))
            # the end id behind each row's ids
            ids.append(np.insert(flat, offsets[1:], end_id).astype(np.uint16))
            lengths.append((np.diff(offsets) + 1).astype("<u4"))
            doc = text_of(batch, "doc_id")
            none.append(doc.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
            docs.append(doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            held += len(ids[-1])
            if held >= shard:
                yield row()
                seq, before, held, ids, docs, none, lengths = seq + 1, before + held, 0, [], [], [], []
        if ids:
            yield row()

    return encode


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1, shard: int = SHARD) -> None:
    """Write the token ids of ``docs`` (doc_id, text) as shards, one file or more per range of doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encode = _write(tokenizer or default_tokenizer(), end_id, shard)
    map_batches(rows, encode, SHARDS).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``, the number of tokens in all earlier ones."""
    shards = spark.read.schema(SHARDS).parquet(path)
    # one row per range of doc_id goes through this window
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # as many rows as the writing job had tasks: broadcast, so that the shards stay where they are
    return shards.join(F.broadcast(parts), "part").withColumn("base", F.col("base") + F.col("before"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = WaveletMatrix.from_bytes(row["matrix"]).decode()
            lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
            doc, none = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["no_id"], np.uint8) == 1
            ends = np.cumsum(lengths)
            wide = ids.astype("<u4")
            crc = [zlib.crc32(wide[a:b]) for a, b in zip(ends - lengths, ends)]
            columns = [
                pa.array(doc, pa.int64(), mask=none),
                pa.array(row["base"] + ends - lengths, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each document's place, number of ids and checksum, decoded from the shard files."""
    shards = read_shards(spark, path).select("base", "doc_ids", "lengths", "no_id", "matrix")
    return map_batches(shards, _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-shards")
    write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_documents(spark, path)
