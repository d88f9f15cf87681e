"""Op 1: secrets in documents: three base patterns, and strings that zstandard can't shorten.

A candidate is a string of at least ``SHORTEST`` secret-like characters, letters and
digits among them, with a sensitive word at most ``NEAR`` characters before or after
it; characters of such strings in between don't count for the distance. Where a
sensitive word stands within a string, it is cut after that word.
Its novelty is the number of bytes by which it lengthens the compressed text
around it, per character. The compressor is primed with a dictionary of the
corpus's own identifiers (those of at least ``COMMON`` different texts, most frequent
first, ``DICTIONARY`` bytes), so that known names and repeats of the surrounding
text cost little. What stands in a base span or is a candidate itself doesn't count
for the dictionary, and names that look random never do, so that a secret is no less
novel for being in many documents. Candidates at or above ``NOVEL`` are reported with
kind ``novel``. Where base spans lie in a candidate, what they leave of it is reported if
the whole is novel, or if it is long enough and novel by itself, so that no rest of a
secret stays beside a base span. Base spans are always kept.

Spans count code points, end exclusive. Null and empty texts have no spans; rows
stand for themselves, repeated ids included; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, map_batches
from assetweave.llm.text import bounds, buffers, chunks, text_of

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")

SENSITIVE = (
    r"pass(?:word|wd|phrase)|secret|token|credential|bearer|authorization|private[ _-]?key|api[ _-]?key"
    r"|access[ _-]?key|auth[ _-]?key|client[ _-]?id|signing[ _-]?key|encryption[ _-]?key"
)
_SENSITIVE = re.compile(SENSITIVE, re.IGNORECASE | re.ASCII)
#: parts joined by single dots, so that a full stop or an ellipsis ends a string
RUN = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
#: rows that can hold a span at all
GATE = rf"(?i:passwd|api_?key|{SENSITIVE})|AKIA|[0-9a-f]{{32}}"

NOVEL = 0.6
SHORTEST = 16
NEAR = 64
CONTEXT = 512
DICTIONARY = 16 << 10
COMMON = 5

#: places where a digit meets a letter or a small letter a capital
_TURN = re.compile(r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])")
_WORD = np.zeros(256, np.uint8)
_WORD[48:58] = _WORD[95] = 1
_WORD[65:91] = _WORD[97:123] = 2


def looks_random(name: str) -> bool:
    """Whether kinds of characters alternate as in a random string: digits and letters, small and capital letters."""
    return len(name) >= 8 and 3 * len(_TURN.findall(name)) > len(name)


def _ordinary(text: str) -> str:
    """The text without base spans and candidates."""
    return _without(text, sorted([*base_spans(text), *((a, 3, b) for a, b in candidates(text))]), " ")


def _identifiers(batches: Batches) -> Batches:
    """Names with letters and digits or underscores of every text, outside of base spans and candidates."""
    for batch in chunks(batches):
        column = text_of(batch)
        if len(gated := _gated(batch)):
            texts = column.to_pylist()
            for i in gated.tolist():
                texts[i] = _ordinary(texts[i])
            column = pa.array(texts, pa.large_string())
        data, offsets = buffers(column)
        kind = _WORD[data]
        w = bounds(data, offsets, kind > 0)
        rows, names = [], []
        if len(w.start):
            mixed = np.bitwise_or.reduceat(kind, w.start) == 3
            size = w.end - w.start
            row = w.row
            some = np.flatnonzero(mixed & (size >= 4) & (size <= 40))
            random: dict[bytes, bool] = {}
            for i, word in {(int(row[i]), w.bytes_of(i)) for i in some}:
                if word not in random:
                    random[word] = looks_random(word.decode())
                if not random[word]:
                    rows.append(i)
                    names.append(word.decode())
        hashes = text_of(batch, "text_hash").take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), hashes], ["name", "text_hash"])


def identifier_dictionary(docs: DataFrame, size: int = DICTIONARY, common: int = COMMON) -> bytes:
    """The identifiers of most different texts (by a 64-bit hash), the most frequent last (nearest to the text)."""
    texts = docs.select("text", F.xxhash64("text").alias("text_hash"))
    names = map_batches(texts, _identifiers, "name string, text_hash long").distinct()
    names = names.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= common)
    top = names.orderBy(F.desc("n"), "name").limit(size // 5).collect()
    out = b""
    for row in top:
        if len(out) + len(row["name"]) + 1 > size:
            break
        out = row["name"].encode() + b" " + out
    return out


class Novelty:
    """Compressed bytes that a string adds to its surroundings, per character."""

    def __init__(self, dictionary: bytes, level: int = 9):
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=primed, write_checksum=False, write_content_size=False)

    def of(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        known = len(self.compressor.compress((before + after).encode()))
        with_it = len(self.compressor.compress((before + after + text[start:end]).encode()))
        return (with_it - known) / (end - start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Secret-like strings near a sensitive word, in order; each is judged by itself."""
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    if not words:
        return []
    begins, ends = [a for a, _ in words], [b for _, b in words]
    runs: list[tuple[int, int]] = []
    for m in RUN.finditer(text):
        start, end = m.span()
        if end - start < SHORTEST:
            continue
        at = start
        for k in range(bisect_right(ends, start), bisect_left(begins, end) + 1):
            to, then = (begins[k], ends[k]) if k < len(words) and begins[k] < end else (end, end)
            # what joins a sensitive word to its value is no part of the value
            value = at
            while value < to and (text[value] == "=" or at > start and text[value] in "=-+/."):
                value += 1
            at = value if value < to else at  # a line of such characters is a string like any other
            if to - at >= SHORTEST:
                runs.append((at, to))
            at = then
    # places in the text without the runs; no sensitive word overlaps a run
    first, before = [a for a, _ in runs], [0]
    for a, b in runs:
        before.append(before[-1] + b - a)
    begins = [a - before[bisect_right(first, a)] for a in begins]
    ends = [b - before[bisect_left(first, b)] for b in ends]
    found = []
    for k, (start, end) in enumerate(runs):
        value, at = text[start:end], start - before[k]
        if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
            continue
        after = bisect_left(begins, at)  # the first word after the run; the one before it is the nearest on the other side
        if (after < len(begins) and begins[after] - at <= NEAR) or (after and at - ends[after - 1] <= NEAR):
            found.append((start, end))
    return found


def _outside(start: int, end: int, base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What merged, sorted spans leave of start to end."""
    out, k = [], bisect_right(base, (start, start))
    for a, b in base[max(0, k - 1) :]:
        if a >= end:
            break
        if a > start:
            out.append((start, a))
        start = max(start, b)
    return out + [(start, end)] if start < end else out


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty, least: float) -> list[tuple[int, int, int]]:
    """Candidates outside of base spans; what a base span leaves of one counts with it or by itself."""
    merged: list[tuple[int, int]] = []
    for start, _, end in base:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    found = []
    for start, end in candidates(text):
        parts = _outside(start, end, merged)
        whole = novelty.of(text, start, end) >= least if parts else False
        if parts == [(start, end)]:
            found += [(start, 3, end)] if whole else []
            continue
        for a, b in parts:
            while a < b and text[a] in "=-+/._":
                a += 1
            if a < b and (whole or (b - a >= SHORTEST and novelty.of(text, a, b) >= least)):
                found.append((a, 3, b))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _gated(batch: pa.RecordBatch) -> np.ndarray:
    column = pc.fill_null(text_of(batch), "")
    return np.flatnonzero(pc.match_substring_regex(column, GATE).to_numpy(zero_copy_only=False))


def secret_spans(docs: DataFrame, least: float = NOVEL) -> DataFrame:
    """One row per document: counts of the base kinds, and all spans."""
    dictionary = identifier_dictionary(docs)
    none = hashlib.sha256(b"").hexdigest()

    def scan(batches: Batches) -> Batches:
        novelty = Novelty(dictionary)
        for batch in chunks(batches):
            column, n = text_of(batch), batch.num_rows
            counts = np.zeros((3, n), np.int64)
            digest, spans = [none] * n, [""] * n
            for i in _gated(batch).tolist():
                text = column[i].as_py()
                base = base_spans(text)
                for _, kind, _ in base:
                    counts[kind, i] += 1
                digest[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans[i] = _joined(sorted(base + novel_spans(text, base, novelty, least)))
            columns = [text_of(batch, "doc_id"), *map(pa.array, counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(
        rows, scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def _without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        out += [text[at : max(at, start)], mark] if start >= at else []
        at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, least: float = NOVEL, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark``; ``n_chars`` follows, where there is one."""
    dictionary = identifier_dictionary(docs)

    def clean(batches: Batches) -> Batches:
        novelty = Novelty(dictionary)
        for batch in chunks(batches):
            changed = {}
            for i in _gated(batch).tolist():
                text = text_of(batch)[i].as_py()
                base = base_spans(text)
                if spans := sorted(base + novel_spans(text, base, novelty, least)):
                    changed[i] = _without(text, spans, mark)
            columns = dict(zip(batch.schema.names, batch.columns))
            if changed:
                texts = text_of(batch).to_pylist()
                for i, text in changed.items():
                    texts[i] = text
                columns["text"] = pa.array(texts, batch.schema.field("text").type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    for i, text in changed.items():
                        sizes[i] = len(text)
                    columns["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_batches(docs, clean, docs.schema)


def op1_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
