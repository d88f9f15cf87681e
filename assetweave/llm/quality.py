"""Op 6: document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of character kinds, repeats of
words and lines, and its size; the lines before and after add theirs, and the line's
own shares also count by level. Training
lines carry their document's label; weights of features and of the change from
line to line are fitted by gradient steps on at most ``SAMPLE`` labelled documents
(first by hash of doc_id, texts of at most ``SAMPLE_CHARS``). Scores use the
text alone: forward-backward gives each line's chance of being good, and their mean,
weighted by line length, is the document's score, after a logistic calibration on
the same labelled documents.

Null and empty texts are one empty line and get its score. Rows stand for
themselves; repeated labels count by their smallest value; labels without a
quality are ignored. Without any label every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, fresh, map_batches
from assetweave.llm.text import LOWER, NOT_SPACE, bounds, buffers, chunks, mix, text_of

#: labelled documents that the model is fitted on, and their longest text
SAMPLE, SAMPLE_CHARS = 6_000, 50_000
THRESHOLD = 0.7
STEPS, RATE, RIDGE = 200, 0.1, 1e-5

_KIND = np.full(256, 7, np.uint8)
_KIND[65:91] = 0  # upper case
_KIND[97:123] = _KIND[128:] = 1  # lower case and beyond ASCII
_KIND[48:58] = 2  # digits
_KIND[[9, 10, 11, 12, 13, 32]] = 3
for _c in b".,;:'\"?-()":
    _KIND[_c] = 4
_KIND[33] = 5  # !
_KIND[124] = 6  # |
SHARES = 8
FEATURES = SHARES + 6
#: a share's levels, as features of the line itself
LEVELS = (0.02, 0.1, 0.4)
BINNED = SHARES + 3
WIDTH = 3 * FEATURES + BINNED * len(LEVELS) + 1


@dataclass
class Lines:
    features: np.ndarray  # one row per line, single precision
    size: np.ndarray  # bytes
    first: np.ndarray  # document i has the lines first[i]:first[i + 1]


def lines_of(column: pa.Array) -> Lines:
    """The lines of every text, with own features and those of the lines around."""
    data, offsets = buffers(column)
    breaks = np.flatnonzero(data == 10)
    counts = np.diff(np.searchsorted(breaks, offsets)) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    n = first[-1]
    start, end = np.empty(n, np.int64), np.empty(n, np.int64)
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    start[first[:-1]], start[inner] = offsets[:-1], breaks + 1
    inner = np.ones(n, bool)
    inner[first[1:] - 1] = False
    end[first[1:] - 1], end[inner] = offsets[1:], breaks
    size = end - start
    own = np.zeros((n, FEATURES))
    if len(data):
        kind = _KIND[data]
        for k in range(SHARES):
            total = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int32)])
            own[:, k] = (total[end] - total[start]) / np.maximum(size, 1)
    words = bounds(LOWER[data], offsets, NOT_SPACE[data])
    line = np.searchsorted(start, words.start, "right") - 1
    h = words.hashes()
    n_words = np.bincount(line, minlength=n)
    many = np.maximum(n_words, 1)
    for at, lag in enumerate((1, 2, 3)):
        same = np.zeros(len(h), bool)
        same[lag:] = (h[lag:] == h[:-lag]) & (line[lag:] == line[:-lag])
        own[:, SHARES + at] = np.bincount(line, weights=same, minlength=n) / many
    # a line that its document holds again
    content = np.zeros(n, np.uint64)
    np.add.at(content, line, h)
    key = mix(content + np.repeat(np.arange(len(counts)), counts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    codes, _ = pd.factorize(key)
    own[:, SHARES + 3] = (np.bincount(codes, minlength=1)[codes] > 1) & (n_words > 0) if n else 0
    own[:, SHARES + 4] = np.minimum(size / many, 30) / 10
    own[:, SHARES + 5] = np.log1p(n_words) / 5
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    levels = [own[:, :BINNED] > level for level in LEVELS]
    parts = [own, before, after, *levels, np.ones((n, 1))]
    features, at = np.empty((n, WIDTH), np.float32), 0
    for part in parts:
        features[:, at : at + part.shape[1]] = part
        at += part.shape[1]
    return Lines(features, size, first)


def joined(parts: list[Lines]) -> Lines:
    """The documents of several columns, one after the other."""
    counts = np.concatenate([np.diff(p.first) for p in parts])
    first = np.concatenate([[0], np.cumsum(counts)])
    return Lines(np.concatenate([p.features for p in parts]), np.concatenate([p.size for p in parts]), first)


class Chain:
    """Two-state chain: state 1 is good. ``weights`` act on state 1, ``change`` [from, to] between neighbours."""

    def __init__(self, width: int):
        self.weights, self.change = np.zeros(width), np.zeros((2, 2))
        self.slope, self.offset = 1.0, 0.0

    def _steps(self, first: np.ndarray):
        """For place 0, 1, ... the lines at that place of all documents that are long enough."""
        counts = np.diff(first)
        order = np.argsort(-counts, kind="stable")
        left = counts[order]
        live = len(order)
        for t in range(int(counts.max()) if len(counts) else 0):
            while live and left[live - 1] <= t:
                live -= 1
            yield first[:-1][order[:live]] + t

    def marginals(self, lines: Lines, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Each line's chance of being good; with ``pairs`` the expected number of each change."""
        score = (lines.features @ self.weights.astype(np.float32)).astype(np.float64)
        local = np.stack([-score / 2, score / 2], 1)
        local = np.exp(local - local.max(axis=1, keepdims=True))
        step = np.exp(self.change)
        forward, backward = np.empty_like(local), np.ones_like(local)
        places = list(self._steps(lines.first))
        for t, at in enumerate(places):
            value = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
            forward[at] = value / value.sum(axis=1, keepdims=True)
        for at in reversed(places[1:]):
            value = (backward[at] * local[at]) @ step.T
            backward[at - 1] = value / value.sum(axis=1, keepdims=True)
        both = forward * backward
        good = both[:, 1] / both.sum(axis=1)
        expected = np.zeros((2, 2))
        if pairs:
            for at in places[1:]:
                joint = forward[at - 1][:, :, None] * step * (local[at] * backward[at])[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return good, expected

    def fit(self, lines: Lines, label: np.ndarray) -> Chain:
        """Gradient ascent (Adam) on the likelihood of labels; ``label`` is one per document, shared by its lines.

        ``lines.features`` is scaled in place.
        """
        counts = np.diff(lines.first)
        if not len(counts):
            return self
        target = np.repeat(label, counts).astype(float)
        observed = np.zeros((2, 2))
        for k in (0, 1):
            observed[k, k] = (counts - 1)[label == k].sum()
        total = len(target)
        scale = np.maximum(lines.features.std(axis=0, dtype=np.float64), 1e-3)
        scale[-1] = 1
        lines.features /= scale.astype(np.float32)
        theta = np.zeros(len(self.weights) + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, STEPS + 1):
            self.weights, self.change = theta[:-4], theta[-4:].reshape(2, 2)
            good, expected = self.marginals(lines, pairs=True)
            slope = lines.features.T @ (target - good).astype(np.float32)
            gradient = np.concatenate([slope, (observed - expected).ravel()]) / total
            gradient -= RIDGE * theta
            m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
            theta = theta + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights, self.change = theta[:-4], theta[-4:].reshape(2, 2)
        if 0 < label.mean() < 1:
            self._calibrate(_logit(self.means(lines)), label)
        self.weights = self.weights / scale
        return self

    def _calibrate(self, z: np.ndarray, label: np.ndarray) -> None:
        """Newton steps for slope and offset of a logistic curve over the mean's logit."""
        x, theta = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            gradient = x.T @ (label - p) - RIDGE * len(z) * (theta - [1, 0])
            curve = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * len(z) * np.eye(2)
            theta = theta + np.clip(np.linalg.solve(curve, gradient), -1, 1)
        self.slope, self.offset = max(theta[0], 1e-3), theta[1]

    def scores(self, lines: Lines) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _logit(self.means(lines)) + self.offset, -500, 500)))

    def means(self, lines: Lines) -> np.ndarray:
        """Each document's mean chance of its lines, weighted by their length."""
        good, _ = self.marginals(lines)
        if not len(good):
            return np.zeros(len(lines.first) - 1)
        size = np.add.reduceat(lines.size, lines.first[:-1])
        weight = np.where(np.repeat(size, np.diff(lines.first)) > 0, lines.size, 1)
        total = np.add.reduceat(weight, lines.first[:-1])
        return np.clip(np.add.reduceat(good * weight, lines.first[:-1]) / total, 0, 1)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p) - np.log1p(-p)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """The chain, fitted on a bounded sample of labelled documents that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.min("quality").cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("_doc"), "_doc").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    rows = rows.where((F.length("text") <= SAMPLE_CHARS) & ~held_out(F.col("_doc")))
    # the sample is bounded by its size
    rows = rows.join(F.broadcast(known), "_doc").orderBy("_doc", "text").limit(sample).toArrow()
    chain = Chain(WIDTH)
    if not rows.num_rows:
        return chain
    lines = joined([lines_of(text_of(batch)) for batch in chunks(iter(rows.to_batches()), size=1 << 20)])
    return chain.fit(lines, rows["_label"].to_numpy())


def _score(chain: Chain, name: str):
    def run(batches: Batches) -> Batches:
        for batch in chunks(batches):
            scores = pa.array(chain.scores(lines_of(text_of(batch))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return run


def with_score(docs: DataFrame, chain: Chain, name: str) -> DataFrame:
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_batches(docs, _score(chain, name), ", ".join([*schema, f"`{name}` double"]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``THRESHOLD`` on) of every document."""
    chain = fit_quality(docs, labels)
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chain, "score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score ``THRESHOLD`` or more, with their columns."""
    (name,) = fresh(docs, "quality_score")
    return with_score(docs, fit_quality(docs, labels), name).where(F.col(name) >= THRESHOLD).drop(name)


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
