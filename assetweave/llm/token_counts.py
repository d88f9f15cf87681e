"""Op 8: number of unigram tokens per document without making the tokens.

The vocabulary and scores are those of a sentencepiece model file. A text is cut
before every blank (the blank becomes the word's first character), and each word
is segmented by itself. Aho-Corasick lists the vocabulary matches of a word;
dynamic programming over character ends carries the best score and the number of
pieces. Ties go to the candidate that starts first, as in the ``tokenizers``
library's unigram model; a character without a piece of its own may be unknown
at the lowest score less 10, and a run of unknown characters counts its bytes
(byte fallback). A word's result is kept and reused while a worker lives.

Null and empty texts have 0 tokens and score 0. One row per document row.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, map_batches
from assetweave.llm.text import NOT_BLANK, HashCache, chunks, distinct, text_of, words

BLANK = "▁"
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[tuple[str, float]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Viterbi:
    """Counts the pieces of the best segmentation of a word."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.matches = ahocorasick.Automaton()
        for piece, score in dict(reversed(pieces)).items():  # the first of equal pieces counts
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def count(self, word: str) -> tuple[int, float]:
        n = len(word)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        single = [False] * n
        for last, (length, score) in self.matches.iter(word):
            found[last + 1].append((length, score))
            if length == 1:
                single[last] = True
        best, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, take = -np.inf, None
            for length, score in sorted(found[end], reverse=True):  # longest first: the earliest start wins ties
                if best[end - length] + score > top:
                    top, take = best[end - length] + score, length
            if not single[end - 1] and best[end - 1] + self.unknown > top:
                best[end] = best[end - 1] + self.unknown
                pieces[end], unknown[end] = pieces[end - 1] + len(word[end - 1].encode()), True
            else:
                best[end], pieces[end] = top, pieces[end - take] + 1
        return pieces[n], best[n]


class WordCounts:
    def __init__(self, path: str, most: int = 1_000_000):
        self.viterbi, self.most = Viterbi(vocabulary(path)), most
        self._clear()
        self.empty = self.viterbi.count(BLANK)

    def _clear(self) -> None:
        self.cache, self.pieces, self.scores = HashCache(self.most), np.zeros(0, np.int64), np.zeros(0)

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and best score of every text."""
        column = pc.replace_substring(pc.fill_null(column, ""), BLANK, " ")
        w = words(column, NOT_BLANK, lower=False)
        keys, first, inverse = distinct(w.hashes())
        if len(self.cache.keys) + len(keys) > self.most:
            self._clear()
        at = self.cache.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            results = [self.viterbi.count(BLANK + w.bytes_of(i).decode()) for i in first[new]]
            at[new] = len(self.pieces) + np.arange(len(new))
            self.pieces = np.concatenate([self.pieces, [r[0] for r in results]]).astype(np.int64)
            self.scores = np.concatenate([self.scores, [r[1] for r in results]])
            self.cache.add(keys[new], at[new])
        word = at[inverse]
        # blanks that no word follows stand alone, but for one before the first word
        data, offsets = w.data, w.offsets
        blanks = np.concatenate([[0], np.cumsum(data == 0x20)])[offsets]
        full = np.diff(offsets) > 0
        leading = np.zeros(len(full), np.int64)
        leading[full] = data[offsets[:-1][full]] == 0x20
        alone = np.where(full, np.diff(blanks) + 1 - w.counts - leading, 0)
        pieces = np.concatenate([[0], np.cumsum(self.pieces[word])])[w.first]
        scores = np.bincount(w.row, weights=self.scores[word], minlength=len(full))
        return np.diff(pieces) + alone * self.empty[0], scores + alone * self.empty[1]


@lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    return WordCounts(path)


def token_counts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the segmentation's score of every document."""
    path = model or default_model()

    def count(batches: Batches) -> Batches:
        counts = word_counts(path)
        for batch in chunks(batches):
            n, scores = counts.column(text_of(batch))
            columns = [text_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, count, "doc_id long, n_tokens long, score double")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
