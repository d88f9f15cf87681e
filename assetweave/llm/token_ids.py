"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece of text encoded once per worker.

The tokenizer splits at white space and between letters and punctuation before
it merges, so a text's ids are its pieces' ids in order. Pieces are cut only
where that holds for certain: at ASCII white space, and between a Latin letter
and ASCII punctuation other than the apostrophe. A text that holds one of the
tokenizer's special tokens goes to the library whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from assetweave.llm.text import LOWER, NOT_SPACE, HashCache, bounds, buffers, distinct

LETTER, PUNCTUATION = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = LETTER
for _c in b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~":
    _KIND[_c] = PUNCTUATION


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _kinds(data: np.ndarray) -> np.ndarray:
    """Letters (ASCII, and U+00C0 to U+00FF but the two signs), ASCII punctuation, or 0."""
    kind = _KIND[data]
    if len(data) > 1:
        two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[two] = kind[two + 1] = LETTER
    return kind


class TokenIds:
    """Encodes columns of texts; keeps the ids of distinct pieces between calls, ``most`` of them."""

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.cache = HashCache(self.most)
        self.ids, self.begin, self.length = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint16)

    def _encode(self, pieces: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and each piece's number of ids.

        A plain piece (letters only, or punctuation only) ends with its only
        word-end token, so many of them can be encoded as one text.
        """
        if not plain:
            found = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
            flat = np.array([i for ids in found for i in ids], np.uint16)
            return flat, np.array([len(ids) for ids in found], np.int64)
        texts = [b" ".join(pieces[k : k + 1000]).decode() for k in range(0, len(pieces), 1000)]
        found = [np.array(e.ids, np.uint16) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([np.zeros(0, np.uint16), *found])
        return flat, np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint16) of all rows one after the other, and the offsets of the rows in them."""
        data, offsets = buffers(column)
        kind = _kinds(data)
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] + kind[:-1] == LETTER + PUNCTUATION) & (kind[1:] * kind[:-1] > 0)
        words = bounds(LOWER[data], offsets, NOT_SPACE[data], cut)
        keys, first, inverse = distinct(words.hashes())
        if len(self.cache.keys) + len(keys) > self.most:
            self._clear()
        at = self.cache.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            changes = np.cumsum(np.diff(kind, prepend=kind[:1]) != 0)
            begin, last = words.start[first[new]], words.end[first[new]] - 1
            plain = (kind[begin] > 0) & (changes[begin] == changes[last])
            for some, is_plain in ((new[plain], True), (new[~plain], False)):
                ids, length = self._encode([words.bytes_of(i) for i in first[some]], is_plain)
                at[some] = len(self.begin) + np.arange(len(some))
                self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(length) - length])
                self.length = np.concatenate([self.length, length])
                self.ids = np.concatenate([self.ids, ids])
            self.cache.add(keys[new], at[new])
        piece = at[inverse]
        length = self.length[piece]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.begin[piece] - total[:-1], length)]
        ends = total[words.first]
        special = self._special_rows(column)
        if not len(special):
            return ids, ends
        rows = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for i in special:
            rows[i] = self._whole(column[int(i)].as_py())
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    def _special_rows(self, column: pa.Array) -> np.ndarray:
        found = np.zeros(len(column), bool)
        for token in self.special:
            found |= pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        return np.flatnonzero(found)


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    """One encoder per worker process and file, so that later tasks find the pieces of earlier ones."""
    return TokenIds(path)
