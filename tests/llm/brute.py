"""Plain versions of the operators' results, straight from their definitions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(A_TO_Z)


def remainder(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


@lru_cache
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(text, end):
    return np.array(tokenizer().encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def base_spans(text):
    assign = re.compile(
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
        r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found)]


def secrets(text):
    spans = base_spans(text or "")
    counts = Counter(s.split(":")[0] for s in spans)
    digest = hashlib.sha256(",".join(spans).encode()).hexdigest()
    return counts["assign"], counts["access"], counts["hex"], digest


def shingle_set(text):
    w = SPACED.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_duplicates(docs, least=80):
    """(doc_id, n_shingles, component_id) of every row, by comparing all sets."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_id = {}
    for i, (doc_id, _) in enumerate(docs):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= least * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
        by_id.setdefault(doc_id, i)
    least_id = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least_id[root(i)] = min(doc_id, least_id.get(root(i), doc_id))
    return [(d, len(sets[i]), least_id.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def contamination(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(1, len(w) - window + 1)) if w else []:
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w, found = ALNUM.findall(lower(text)), set()
        hit = [False] * len(w)
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit[k : k + size] = [True] * size
                    found |= windows[tuple(w[k : k + size])]
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(w), sum(hit), len(names), digest, any(hit)))
    return out


class Language:
    """Word counts and byte contexts of training texts."""

    def __init__(self, docs, depth=5):
        self.words, self.depth = Counter(), depth
        self.contexts = defaultdict(Counter)  # from the longest to the empty one
        for doc_id, text in docs:
            if remainder(doc_id, 7) != 2:
                self.words.update([*SPACED.findall(lower(text)), None])
                for context, symbol in self.symbols(text):
                    for k in range(depth + 1):
                        self.contexts[context[k:]][symbol] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)

    def symbols(self, text):
        s = (*[256] * self.depth, *(text or "").encode(), 256)
        return [(s[i : i + self.depth], s[i + self.depth]) for i in range(len(s) - self.depth)]

    def base(self, text):
        tokens = [*SPACED.findall(lower(text)), None]
        score = sum(math.log10((self.words[t] + 1) / (self.n + 1 * (self.v + 1))) for t in tokens)
        return len(tokens), sum(self.words[t] > 0 for t in tokens), score

    @lru_cache(maxsize=None)
    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.depth + 1):
            free = {s: n for s, n in self.contexts.get(context[k:], {}).items() if s not in excluded}
            n, kinds = sum(free.values()), len(free)
            rest = len(excluded) + kinds < 257
            if symbol in free:
                return p * free[symbol] / (n + kinds if rest else n)
            if n:
                p *= kinds / (n + kinds)
            excluded |= free.keys()
        return p / (257 - len(excluded))

    def score(self, text):
        return sum(math.log10(self.probability(*x)) for x in self.symbols(text))


def neighbours(rows, k=20, every=20):
    """{query row: [(vec_id, score)]} by all inner products; rows are (vec_id, vector)."""
    good = []
    for i, (vec_id, v) in enumerate(rows):
        if v and None not in v and all(map(math.isfinite, v)) and any(v):
            good.append((i, vec_id, np.array(v, float)))
    sizes = Counter(len(v) for _, _, v in good)
    size = min(sizes, key=lambda n: (-sizes[n], n)) if sizes else 0
    good = [g for g in good if len(g[2]) == size]
    out = {}
    for i, vec_id, v in good:
        if vec_id is not None and vec_id % every == 0:
            found = [(-float((v * x).sum()), other is None, other or 0) for j, other, x in good if j != i]
            out[i] = [(None if none else other, -s) for s, none, other in sorted(found)[:k]]
    return out
