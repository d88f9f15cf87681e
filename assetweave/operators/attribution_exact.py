"""Exact Shapley attribution of a cluster to its features, with every row as background.

With some features S kept and the others taken from a background row b, cluster j is
chosen if for each rival r (two with three centers)

    D_j(b) - D_r(b)  <=  D_r(x) - D_j(x)          (< for a rival of lower number)

where D are squared distances over the features outside S for b and inside S for x.
The left sides make b a point, the right sides make x a query, and the value of S is
the share of points in the query's quadrant: one plane of points and queries per S
and cluster. Counting needs no pairs of rows.

With one feature outside S, or one in S, or two centers, a plane is a line
(``Planes.lines``): both conditions are bounds on one number, and the points between
them are a difference of ranks. A line is cut into buckets at quantiles of a sample;
points in lower buckets are prefix sums, those of the query's bucket are sorted.

The other planes:

* Both coordinates of a plane are cut into ``P`` buckets at quantiles of a sample.
  Points in lower buckets of both coordinates are prefix sums of a P x P grid.
* Points in the query's own first bucket: all points and queries of the bucket meet
  in one task, which counts by ranks (blocks of the order of the first coordinate and of
  the ranks of the second).
* Points in lower first buckets, but in the query's own second bucket: the same
  with the second coordinate's buckets.

The planes of an S have three coordinates in common, one per pair of centers, up to
their sign. A coordinate's buckets get the points once, with what each plane needs.

Equal points are one weighted point. A coordinate may be the same for most points, when
two centers agree in a feature: then the other one is the first, and the points of the
large bucket are few, as of the first coordinate they only have its bucket. Queries of a
full bucket are dealt to several tasks, each with the bucket's points. So neither a
frequent row nor a frequent value makes a large task. Work is N log N per plane; a
bucket has about N / P rows, with P growing up to ``MOST_BUCKETS``, which bounds the grid.

Rows are packed, once for all passes over them. They move packed as well: the points or
queries of a bucket in a batch are one row, and so are the counts of a run of rows on
their way back. The coordinates take turns, as many at
a time as move ``TURN_RECORDS``; the counts of a turn are stored and its shuffle files
removed before the next, so that disk holds one turn's.
"""

from __future__ import annotations

import itertools
import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetweave.operators.cluster import nearest
from assetweave.session import new_path, stored

#: rows of a bucket that are aimed at, and buckets of a coordinate
BUCKET_ROWS, MOST_BUCKETS = 100_000, 256
#: rows that the buckets' edges are taken from
SAMPLE = 20_000
#: queries that a bucket gets in one task, and tasks that a bucket may be dealt to
TASK_QUERIES, MOST_DEALT = 400_000, 1 << 12
#: rows that are packed together, and row numbers (as a power of two) whose counts come back together
PACKED_ROWS, RUN = 100_000, 18
#: points and queries that are stored in a row; few enough for Spark's readers, which take thousands of rows at once
STORED_ROWS = 128
#: in place of a query's cluster
A_POINT = -2
#: points and queries that move in one turn
TURN_RECORDS = 200_000_000
#: points that a query is compared with one by one, and blocks of such points (beyond that, they are larger)
BLOCK, MOST_BLOCKS = 256, 1024
#: removes the shuffle files of a query that has ended
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Batches = Iterator[pa.RecordBatch]


def _places(a: np.ndarray, q: np.ndarray, tie: bool) -> np.ndarray:
    """How many of the sorted ``a`` are below each query; ``tie`` tells whether equal ones count."""
    order, out = np.argsort(q), np.empty(len(q), np.int64)
    out[order] = np.searchsorted(a, q[order], "right" if tie else "left")
    return out


class Blocks:
    """Points in rows of ``width``: how much of the first ones of a row is below a limit.

    Marks of points are bits, as are the digits of their weights.
    """

    def __init__(self, values: np.ndarray, weight: np.ndarray | None, width: int):
        def rows(c: np.ndarray) -> np.ndarray:
            return np.concatenate([c, np.zeros(width - len(c) % width, c.dtype)]).reshape(-1, width)

        self.values, self.first = rows(values), np.packbits(np.tri(width + 1, width, -1, dtype=bool), axis=1)
        self.digits = None
        if weight is not None:
            bits = range(int(weight.max(initial=0)).bit_length())
            self.digits = [np.packbits(rows(weight >> bit & 1).astype(bool), axis=1) for bit in bits]

    def below(self, row: np.ndarray, end: np.ndarray, limit: np.ndarray) -> np.ndarray:
        marks = self.values.take(row, axis=0) < limit.astype(self.values.dtype)[:, None]
        marks = np.packbits(marks, axis=1) & self.first.take(end, axis=0)

        def size(bits: np.ndarray) -> np.ndarray:
            return np.bitwise_count(bits.view(np.uint64)).sum(axis=1, dtype=np.int64)

        if self.digits is None:
            return size(marks)
        found = np.zeros(len(row), np.int64)
        for bit, digit in enumerate(self.digits):
            found += size(marks & digit.take(row, axis=0)) << bit
        return found


def _counted(
    symbol: np.ndarray, weight: np.ndarray | None, high: np.ndarray, below: np.ndarray, symbols: int | None = None
) -> np.ndarray:
    """For each query the weight (without one, the number) of the first ``high`` points with a symbol less than ``below``.

    ``symbols`` are few; without it, the symbols are the points' ranks. The points are cut
    into blocks by place, ranks also by rank. Points in lower blocks are prefix sums, those
    in the query's own block are compared.
    """
    n = len(symbol)
    width = max(BLOCK, 1 << (n // MOST_BLOCKS).bit_length())
    group, place = width if symbols is None else 1, np.arange(n)
    shape = n // width + 1, (n if symbols is None else symbols) // group + 1
    grid = np.zeros((shape[0] + 1, shape[1] + 1), np.int64)
    cells = np.bincount(place // width * shape[1] + symbol // group, weight, shape[0] * shape[1])
    grid[1:, 1:] = cells.reshape(shape).cumsum(axis=0).cumsum(axis=1)
    by_place = Blocks(symbol.astype(np.int32) if symbols is None else symbol, weight, width)
    if symbols is None:
        order = np.empty(n, np.int32)
        order[symbol] = place
        by_rank = Blocks(order, None if weight is None else weight[order], width)
    total, step = np.empty(len(high), np.int64), max(1, (1 << 17) // width)
    for at in range(0, len(high), step):
        h, b = high[at : at + step], below[at : at + step]
        i, j = h // width, b // group
        found = grid[i, j] + by_place.below(i, h - i * width, b)
        if symbols is None:
            found += by_rank.below(j, b - j * width, i * width)
        total[at : at + step] = found
    return total


def dominated(
    a: np.ndarray, b: np.ndarray, weight: np.ndarray | None, qa: np.ndarray, qb: np.ndarray, ties: tuple[bool, bool]
) -> np.ndarray:
    """For each query the weight of the points below it in both coordinates; ``ties`` tells where equal counts."""
    order, by_b = np.argsort(a), np.argsort(b)
    high, below = _places(a[order], qa, ties[0]), _places(b[by_b], qb, ties[1])
    rank = np.empty(len(a), np.int64)
    rank[by_b] = np.arange(len(a))
    return _counted(rank[order], None if weight is None else weight[order], high, below)


def in_lower_buckets(
    bucket: np.ndarray, b: np.ndarray, weight: np.ndarray | None, qbucket: np.ndarray, qb: np.ndarray, tie: bool
) -> np.ndarray:
    """The same for points in lower buckets of the first coordinate, of which only the bucket is known."""
    order = np.argsort(b)
    high = _places(b[order], qb, tie)
    return _counted(bucket[order], None if weight is None else weight[order], high, qbucket, MOST_BUCKETS)


def up_to(a: np.ndarray, weight: np.ndarray | None, qa: np.ndarray) -> np.ndarray:
    """The same on a line; equal counts."""
    if weight is None:
        return _places(np.sort(a), qa, True)
    order = np.argsort(a)
    return np.concatenate([[0], np.cumsum(weight[order])])[_places(a[order], qa, True)]


def _before(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values, -np.inf)


class Gaps:
    """D_j - D_r of some rows, over any features."""

    def __init__(self, rows: np.ndarray, centers: np.ndarray):
        self.rows, self.one = rows, {}
        squared = [[(rows[:, i] - c) ** 2 for c in centers[:, i]] for i in range(rows.shape[1])]
        for j, r in itertools.combinations(range(len(centers)), 2):
            self.one[j, r] = [of[j] - of[r] for of in squared]

    def over(self, columns: list[int], j: int, r: int) -> np.ndarray:
        if j > r:
            return -self.over(columns, r, j)
        first, *others = (self.one[j, r][i] for i in columns)
        return sum(others, first)


#: what a rank on a line adds to a plane's count: itself, itself taken off, or the points beyond it
PLUS, MINUS, REST = range(3)


@dataclass
class Planes:
    """The planes of all sets of kept features and clusters, and how they are cut.

    ``axes`` are what points and queries are dealt along: the coordinates of the ``flat``
    planes, which are those that are no lines, and then the ``lines``.
    """

    centers: np.ndarray
    features: int
    clusters: list[int]
    buckets: int = 1
    edges: dict = field(default_factory=dict)

    def __post_init__(self):
        m, k = self.features, len(self.centers)
        sets = [s for r in range(1, m) for s in itertools.combinations(range(m), r)]
        self.all = [(s, j) for s in sets for j in self.clusters]
        self.swapped = [False] * len(self.all)
        self.flat = [p for p, (s, _) in enumerate(self.all) if k == 3 and 1 < len(s) < m - 1]
        self.lines = [("outside", self.outside((i,)), None, None) for i in range(m)]
        for kept, j in self.all:
            if len(kept) == m - 1:
                continue
            if len(kept) == 1:
                self.lines += [("kept", kept, j, side) for side in self.sides(kept[0], j)]
            elif k == 2:
                self.lines.append(("gap", kept, j, None))
        coordinates = [(self.all[p][0], tuple(sorted(pair))) for p in self.flat for pair in self.pairs(p)]
        self.axes = [*dict.fromkeys(coordinates), *self.lines]

    def outside(self, kept) -> tuple[int, ...]:
        return tuple(i for i in range(self.features) if i not in kept)

    def rivals(self, j: int) -> list[int]:
        return [r for r in range(len(self.centers)) if r != j]

    def pairs(self, plane: int) -> list[tuple[int, int]]:
        """(cluster, rival) of the first and the second coordinate."""
        j = self.all[plane][1]
        pairs = [(j, r) for r in self.rivals(j)]
        return pairs[::-1] if self.swapped[plane] else pairs

    def points(self, plane: int, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        outside, gaps = self.outside(self.all[plane][0]), Gaps(rows, self.centers)
        return tuple(gaps.over(outside, *pair) for pair in self.pairs(plane))

    def ties(self, plane: int) -> tuple[bool, ...]:
        return tuple(r > j for j, r in self.pairs(plane))

    def cut(self, sample: np.ndarray, buckets: int) -> None:
        at, gaps, self.buckets = np.arange(1, buckets) / buckets, Gaps(sample, self.centers), buckets
        for kept in {kept for kept, _ in self.all}:
            for pair in gaps.one:
                self.edges[kept, pair] = np.quantile(gaps.over(self.outside(kept), *pair), at)
        for _, line, values, some in self.line_points(gaps):
            found = values[some] if some is not None else values
            found = found[np.isfinite(found)]
            self.edges[line] = np.quantile(found, at) if len(found) else np.zeros(buckets - 1)
        for plane in range(len(self.all)) if len(self.centers) == 3 else ():
            largest = [np.bincount(place).max() for place in self.place(plane, self.points(plane, sample))]
            self.swapped[plane] = bool(largest[0] > largest[1])  # the evener coordinate is the first

    def turned(self, pair: tuple[int, int], bucket):
        """A coordinate's bucket from an axis's, or the other way round: the axis of two centers has the sign of the lower one."""
        return bucket if pair[0] < pair[1] else self.buckets - 1 - bucket

    def bucket(self, kept: tuple[int, ...], pair: tuple[int, int], value: np.ndarray) -> np.ndarray:
        """Of one coordinate."""
        value = value if pair[0] < pair[1] else -value
        return self.turned(pair, np.searchsorted(self.edges[kept, tuple(sorted(pair))], value, "right"))

    def place(self, plane: int, values: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return tuple(self.bucket(self.all[plane][0], *of) for of in zip(self.pairs(plane), values))

    def uses(self, axis) -> list[tuple[int, int]]:
        """(plane, 0 if ``axis`` is its first coordinate, 1 if its second); with one bucket no points lie in lower ones."""
        kept, pair = axis
        found = [(p, [tuple(sorted(q)) for q in self.pairs(p)]) for p in self.flat if self.all[p][0] == kept]
        return [(p, pairs.index(pair)) for p, pairs in found if pair in pairs[: self.buckets]]

    # lines

    def slopes(self, i: int, j: int) -> list[float]:
        return [2 * (self.centers[j, i] - self.centers[r, i]) for r in self.rivals(j)]

    def sides(self, i: int, j: int) -> list[str]:
        """Which ends a cluster's interval of a feature can have."""
        slopes = self.slopes(i, j)
        high = ["high"] if min(slopes) < 0 else []
        return ["low", *high] if max(slopes) > 0 or not high else high

    def interval(self, i: int, j: int, gaps: Gaps, others: tuple[int, ...]) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Where feature ``i`` has to be for cluster ``j``, given the ``others`` of the rows; and for which rows that is anywhere."""
        ends, some, c = {}, np.ones(len(gaps.rows), bool), self.centers[:, i]
        for r, slope in zip(self.rivals(j), self.slopes(i, j)):
            gap = gaps.over(others, j, r)
            if slope == 0:
                some &= gap < 0 if r < j else gap <= 0
                continue
            end = (gap - (c[r] ** 2 - c[j] ** 2)) / slope
            side, inner, tighter = ("low", np.inf, np.maximum) if slope > 0 else ("high", -np.inf, np.minimum)
            if r < j:  # equal goes to the rival
                end = np.nextafter(end, inner)
            ends[side] = tighter(ends[side], end) if side in ends else end
        if len(ends) == 2:
            some &= ends["low"] <= ends["high"]
        return ends or {"low": np.full(len(some), -np.inf)}, some

    def line_points(self, gaps: Gaps, wanted=None):
        """(axis, line, values, which): the points of some lines."""
        first, last = len(self.axes) - len(self.lines), None
        for axis, line in enumerate(self.lines, first):
            if wanted is not None and axis not in wanted:
                continue
            what, kept, j, side = line
            if what == "outside":
                yield axis, line, gaps.rows[:, self.outside(kept)[0]], None
            elif what == "gap":
                yield axis, line, gaps.over(self.outside(kept), j, 1 - j), None
            else:
                if last is None or last[0] != (kept, j):
                    last = (kept, j), self.interval(kept[0], j, gaps, self.outside(kept))
                ends, some = last[1]
                yield axis, line, ends[side], some

    def line_queries(self, gaps: Gaps, j: int, wanted=None):
        """(axis, line, plane, what the rank adds, values, which): the queries of cluster ``j`` on some lines."""
        first = len(self.axes) - len(self.lines)
        for axis, line in enumerate(self.lines, first):
            what, kept, of, side = line
            if (wanted is not None and axis not in wanted) or of not in (None, j):
                continue
            plane = self.all.index((kept, j))
            if what == "outside":
                ends, some = self.interval(self.outside(kept)[0], j, gaps, kept)
                if "high" in ends:
                    yield axis, line, plane, PLUS, ends["high"], some
                if "low" in ends:
                    yield axis, line, plane, MINUS if "high" in ends else REST, _before(ends["low"]), some
            elif what == "gap":
                values = -gaps.over(kept, j, 1 - j)
                yield axis, line, plane, PLUS, values if j == 0 else _before(values), None
            elif side == "low":
                yield axis, line, plane, PLUS, gaps.rows[:, kept[0]], None
            else:
                both = len(self.sides(kept[0], j)) == 2
                yield axis, line, plane, MINUS if both else REST, _before(gaps.rows[:, kept[0]]), None

    def weights(self, by_number: bool) -> list[list[float]]:
        """What a plane's share adds to the attribution of every feature; then the same to take off."""
        m, out = self.features, []
        for kept, j in self.all:
            size, factor = len(kept), j if by_number else 1
            with_it = math.factorial(size - 1) * math.factorial(m - size) / math.factorial(m)
            without = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
            out.append([factor * (with_it if i in kept else -without) for i in range(m)])
        return out + [[-w for w in of] for of in out]


def _collapsed(along: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Points (``along``, others, weight) sorted by ``along``, equal ones as one if that makes them notably fewer."""
    *others, weight = rest
    order = np.argsort(along)
    of = along[order]
    tied = np.zeros(len(of) + 1, bool)
    tied[1:-1] = of[1:] == of[:-1]
    at = np.flatnonzero(tied[1:] | tied[:-1])
    if not len(at):
        return of, *(c[order] for c in rest)
    if others:
        some = order[at]
        order[at] = some[np.lexsort((*(c[some] for c in others), along[some]))]
    columns = [c[order] for c in (along, *others)]
    new = _starts(*columns)
    if len(new) > 0.9 * len(of):
        return *columns, weight[order]
    return *(c[new] for c in columns), np.add.reduceat(weight[order], new)


def _packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values from each start to the next as one binary."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).view(np.uint8))]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _records(**columns: np.ndarray) -> np.ndarray:
    """Columns side by side."""
    out = np.empty(len(next(iter(columns.values()))), [(name, c.dtype) for name, c in columns.items()])
    for name, c in columns.items():
        out[name] = c
    return out


def _record(m: int) -> np.dtype:
    """A point, with its weight, or a query, with its row and ``own``."""
    return np.dtype([("x", np.float64, m), ("number", np.int64), ("own", np.int32)])


def _rows_packed(m: int):
    """(records): points and queries, some to a row, as all later passes read them."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            records = np.empty(batch.num_rows, _record(m))
            records["x"] = np.stack([batch.column(i).to_numpy() for i in range(m)], 1)
            records["number"], records["own"] = (batch.column(m + i).to_numpy() for i in range(2))
            yield pa.RecordBatch.from_arrays([_packed(records, np.arange(0, len(records), STORED_ROWS))], ["records"])

    return run


def _joined(batches: Batches, m: int):
    """x, weight, own, query and row of as many rows as are packed together."""

    def out(records: np.ndarray):
        own, number = (np.ascontiguousarray(records[name]) for name in ("own", "number"))
        return np.ascontiguousarray(records["x"]), number, own, own != A_POINT, number

    held, n = [], 0
    for batch in batches:
        for records in batch.column(0).to_pylist():
            held.append(records)
            n += len(records) // _record(m).itemsize
            if n >= PACKED_ROWS:
                yield out(np.frombuffer(b"".join(held), _record(m)))
                held, n = [], 0
    if held:
        yield out(np.frombuffer(b"".join(held), _record(m)))


def _asked(planes: Planes, x: np.ndarray, own: np.ndarray, query: np.ndarray, row: np.ndarray):
    """(cluster, rows that ask for it, their gaps); rows whose numbers differ in their last 32 bits only."""
    for high in np.unique(row[query] >> 32):
        for j in planes.clusters:
            at = np.flatnonzero(query & ((own == j) | (own < 0)) & (row >> 32 == high))
            if len(at):
                yield j, row[at], Gaps(x[at], planes.centers)


def _tallies(planes: Planes) -> dict[tuple, int]:
    """The lengths of the arrays that are counted before points and queries move."""
    p = planes.buckets
    grids = {("grid", plane): p * p for plane in planes.flat}
    lines = {("line", axis): p for axis, line in enumerate(planes.axes) if line in planes.lines}
    return grids | lines | {("asked", axis): p for axis in range(len(planes.axes))}


def _census(shared, m: int):
    """(name, n): a task's points per cell of every plane's grid and per bucket of every line, and its queries per bucket of every axis."""

    def run(batches: Batches) -> Batches:
        planes = pickle.loads(shared.value)
        p, flat = planes.buckets, [(plane, planes.all[plane][1]) for plane in planes.flat]
        tallies = {name: np.zeros(n, np.int64) for name, n in _tallies(planes).items()}
        number = {axis: i for i, axis in enumerate(planes.axes)}

        def add(name: tuple, places: np.ndarray, weight: np.ndarray | None = None) -> None:
            found = np.bincount(places, weight, len(tallies[name]))
            tallies[name] += found.astype(np.int64)

        def buckets(gaps: Gaps, of: str, sign: int, axes: set) -> dict:
            """Of the coordinates of flat planes, each once."""
            out = {}
            for kept, pair in axes:
                values = gaps.over(planes.outside(kept) if of == "points" else kept, *pair)
                out[kept, pair] = np.searchsorted(planes.edges[kept, pair], sign * values, "right").astype(np.uint16)
            return out

        def coordinates(plane: int) -> list[tuple]:
            return [(planes.all[plane][0], tuple(sorted(pair))) for pair in planes.pairs(plane)]

        coordinates_of = {plane: coordinates(plane) for plane, _ in flat}
        for x, weight, own, query, row in _joined(batches, m):
            if not query.all():
                gaps, w = Gaps(x[~query], planes.centers), weight[~query]
                w = w if (w != 1).any() else None
                found = buckets(gaps, "points", 1, {c for of in coordinates_of.values() for c in of})
                for plane, _ in flat:
                    first, second = (
                        planes.turned(pair, found[c].astype(np.int64)) for pair, c in zip(planes.pairs(plane), coordinates_of[plane])
                    )
                    add(("grid", plane), first * p + second, w)
                for axis, line, values, some in planes.line_points(gaps):
                    place = np.searchsorted(planes.edges[line], values, "right")
                    mine = w if some is None or w is None else w[some]
                    add(("line", axis), place if some is None else place[some], mine)
            for j, _, gaps in _asked(planes, x, own, query, row):
                mine = {c for plane, of in flat if of == j for c in coordinates_of[plane]}
                for c, place in buckets(gaps, "queries", -1, mine).items():
                    add(("asked", number[c]), place)
                for axis, line, _, _, values, some in planes.line_queries(gaps, j):
                    place = np.searchsorted(planes.edges[line], values if some is None else values[some], "right")
                    add(("asked", axis), place)
        for at, found in enumerate(tallies.values()):
            if found.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([found.tobytes()])], ["name", "n"])

    return run


def _added(batches: Batches) -> Batches:
    """The sum of the arrays of a name."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for name, n in zip(*(c.to_pylist() for c in batch.columns)):
            n = np.frombuffer(n, np.int64)
            sums[name] = sums[name] + n if name in sums else n
    for name, n in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), pa.array([n.tobytes()])], ["name", "n"])


#: what a packed row holds: points, points with weights; above that, queries
POINTS, WEIGHTED, QUERIES = range(3)


def _deal(shared, dealt, m: int, turn: range):
    """(key, kind, base, records): packed points and queries of a bucket of every axis in ``turn``.

    A point has its place ``along`` the axis. For each plane with the axis as its first
    coordinate it has the second one, and with the axis as its second coordinate the
    first one's bucket. So has a query, with its row from ``base`` on.
    """

    def run(batches: Batches) -> Batches:
        planes, parts = pickle.loads(shared.value), dealt.value
        names = ["key", "kind", "base", "records"]
        coordinates = {axis: planes.axes[axis] for axis in turn if planes.axes[axis] not in planes.lines}
        used = {axis: planes.uses(of) for axis, of in coordinates.items()}
        coordinates = {axis: of for axis, of in coordinates.items() if used[axis]}

        def pack(axis: int, kind: int, bucket, part, base: int, records) -> pa.RecordBatch:
            starts = _starts(bucket, part)
            key = (axis * planes.buckets + bucket[starts].astype(np.int64)) * MOST_DEALT + part[starts]
            same = [pa.array(np.full(len(key), kind, np.int32)), pa.array(np.full(len(key), base, np.int64))]
            return pa.RecordBatch.from_arrays([pa.array(key), *same, _packed(records, starts)], names)

        def other(gaps: Gaps, of, sign: int, plane: int, role: int) -> np.ndarray:
            """What a point or query has for a plane besides its place along an axis."""
            pair = planes.pairs(plane)[1 - role]
            value = sign * gaps.over(of, *pair)
            return value if role == 0 else planes.bucket(planes.all[plane][0], pair, value).astype(np.uint8)

        def points(axis: int, edges: np.ndarray, along: np.ndarray, others: list[np.ndarray], weight: np.ndarray):
            along, *others, n = _collapsed(along, *others, weight)
            if not len(along):
                return
            starts = np.searchsorted(along, edges, "left")
            bucket = np.repeat(np.arange(planes.buckets), np.diff(np.concatenate([[0], starts, [len(along)]])))
            weighted = (n != 1).any()
            columns = {"along": along} | {f"of{i}": c for i, c in enumerate(others)} | ({"weight": n} if weighted else {})
            batch = pack(axis, WEIGHTED if weighted else POINTS, bucket, np.zeros_like(bucket), 0, _records(**columns))
            # a bucket's points go to each of its tasks
            tasks = parts[axis, bucket[_starts(bucket)]]
            if (tasks > 1).any():
                at = np.repeat(np.arange(len(tasks)), tasks)
                part = np.arange(len(at)) - np.repeat(np.cumsum(tasks) - tasks, tasks)
                batch = batch.take(pa.array(at))
                key = pa.array(batch.column(0).to_numpy() + part)
                batch = pa.RecordBatch.from_arrays([key, *batch.columns[1:]], names)
            yield batch

        def queries(axis: int, edges: np.ndarray, kind: int, along: np.ndarray, others: dict, row: np.ndarray):
            if not len(row):
                return
            bucket = np.searchsorted(edges, along, "right").astype(np.uint8)
            if (parts[axis] > 1).any():
                part = row % parts[axis, bucket]
                order = np.lexsort((part, bucket))
                part = part[order]
            else:
                order = np.argsort(bucket, kind="stable")
                part = np.zeros(len(order), np.int64)
            columns = {"along": along} | others | {"row": row.astype(np.uint32)}
            records = _records(**{name: c[order] for name, c in columns.items()})
            yield pack(axis, QUERIES + kind, bucket[order], part, int(row[0]) >> 32 << 32, records)

        for x, weight, own, query, row in _joined(batches, m):
            if not query.all():
                gaps, w = Gaps(x[~query], planes.centers), weight[~query]
                for axis, (kept, pair) in coordinates.items():
                    outside = planes.outside(kept)
                    others = [other(gaps, outside, 1, *use) for use in used[axis]]
                    yield from points(axis, planes.edges[kept, pair], gaps.over(outside, *pair), others, w)
                for axis, line, values, some in planes.line_points(gaps, turn):
                    mine = (values, w) if some is None else (values[some], w[some])
                    yield from points(axis, planes.edges[line], mine[0], [], mine[1])
            for j, asked, gaps in _asked(planes, x, own, query, row):
                for axis, (kept, pair) in coordinates.items():
                    along = -gaps.over(kept, *pair)
                    for plane, role in used[axis]:
                        if planes.all[plane][1] == j:
                            of = {"other": other(gaps, kept, -1, plane, role)}
                            yield from queries(axis, planes.edges[kept, pair], 2 * plane + role, along, of, asked)
                for axis, line, plane, adds, values, some in planes.line_queries(gaps, j, turn):
                    mine = (values, asked) if some is None else (values[some], asked[some])
                    yield from queries(axis, planes.edges[line], 3 * plane + adds, mine[0], {}, mine[1])

    return run


def _ids(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, np.uint32 if len(ids) == 4 * n else np.int64).astype(np.int64)


def _count(shared, before):
    """(run, plane, row, n): points below each query, bucket by bucket, packed by runs of rows.

    ``before`` has the points in lower buckets, of every flat plane's grid and every line.
    """

    def run(batches: Batches) -> Batches:
        planes, (grids, lines) = pickle.loads(shared.value), before.value

        def out(plane: int, row: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            runs = row >> RUN
            if (np.diff(runs) < 0).any():
                order = np.argsort(runs, kind="stable")
                row, n, runs = row[order], n[order], runs[order]
            starts = _starts(runs)
            small = n.max() < 1 << 32
            columns = [
                pa.array(runs[starts]),
                pa.array(np.full(len(starts), plane, np.int32)),
                _packed((row & (1 << RUN) - 1).astype(np.uint32), starts),
                _packed(n.astype(np.uint32) if small else n, starts),
            ]
            return pa.RecordBatch.from_arrays(columns, ["run", "plane", "row", "n"])

        def counted(group: int, held: dict[int, list]) -> Batches:
            axis, bucket = divmod(group // MOST_DEALT, planes.buckets)
            line = axis if planes.axes[axis] in planes.lines else None
            used = [] if line is not None else planes.uses(planes.axes[axis])
            numbers = [("row", np.uint32)]
            fields = [("along", np.float64), *((f"of{i}", (np.float64, np.uint8)[role]) for i, (_, role) in enumerate(used))]
            found = [np.frombuffer(records, fields) for _, records in held.get(POINTS, [])]
            weighted = [np.frombuffer(records, [*fields, ("weight", np.int64)]) for _, records in held.get(WEIGHTED, [])]
            columns = {name: np.concatenate([c[name] for c in (*found, *weighted)] or [np.zeros(0, kind)]) for name, kind in fields}
            weight = None
            if weighted:
                weight = np.concatenate([np.ones(sum(map(len, found)), np.int64), *(c["weight"] for c in weighted)])
            for kind in held:
                if kind < QUERIES:
                    continue
                plane, role = divmod(kind - QUERIES, 2 if line is None else 3)
                more = [] if line is not None else [("other", (np.float64, np.uint8)[role])]
                asked = [(base, np.frombuffer(records, [("along", np.float64), *more, *numbers])) for base, records in held[kind]]
                row = np.concatenate([base + c["row"].astype(np.int64) for base, c in asked])
                along = np.concatenate([c["along"] for _, c in asked])
                if line is not None:
                    n = up_to(columns["along"], weight, along) + lines[line][bucket]
                    if role == REST:
                        n = lines[line][-1] - n
                    yield out(plane + (len(planes.all) if role == MINUS else 0), row, n)
                    continue
                at = used.index((plane, role))
                pairs, ties = planes.pairs(plane), planes.ties(plane)
                mine, other = columns["along"], np.concatenate([c["other"] for _, c in asked])
                if pairs[role][0] > pairs[role][1]:
                    mine, along = -mine, -along
                if role == 0:
                    second = planes.bucket(planes.all[plane][0], pairs[1], other)
                    n = dominated(mine, columns[f"of{at}"], weight, along, other, ties)
                    n = n + grids[plane][planes.turned(pairs[0], bucket), second]
                else:
                    n = in_lower_buckets(columns[f"of{at}"], mine, weight, other, along, ties[1])
                yield out(plane, row, n)

        group, held = -1, {}
        for batch in batches:
            for key, kind, base, records in zip(*(c.to_pylist() for c in batch.columns)):
                if key != group:
                    if held:
                        yield from counted(group, held)
                    group, held = key, {}
                held.setdefault(kind, []).append((base, records))
        if held:
            yield from counted(group, held)

    return run


def _summed(weights: list[list[float]], total: int, m: int):
    """(row, _sum0, ...): the planes' shares by their weights, added up run by run."""
    names = ["row", *(f"_sum{i}" for i in range(m))]

    def run(batches: Batches) -> Batches:
        def out(at: int, seen: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            found = np.flatnonzero(seen)
            return pa.RecordBatch.from_arrays([pa.array((at << RUN) + found), *(pa.array(c[found]) for c in sums)], names)

        at, seen, sums = None, None, None
        for batch in batches:
            for run_, plane, row, n in zip(*(c.to_pylist() for c in batch.columns)):
                if run_ != at:
                    if at is not None:
                        yield out(at, seen, sums)
                    at, seen, sums = run_, np.zeros(1 << RUN, bool), np.zeros((m, 1 << RUN))
                row = np.frombuffer(row, np.uint32)
                share = _ids(n, len(row)) / total
                seen[row] = True
                for i, weight in enumerate(weights[plane]):
                    sums[i][row] += share * weight
        if at is not None:
            yield out(at, seen, sums)

    return run


def attribution_exact(
    df: DataFrame,
    features: list[str],
    centers: list[list[float]],
    background: DataFrame | None = None,
    target: str | int = "own",
    keep: tuple[str, ...] = (),
    bucket_rows: int = BUCKET_ROWS,
    task_queries: int = TASK_QUERIES,
    turn_records: int = TURN_RECORDS,
) -> DataFrame:
    """``keep``, ``cluster`` and ``phi_<feature>`` of every row whose features are complete.

    All rows of ``background`` (without one, of ``df``) with complete features count,
    each once. ``target`` as in ``attribution``: "own", a cluster's number, or "id".
    Two or three centers.
    """
    if len(centers) not in (2, 3):
        raise ValueError("exact attribution takes two or three centers")
    spark, m = df.sparkSession, len(features)
    middles = np.asarray(centers, dtype=float)
    doubles = [F.col(c).cast("double").alias(c) for c in features]
    rows = df.select(*[c for c in keep if c not in features], *doubles).na.drop(subset=features)
    rows = rows.withColumns({"cluster": nearest(features, centers), "_row": F.monotonically_increasing_id()})
    rows = stored(rows, "explained-rows")
    of = rows if background is None else background.select(*doubles).na.drop(subset=features)
    points = stored(of.groupBy(*features).agg(F.count(F.lit(1)).alias("_weight")), "points")
    n_points, total = points.agg(F.count(F.lit(1)), F.coalesce(F.sum("_weight"), F.lit(0))).first()
    if not total:
        raise ValueError("the background has no rows")

    # the two sets without a plane: all features kept, and none
    sizes = of.select(nearest(features, centers).alias("c")).groupBy("c").count().collect()
    chance = [0.0] * len(centers)
    for r in sizes:
        chance[r["c"]] = r["count"] / total
    if isinstance(target, int):
        first, last = F.lit(chance[target]), (F.col("cluster") == target).cast("double")
    elif target == "id":
        first, last = F.lit(sum(j * c for j, c in enumerate(chance))), F.col("cluster").cast("double")
    else:
        first, last = F.array(*map(F.lit, chance))[F.col("cluster")], F.lit(1.0)
    if m == 1:  # no sets in between
        return rows.select(*keep, F.col("cluster"), (last - first).alias(f"phi_{features[0]}"))

    planes = Planes(middles, m, [target] if isinstance(target, int) else list(range(len(centers))))
    sample = points.orderBy(F.xxhash64(*features)).limit(SAMPLE).select(*features).toPandas().to_numpy(dtype=float)
    planes.cut(sample, min(MOST_BUCKETS, max(1, -(-n_points // bucket_rows))))
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # with its class, which workers need not have
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(planes))

    # -1: the query is asked of every cluster
    asked = F.col("cluster") if target == "own" else F.lit(-1)
    both = rows.select(*features, F.col("_row").alias("number"), asked.cast("int").alias("own")).unionByName(
        points.select(*features, F.col("_weight").alias("number"), F.lit(A_POINT).alias("own"))
    )
    both = stored(both.mapInArrow(_rows_packed(m), "records binary"), "points-and-queries")
    counted = both.mapInArrow(_census(shared, m), "name int, n binary")
    counted = counted.repartition("name").mapInArrow(_added, "name int, n binary")
    p, names = planes.buckets, list(_tallies(planes).items())
    tallies = {name: np.zeros(n, np.int64) for name, n in names}
    for r in counted.collect():  # a row per plane and axis
        tallies[names[r["name"]][0]] = np.frombuffer(r["n"], np.int64)
    grids, lines = {}, {}
    for (what, at), n in tallies.items():
        if what == "grid":
            grids[at] = np.zeros((p + 1, p + 1), np.int64)
            grids[at][1:, 1:] = n.reshape(p, p).cumsum(axis=0).cumsum(axis=1)
        elif what == "line":
            lines[at] = np.concatenate([[0], np.cumsum(n)])
    before = spark.sparkContext.broadcast((grids, lines))
    asks = np.stack([tallies["asked", axis] for axis in range(len(planes.axes))])
    dealt = spark.sparkContext.broadcast(np.clip(-(-asks // task_queries), 1, MOST_DEALT))

    path, cleanup = new_path(spark, "counts"), spark.conf.get(CLEANUP, "false")
    n_axes = len(planes.axes)
    at_once = max(1, int(turn_records * n_axes // max(1, n_points * n_axes + asks.sum())))
    spark.conf.set(CLEANUP, "true")
    try:
        for start in range(0, n_axes, at_once):
            turn = range(start, min(start + at_once, n_axes))
            spread = both.mapInArrow(_deal(shared, dealt, m, turn), "key long, kind int, base long, records binary")
            spread = spread.repartition("key").sortWithinPartitions("key")
            found = spread.mapInArrow(_count(shared, before), "run long, plane int, row binary, n binary")
            found.write.mode("append").parquet(path)
    finally:
        spark.conf.set(CLEANUP, cleanup)

    found = spark.read.schema("run long, plane int, row binary, n binary").parquet(path)
    found = found.repartition("run").sortWithinPartitions("run")
    sums = ", ".join(["row long", *(f"_sum{i} double" for i in range(m))])
    summed = found.mapInArrow(_summed(planes.weights(target == "id"), total, m), sums)

    # a row may have no points in any of its quadrants
    joined = rows.join(summed, rows["_row"] == summed["row"], "left")
    edges, sums = (last - first) / m, [F.coalesce(F.col(f"_sum{i}"), F.lit(0.0)) for i in range(m)]
    return joined.select(*keep, "cluster", *[(s + edges).alias(f"phi_{c}") for s, c in zip(sums, features)])


def largest_gap(exact: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Per attribution the largest difference between two results over the same rows."""
    phis = [c for c in exact.columns if c.startswith("phi_")]
    renamed = other.select(*keys, *[F.col(c).alias(f"_{c}") for c in phis])
    return exact.join(renamed, keys).agg(*[F.max(F.abs(F.col(c) - F.col(f"_{c}"))).alias(c) for c in phis])
