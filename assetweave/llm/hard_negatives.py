"""Op 13: hard negatives of labelled vectors by angular triangle filtering.

Every row keeps its norm and its angles to a few reference directions. For an anchor at
angle a and a row at angle x from a direction, the angle between the two lies between
|a - x| and min(a + x, 2 pi - a - x): an interval for their cosine and, times both
norms, for their score, widened for rounding so that no score can fall outside.
Rows are sorted by nearest direction and angle to it and stored in parts of up to
``PART_ROWS`` rows. Against a part an anchor first takes the stretch of angles that
can overlap its window of scores (two binary searches), then the intervals of all
directions row by row, and only rows whose interval still overlaps get an integer
inner product. The window is open upwards for positives, with the score of the last
one kept as its floor; for negatives it runs from the lowest to the highest share of
the positives' scores. Results are exact for any directions; these decide only how
many rows are scored. They are found farthest first among ``SAMPLE`` rows (first by hash).

Anchors are a stated query set: they go in blocks of ``BLOCK`` against all parts, each
task keeps what may be among the first, and the first of groups of tasks and then of
all remain, so no group of rows grows with the table.

No part take rows with a null label or vector, an empty vector, a null or non-finite
component, a length other than the commonest (ties: the shorter), or a norm of 2^31
or more after scaling, whose scores would leave 64 bits. Repeated vec_ids are rows by
themselves. A row without a vec_id is no anchor, comes last among equal scores, and
keeps its label. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetweave.llm.tasks import Batches, map_batches
from assetweave.session import stored

ANCHORS, FLIPPED, LABELS, SCALE = 100, 7, 10, 256
POSITIVES, NEGATIVES = 5, 10
#: a negative's score is at least and at most so many hundredths of the positive's
LOWEST, HIGHEST = 30, 90
DIRECTIONS, SAMPLE = 8, 4096
PART_ROWS, BLOCK = 4096, 2048
#: what rounding may move an angle by (an arc cosine near 0 or pi loses half the digits), and a score in parts of the norms
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
#: groups of tasks whose rows are compared first
GROUPS = 64
LAST = np.iinfo(np.int64).max

_ROW = "row long, vec_id long, label long, v array<long>"
_PART = "directions int, n int, ids binary, norms binary, angles binary, vectors binary"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): labels as they count, components scaled to integers."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    # products of norms bound scores; larger components are also no 64-bit integers
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + (c * SCALE) * (c * SCALE))
    rows = rows.where(square < 2.0**61)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (sizes["n"] if sizes else 0))
    flipped = F.when(F.coalesce(F.col("vec_id") % FLIPPED == 0, F.lit(False)), (F.col("label") + 1) % LABELS)
    return rows.select(
        "vec_id", flipped.otherwise(F.col("label")).alias("label"), F.transform("v", lambda c: F.floor(c * SCALE)).alias("v")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def norms_of(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))


def directions(v: np.ndarray, most: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors, each the row that lies farthest from the ones before; fewer if rows repeat."""
    x = v.astype(np.float64)
    x = x[norms_of(v) > 0]
    if not len(x):
        return np.eye(1, v.shape[1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    chosen, near = [0], x @ x[0]
    while len(chosen) < most:
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        chosen.append(far)
        near = np.maximum(near, x @ x[far])
    return x[chosen]


def angles_to(v: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Rows x directions; a zero vector counts as at right angles."""
    norms = norms_of(v)
    cosines = v.astype(np.float64) @ refs.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def score_bounds(angle: np.ndarray, norm: float, angles: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of an anchor with every row, by all directions."""
    least = np.maximum(np.abs(angles - angle).max(axis=1) - ANGLE_SLACK, 0)
    total = angles + angle
    most = np.minimum(np.minimum(total, 2 * np.pi - total).min(axis=1) + ANGLE_SLACK, np.pi)
    size = norm * norms
    slack = SCORE_SLACK * size + 1e-6
    # the widened interval may be empty to the eye where rounding meets; order the ends
    high, low = size * np.cos(np.minimum(least, np.pi)), size * np.cos(most)
    return np.minimum(low, high) - slack, np.maximum(low, high) + slack


def scores_of(anchor: np.ndarray, v: np.ndarray, norm: float, norms: np.ndarray) -> np.ndarray:
    """Exact integer inner products; doubles carry them while no partial sum can leave 2^53."""
    if len(v) and norm * norms.max() < 2.0**52:
        return (v.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return v @ anchor


class Part:
    """Rows near one direction, by angle to it."""

    def __init__(self, direction: int, n: int, ids: bytes, norms: bytes, angles: bytes, vectors: bytes):
        self.direction = direction
        self.row, self.vec, self.label = np.frombuffer(ids, np.int64).reshape(3, n)
        self.norms = np.frombuffer(norms, np.float64)
        self.angles = np.frombuffer(angles, np.float64).reshape(n, -1)
        self.v = np.frombuffer(vectors, np.int64).reshape(n, -1)
        self.longest = float(self.norms.max())
        self.by = np.ascontiguousarray(self.angles[:, direction])

    def stretch(self, angle: float, norm: float, low: float) -> tuple[int, int]:
        """Rows whose angle to the part's direction allows a score of ``low``."""
        size = norm * self.longest
        if low > size * (1 + SCORE_SLACK) + 1e-6:
            return 0, 0
        if low <= 0 or not size:  # scores of zero and below need no narrow angle
            return 0, len(self.by)
        reach = np.arccos(min(1.0, max(-1.0, low / size - 2 * SCORE_SLACK))) + 2 * ANGLE_SLACK
        return int(np.searchsorted(self.by, angle - reach)), int(np.searchsorted(self.by, angle + reach, "right"))

    def overlapping(self, angles: np.ndarray, norm: float, low: float, high: float, wanted: np.ndarray) -> np.ndarray:
        """Rows among ``wanted`` whose score may lie between ``low`` and ``high``."""
        a, b = self.stretch(angles[self.direction], norm, low)
        some = a + np.flatnonzero(wanted[a:b])
        if len(some):
            least, most = score_bounds(angles, norm, self.angles[some], self.norms[some])
            some = some[(most >= low) & (least <= high)]
        return some


def _first(score: np.ndarray, vec: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k``: higher score, smaller vec_id (none: last), row."""
    if len(score) > k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort([row[some], vec[some], -score[some]])][:k]


class Seeking:
    """Anchors of a block and what a task has found for them."""

    def __init__(self, row, vec, label, v, refs):
        self.row, self.vec, self.label, self.v = row, vec, label, v
        self.norm, self.angles = norms_of(v), angles_to(v, refs)

    def positives(self, parts, k: int):
        """(anchor, score, vec, row) of the first ``k`` others of each anchor's label; and how many rows were scored."""
        held = [np.zeros((0, 3), np.int64) for _ in self.row]
        floor, scored = np.full(len(self.row), -np.inf), 0
        for part in parts:
            for i in range(len(self.row)):
                wanted = (part.label == self.label[i]) & (part.row != self.row[i])
                some = part.overlapping(self.angles[i], self.norm[i], floor[i], np.inf, wanted)
                scored += len(some)
                if not len(some):
                    continue
                score = scores_of(self.v[i], part.v[some], self.norm[i], part.norms[some])
                new = np.concatenate([held[i], np.stack([score, part.vec[some], part.row[some]], 1)])
                held[i] = new[_first(*new.T, k)]
                if len(held[i]) == k:
                    floor[i] = held[i][-1, 0]
        return held, scored

    def negatives(self, parts, positives: list[np.ndarray], k: int, lowest: int, highest: int):
        """Per anchor and place among its positives the first ``k`` rows of other labels within the window."""
        held = [[np.zeros((0, 3), np.int64) for _ in p] for p in positives]
        scored = 0
        for part in parts:
            for i, own in enumerate(positives):
                if not len(own):
                    continue
                low, high = -(-lowest * own // 100), highest * own // 100
                least = [h[-1, 0] if len(h) == k else a for h, a in zip(held[i], low.tolist())]
                wanted = part.label != self.label[i]
                some = part.overlapping(self.angles[i], self.norm[i], float(min(least)), float(high.max()), wanted)
                scored += len(some)
                if not len(some):
                    continue
                score = scores_of(self.v[i], part.v[some], self.norm[i], part.norms[some])
                for j in range(len(own)):
                    fits = (score >= max(low[j], least[j])) & (score <= high[j])
                    if fits.any():
                        new = np.stack([score[fits], part.vec[some[fits]], part.row[some[fits]]], 1)
                        new = np.concatenate([held[i][j], new])
                        held[i][j] = new[_first(*new.T, k)]
        return held, scored


def _parts(batches: Batches):
    for batch in batches:
        for columns in zip(*(c.to_pylist() for c in batch.columns)):
            yield Part(*columns)


def _to_parts(refs: np.ndarray, rows_of_part: int):
    """Sorted rows in parts: consecutive, of one direction, a bounded number."""

    def run(batches: Batches) -> Batches:
        def out(home: int, held: list) -> pa.RecordBatch:
            ids, norms, angles, v = (np.concatenate(x, axis=a) for x, a in zip(zip(*held), (1, 0, 0, 0)))
            values = [[home], [len(norms)], *([x.tobytes()] for x in (ids, norms, angles, v))]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            names = ["directions", "n", "ids", "norms", "angles", "vectors"]
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(values, kinds)], names)

        home, held, n = -1, [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, rows_of_part):
                some = batch.slice(a, rows_of_part)
                of = some.column(0).to_numpy()
                ids = np.stack([some.column(2).to_numpy(), some.column(3).fill_null(LAST).to_numpy(), some.column(4).to_numpy()])
                v = _matrix(some.column(5))
                norms, angles = norms_of(v), angles_to(v, refs)
                cuts = np.flatnonzero(np.diff(of)) + 1
                for x, y in zip([0, *cuts], [*cuts, len(of)]):
                    if n and (of[x] != home or n + y - x > rows_of_part):
                        yield out(home, held)
                        held, n = [], 0
                    home = int(of[x])
                    held.append((ids[:, x:y], norms[x:y], angles[x:y], v[x:y]))
                    n += y - x
        if n:
            yield out(home, held)

    return run


def _homes(refs: np.ndarray):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                angles = angles_to(_matrix(batch.column(3)), refs)
                home = angles.argmin(axis=1)
                at = angles[np.arange(len(home)), home]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home, pa.int32()), pa.array(at), *batch.columns], ["home", "angle", *batch.schema.names]
                )

    return run


_FOUND = "anchor long, place int, part int, score long, vec_id long, row long"


def _emit(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    rows = [r for _, _, r in found]
    anchor = np.repeat([a for a, _, _ in found], [len(r) for r in rows])
    place = np.repeat([p for _, p, _ in found], [len(r) for r in rows])
    rows = np.concatenate(rows)
    part = np.full(len(rows), TaskContext.get().partitionId() % GROUPS)
    columns = [pa.array(anchor, pa.int64()), pa.array(place, pa.int32()), pa.array(part, pa.int32())]
    columns += [pa.array(rows[:, 0]), pa.array(rows[:, 1], mask=rows[:, 1] == LAST), pa.array(rows[:, 2])]
    return pa.RecordBatch.from_arrays(columns, ["anchor", "place", "part", "score", "vec_id", "row"])


def _seek(shared, k: int):
    def run(batches: Batches) -> Batches:
        held, _ = shared.value.positives(_parts(batches), k)
        if found := [(a, 0, h) for a, h in enumerate(held) if len(h)]:
            yield _emit(found)

    return run


def _mine(shared, own, k: int, lowest: int, highest: int):
    def run(batches: Batches) -> Batches:
        held, _ = shared.value.negatives(_parts(batches), own.value, k, lowest, highest)
        if found := [(a, p, h) for a, some in enumerate(held) for p, h in enumerate(some) if len(h)]:
            yield _emit(found)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per anchor and place, over groups of tasks and then over all."""
    for by in (("anchor", "place", "part"), ("anchor", "place")):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found


def hard_negatives(
    vectors: DataFrame,
    anchors: int = ANCHORS,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    n_directions: int = DIRECTIONS,
    block: int = BLOCK,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """For each anchor and each of its positives the first rows of other labels within the window."""
    session = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(vectors).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.select("row", "vec_id", "label", "v"), "labelled-vectors")
    sample = rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).select("v").toPandas()["v"]
    if not len(sample):
        return session.createDataFrame([], schema)
    refs = directions(np.stack(sample.to_numpy()), n_directions)
    placed = map_batches(rows, _homes(refs), f"home int, angle double, {_ROW}")
    placed = placed.repartitionByRange("home", "angle", "row").sortWithinPartitions("home", "angle", "row")
    parts = stored(map_batches(placed, _to_parts(refs, part_rows), _PART), "parts")
    asked = stored(rows.where(F.col("vec_id") % anchors == 0), "anchors")
    n_blocks = max(1, -(-asked.count() // block))
    context, results = session.sparkContext, []
    for number in range(n_blocks):
        some = asked.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == number).orderBy("row").toPandas()
        if not len(some):
            continue
        seeking = Seeking(*(some[c].to_numpy(np.int64) for c in ("row", "vec_id", "label")), np.stack(some["v"].to_numpy()), refs)
        shared = context.broadcast(seeking)  # at most about ``block`` anchors
        best = stored(_ranked(map_batches(parts, _seek(shared, positives), _FOUND), positives), "positives")
        own: list[list[int]] = [[] for _ in some.index]
        for r in best.orderBy("anchor", "rank").select("anchor", "score").collect():  # a few rows per anchor
            own[r["anchor"]].append(r["score"])
        scores = context.broadcast([np.array(x, np.int64) for x in own])
        found = map_batches(parts, _mine(shared, scores, negatives, lowest, highest), _FOUND)
        found = stored(_ranked(found, negatives), "negatives")
        names = session.createDataFrame(list(enumerate(some["vec_id"].tolist())), "anchor long, anchor_id long")
        best = best.select(
            "anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        found = found.select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        results.append(found.join(best, ["anchor", "place"]).join(names, "anchor"))
        results[-1] = stored(results[-1].select(*[c.split()[0] for c in schema.split(", ")]), "hard-negatives")
        shared.destroy()
        scores.destroy()
    if not results:
        return session.createDataFrame([], schema)
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out


def op13_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle() -> str:
    """The same in SQL, every anchor against every row."""
    return f"""
with finite as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
rows as (
  select row_number() over () as row, vec_id,
         case when vec_id % {FLIPPED} = 0 then (label + 1) % {LABELS} else label end as label,
         list_transform(v, lambda c: floor({SCALE} * c)) as v from finite),
scored as (
  select a.row as anchor, a.vec_id as anchor_id, b.row, b.vec_id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.row <> b.row where a.vec_id % {ANCHORS} = 0),
positives as (
  select anchor, row as positive, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor order by score desc, vec_id, row) <= {POSITIVES})
select anchor_id, positive_id, row_number() over w::integer as rank, vec_id as negative_id, positive_score, score as negative_score
from scored join positives using (anchor)
where not same and {LOWEST} * positive_score <= 100 * score and 100 * score <= {HIGHEST} * positive_score
window w as (partition by anchor, positive order by score desc, vec_id, row)
qualify rank <= {NEGATIVES}
"""
