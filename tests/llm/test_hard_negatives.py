"""Op 13: score bounds, and negatives against a plain version."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assetweave.llm import hard_negatives as hn


def plain(rows, anchors=100, positives=5, negatives=10):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by comparing everything."""
    kept = []
    for vec_id, v, label in rows:
        if label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, label, [math.floor(256 * c) for c in v]))
    out = []

    def order(x):
        return (-x[0], x[1] is None, x[1] or 0)

    for i, (vec_id, label, v) in enumerate(kept):
        if vec_id is None or vec_id % anchors:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), d, m == label) for j, (d, m, w) in enumerate(kept) if j != i]
        for score, d, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            fits = [s for s in scored if not s[2] and 30 * score <= 100 * s[0] <= 90 * score]
            out += [(vec_id, d, r, s[1], score, s[0]) for r, s in enumerate(sorted(fits, key=order)[:negatives], 1)]
    return sorted(out, key=repr)


def frame(spark, rows):
    rows = [(*r, 7, "x") for r in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, row int, place string")


def mined(df, **options):
    return sorted((tuple(r) for r in hn.hard_negatives(df, **options).collect()), key=repr)


def vectors(n, dim, seed, labels=4):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(5, dim))
    x = (centres[random.integers(0, 5, n)] + random.normal(size=(n, dim)) * 0.7).astype(np.float32)
    return [(i, x[i].tolist(), int(random.integers(0, labels))) for i in range(n)]


def test_against_every_row(spark):
    rows = vectors(400, 6, 1)
    df = frame(spark, rows).repartition(3)
    expected = plain(rows, anchors=20)
    assert expected and mined(df, anchors=20) == expected
    assert mined(df, anchors=20, part_rows=7, block=3, n_directions=3) == expected


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = vectors(120, 3, 2, 2)
    same = [0.5, -0.25, 0.75]
    rows += [(1000 + i, same, i % 2) for i in range(60)] + [(1000, same, 0), (1100, same, 1)]  # copies, repeated ids
    rows += [(None, same, 0), (None, same, 1), (2000, None, 1), (2100, [], 0), (2200, [1.0, None, 0.0], 1)]
    rows += [(2300, [1.0, float("nan"), 0.0], 1), (2400, [float("inf"), 0.0, 0.0], 0), (2500, same, None)]
    rows += [(2600, [0.0, 0.0, 0.0], 0), (2700, [0.001, 0.0, 0.0], 1), (-300, [-x for x in same], 1)]
    rows += [(2900, [900.0, -800.0, 1000.0], 1), (3000, [9e5, -8e5, 1e6], 0), (3001, [9e5, -8e5, 1e6], 1), (3002, [8e5, -7e5, 9e5], 0)]
    df = frame(spark, rows).repartition(4)
    expected = plain(rows)
    assert expected and mined(df) == expected
    assert mined(df, part_rows=5, block=2) == expected


def test_left_out(spark):
    """Lengths other than the commonest, and norms whose products leave 64 bits."""
    rows = vectors(200, 4, 3)
    odd = [(5000, [1.0, 2.0], 1), (5100, [1e30, 0.0, 0.0, 0.0], 2)]
    assert mined(frame(spark, rows + odd)) == plain(rows)


def test_empty(spark):
    df = frame(spark, [(0, None, 1)])
    assert mined(df) == [] and mined(df.limit(0)) == []
    assert mined(frame(spark, [(0, [1.0], 1)])) == []
    assert mined(frame(spark, [(5, [1.0], 1), (6, [1.0], 2)])) == []  # no anchor


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 8), st.sampled_from([1, 3, 300, 10**6]), st.integers(1, 6))
def test_scores_lie_within_their_bounds(seed, dim, size, n_directions):
    random = np.random.default_rng(seed)
    v = random.integers(-size, size + 1, (40, dim))
    v[::5] = v[0]  # equal, opposite and zero vectors lie on the edge of their intervals
    v[1::5] = -v[0]
    v[2] = 0
    refs = hn.directions(v, n_directions)
    norms, angles = hn.norms_of(v), hn.angles_to(v, refs)
    for i in range(len(v)):
        low, high = hn.score_bounds(angles[i], norms[i], angles, norms)
        score = v @ v[i]
        assert (low <= score).all() and (score <= high).all()
        assert (hn.scores_of(v[i], v, norms[i], norms) == score).all()


def test_only_overlapping_rows_are_scored(spark):
    """Of clustered rows most are never scored."""
    random = np.random.default_rng(5)
    centres = random.normal(size=(8, 16)) * 2
    of = random.integers(0, 8, 4000)
    v = np.floor(256 * (centres[of] + random.normal(size=(4000, 16)) * 0.1)).astype(np.int64)
    label = random.integers(0, 3, 4000)
    refs = hn.directions(v)
    home = hn.angles_to(v, refs).argmin(axis=1)
    parts = []
    for h in np.unique(home):
        rows = np.flatnonzero(home == h)
        angles = hn.angles_to(v[rows], refs)
        rows, angles = rows[np.argsort(angles[:, h])], angles[np.argsort(angles[:, h])]
        ids = np.stack([rows, rows, label[rows]])
        blobs = (ids, hn.norms_of(v[rows]), angles, v[rows])
        parts.append(hn.Part(int(h), len(rows), *(x.tobytes() for x in blobs)))
    seeking = hn.Seeking(np.arange(20), np.arange(20), label[:20], v[:20], refs)
    held, scored = seeking.positives(parts, 5)
    for i, found in enumerate(held):
        own = [j for j in np.lexsort([np.arange(4000), -(v @ v[i])]) if j != i and label[j] == label[i]][:5]
        assert found[:, 2].tolist() == own
    assert scored < 0.5 * 20 * 4000 / 3
    _, scored = seeking.negatives(parts, [h[:, 0] for h in held], 10, 30, 90)
    assert scored < 0.5 * 20 * 4000 * 2 / 3
