"""Op 6: forward-backward marginals against the sum over all labellings."""

import itertools

import numpy as np
import pytest

from assetweave.llm.quality import Chain, Lines


@pytest.mark.parametrize("seed", range(4))
def test_marginals_equal_full_enumeration(seed):
    rng = np.random.default_rng(seed)
    counts = np.array([1, 5, 0, 7, 2])
    first = np.concatenate([[0], np.cumsum(counts)])
    width = 6
    lines = Lines(rng.normal(size=(first[-1], width)).astype(np.float32), rng.integers(1, 90, first[-1]), first)
    chain = Chain(width)
    chain.weights, chain.change = rng.normal(size=width), rng.normal(size=(2, 2))
    good, expected = chain.marginals(lines, pairs=True)
    score = lines.features @ chain.weights
    changes = np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        total, of_line = 0.0, np.zeros(b - a)
        of_pair = np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=b - a):
            worth = sum(score[a + i] * (y - 0.5) for i, y in enumerate(labels))
            worth += sum(chain.change[x, y] for x, y in zip(labels, labels[1:]))
            p = np.exp(worth)
            total += p
            of_line += p * np.array(labels, float)
            for x, y in zip(labels, labels[1:]):
                of_pair[x, y] += p
        assert good[a:b] == pytest.approx(of_line / total, abs=1e-6)
        changes += of_pair / total
    assert expected == pytest.approx(changes, abs=1e-6)
    means = chain.means(lines)
    for d, (a, b) in enumerate(zip(first, first[1:])):
        if b > a:
            assert means[d] == pytest.approx((good[a:b] * lines.size[a:b]).sum() / lines.size[a:b].sum())
