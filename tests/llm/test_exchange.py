"""The local search of packing beats best fit and ends in a local optimum."""

import numpy as np
import pytest

from millrace.llm import packing


def has_exchange(length, size, bins):
    """Whether a move, one for one or two for one raises the sum of squared fills, by trying all."""
    fill = [sum(int(length[i]) for i in b) for b in bins]
    for d, donor in enumerate(bins):
        own = [int(length[i]) for i in donor]
        given = set(own) | {own[x] + own[y] for x in range(len(own)) for y in range(x)}
        for t, other in enumerate(bins):
            taken = {int(length[i]) for i in other}
            moves = {a for a in own} | {a - b for a in given for b in taken if a > b}
            if t != d and any(fill[t] + m <= size and fill[t] + m > fill[d] for m in moves):
                return True
    return False


@pytest.mark.parametrize("low, high", [(500, 900), (300, 1000)])
def test_best_fit_is_beaten(low, high):
    fewer = 0
    for seed in range(6):
        length = np.random.default_rng(seed).integers(low, high + 1, 300)
        bins = packing.fill(length, 2048)
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert max(sum(length[i] for i in b) for b in bins) <= 2048
        first = packing.best_fit(length, 2048)[0]
        assert len(bins) <= len(first)
        fewer += len(bins) < len(first)
        assert len(bins) == -(-int(length.sum()) // 2048) or not has_exchange(length, 2048, bins)
    assert fewer


def test_best_fit_is_beaten_by_a_margin():
    length = np.random.default_rng(0).integers(500, 901, 300)
    assert len(packing.fill(length, 2048)) <= 0.97 * len(packing.best_fit(length, 2048)[0])
