"""The sketch of operator 12 grows with the corpus."""

import pytest

from quaymark.llm import phrases


@pytest.mark.parametrize("chars", [0, 1, 10**6, 7 * 10**8, 3 * 10**9, 8 * 10**9, 16 * 10**9])
def test_a_cell_stays_under_the_threshold_by_chance(chars):
    bits = phrases.sketch_bits(chars)
    assert phrases.LEAST_BITS <= bits <= phrases.MOST_BITS
    assert chars / 6 / (1 << bits) < 50  # words of a cell; the threshold is 100
