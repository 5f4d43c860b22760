"""Operator 2: looking up a piece's strings."""

import time

import numpy as np
import pytest

from rowkin.llm import ppm


def test_lookups_are_right_and_dont_search_the_keys():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 48, 1_500_000))
    value = rng.random(len(keys)).astype("<f4")
    words = np.sort(ppm.WORD | rng.integers(0, 1 << 40, 5))
    rows = [(0, ppm.packed_keys(keys[::2]), ppm.packed(value[::2])), (1, ppm.packed_keys(keys[1::2]), ppm.packed(value[1::2]))]
    values = ppm.Values([*rows, (1 << ppm.FAMILY_BITS, ppm.packed_keys(words), ppm.packed(np.arange(5)))])
    at = rng.integers(0, len(keys), 2_000_000)
    began = time.process_time()
    searched = value[np.searchsorted(keys, keys[at])]
    between = time.process_time()
    found = values.of(keys[at], False)
    assert (found == searched).all() and values.of(words[::-1], True).tolist() == [4, 3, 2, 1, 0]
    assert time.process_time() - between < 0.7 * (between - began)
    for table in (values, ppm.Values([])):
        assert len(table.of(keys[:0], False)) == 0
        with pytest.raises(RuntimeError):
            table.of(np.setdiff1d(np.arange(9), keys), False)
