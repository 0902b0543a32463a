"""The hash table of keys against a dictionary."""

import numpy as np
from hypothesis import given, settings, strategies as st

from ledgerlens.llm import tokens as tk


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 2**32 - 1), st.booleans())
def test_places(n, seed, dense):
    rng = np.random.default_rng(seed)
    keys = rng.permutation(np.unique(rng.integers(0, 4 * n + 1, n) if dense else rng.integers(-2**63, 2**63 - 1, n)))
    places = tk.Places(keys)
    sought = np.concatenate([keys, rng.integers(-2**63, 2**63 - 1, 50), np.arange(-5, 50)])
    known = {int(k): i for i, k in enumerate(keys)}
    assert places.find(sought).tolist() == [known.get(int(k), -1) for k in sought]
