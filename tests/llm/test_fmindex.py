import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridsnap.llm.fmindex import FMIndex, suffix_array


@given(st.lists(st.integers(1, 6), min_size=1, max_size=60))
@settings(max_examples=80, deadline=None)
def test_suffix_array(text):
    want = sorted(range(len(text)), key=lambda i: text[i:])
    assert suffix_array(np.array(text)).tolist() == want


@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(1, 6), min_size=1, max_size=4), st.integers(1, 9))
@settings(max_examples=120, deadline=None)
def test_search_and_locate_against_scan(text, pattern, step):
    index = FMIndex(np.array(text), step)
    lo, hi = index.search(np.array([pattern]))
    got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
    assert got == [i for i in range(len(text) - len(pattern) + 1) if text[i : i + len(pattern)] == pattern]
