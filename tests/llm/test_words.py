import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gantry.llm.words import index_words, joined

TEXTS = st.lists(st.text(st.sampled_from("abAB \n\t\x00é漢" + "x" * 3), max_size=60), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.booleans(), st.integers(0, 3))
def test_index_words(texts, lower, skip):
    column = pa.array(texts, pa.string())[min(skip, len(texts)) :]
    kinds, of, bounds = index_words(column, lower)
    assert len(set(kinds)) == len(kinds)
    for i, t in enumerate(column.to_pylist()):
        raw = t.encode().lower() if lower else t.encode()
        assert [kinds[k] for k in of[bounds[i] : bounds[i + 1]]] == raw.split()


def test_joined():
    parts = [np.array(x, "<u4").tobytes() for x in ([1, 2], [], [3])]
    flat, upto = joined(parts, np.array([2, 0, 1, 0]))
    assert flat.tolist() == [3, 1, 2, 1, 2] and upto.tolist() == [0, 1, 3, 3, 5]
