import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from admere.llm.text import WORD_PATTERN, hashes, pieces, runs, windows, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\x1cé日.", max_size=30)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_their_hashes_follow_the_pattern(texts, limit):
    found, names = [], {}
    for first, end, data, bounds in pieces(pa.array(texts, pa.string()), limit):
        start, stop, text = words(data, bounds)
        values = hashes(data, start, stop)
        for a, b, t, h in zip(start, stop, text, values, strict=True):
            word = data[a:b].tobytes().decode()
            found.append((first + t, word))
            assert names.setdefault(word, h) == h
        assert end > first
    assert found == [(i, w) for i, t in enumerate(texts) for w in re.findall(WORD_PATTERN, t or "")]
    assert len(set(names.values())) == len(names)


def test_runs_stop_at_text_bounds():
    start, end, text = runs(np.array([True, True, False, True, True]), np.array([0, 1, 1, 4, 5]))
    assert (start.tolist(), end.tolist(), text.tolist()) == ([0, 1, 3, 4], [1, 2, 4, 5], [0, 2, 2, 3])


def test_windows_stay_inside_a_text():
    values, text = np.arange(6, dtype=np.uint64), np.array([0, 0, 0, 1, 1, 1])
    found, at = windows(values, text, 3)
    assert at.tolist() == [0, 3] and len(set(found.tolist())) == 2
    assert len(windows(values, text, 7)[0]) == 0
