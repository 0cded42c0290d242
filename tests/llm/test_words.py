import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import words


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \n\t\x0b\x1c。😀", max_size=40)), max_size=8), block=st.sampled_from([3, 8, 1 << 20]), skip=st.integers(0, 2))
def test_words_and_shingles(texts, block, skip):
    words.BLOCK, old = block, words.BLOCK
    try:
        h, bounds, first, end = words.word_hashes(pa.array(texts, pa.string()).slice(skip), positions=True)
        sets = list(words.shingle_sets(pa.array(texts, pa.string()).slice(skip)))
    finally:
        words.BLOCK = old
    names = {}
    data = "".join(t or "" for t in texts[skip:]).encode()
    for i, t in enumerate(texts[skip:]):
        mine, want = h[bounds[i] : bounds[i + 1]], plain(t)
        assert len(mine) == len(want)
        for x, w, a, b in zip(mine.tolist(), want, first[bounds[i] : bounds[i + 1]], end[bounds[i] : bounds[i + 1]], strict=True):
            assert names.setdefault(x, w) == w
            assert data[a:b].decode().replace("A", "a") == w
        shingles = {tuple(want[k : k + 5]) for k in range(max(1, len(want) - 4))} if want else set()
        assert len(sets[i]) == len(shingles)
    assert len(set(names.values())) == len(names)


def test_speed_is_vectorised():
    text = "lorem ipsum dolor " * 200_000
    h, bounds = words.word_hashes(pa.array([text, "lorem"]))
    assert bounds.tolist() == [0, 600_000, 600_001]
    assert len(np.unique(h)) == 3
