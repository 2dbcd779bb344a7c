import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from rawstrata.llm.words import hash_words, shingle_sets, split_words

TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="aAbÉß \n\t\x0b\x1c日", max_size=40)), max_size=6
)


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    words = split_words(pa.array(texts, pa.string()), lower=True)
    data = words.data.tobytes()
    for i, text in enumerate(texts):
        run = slice(words.first[i], words.first[i + 1])
        got = [data[a:b].decode() for a, b in zip(words.starts[run], words.ends[run], strict=True)]
        assert got == plain(text)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_equal_words_have_equal_hashes(texts):
    array = pa.array(texts, pa.string())
    words = split_words(array, lower=True)
    flat = [w for t in texts for w in plain(t)]
    hashes = hash_words(words).tolist()
    assert len(set(zip(flat, hashes, strict=True))) == len(set(flat)) == len(set(hashes))


def test_beginnings_hash_like_words():
    words = split_words(pa.array(["idiotic idiot"]))
    [short, whole] = hash_words(words, (5, 100))
    assert short[0] == short[1] == whole[1] != whole[0]


def test_words_of_a_slice_and_of_large_texts():
    texts = pa.array(["x", "b " * 3_000_000, None, "b"])
    sets = dict(shingle_sets(texts.slice(1), 3))
    assert [len(sets[i]) for i in range(3)] == [1, 0, 1]


@given(TEXTS, st.integers(1, 4))
@settings(max_examples=100, deadline=None)
def test_shingle_sets_have_the_right_sizes(texts, size):
    for i, found in shingle_sets(pa.array(texts, pa.string()), size):
        words = plain(texts[i])
        grams = {tuple(words[j : j + size]) for j in range(len(words) - size + 1)}
        assert len(found) == (len(grams) if len(words) >= size else min(len(words), 1))
        assert (np.diff(found.astype(object)) > 0).all()
