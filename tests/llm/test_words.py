import numpy as np
import pyarrow as pa
from helpers import alphanumeric, spaced
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import words as w

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aBé \t\n\x0b.,!9 ß\U0001f600Z"), max_size=40)), max_size=8)


@settings(deadline=None, max_examples=200)
@given(TEXTS)
def test_words_and_hashes(texts):
    for inside, split in ((w.SPACED, spaced), (w.ALPHANUMERIC, alphanumeric)):
        found = w.words_of(pa.array(texts, pa.string()), inside)
        got = [(int(t), bytes(found.data[s:e]).decode()) for t, s, e in zip(found.text, found.start, found.end)]
        assert got == [(i, word) for i, text in enumerate(texts) for word in split(text)]
        names = {}
        for (_, word), value in zip(got, found.hash.tolist()):
            assert names.setdefault(word, value) == value
        assert len(set(names.values())) == len(names)


@settings(deadline=None, max_examples=100)
@given(TEXTS, st.integers(1, 5))
def test_shingles(texts, size):
    found = w.words_of(pa.array(texts, pa.string()))
    text, value = w.shingles(found, size)
    expected = []
    for i, own in enumerate(texts):
        own = spaced(own)
        windows = [tuple(own[k: k + size]) for k in range(len(own) - size + 1)] or ([tuple(own)] if own else [])
        expected += [(i, window) for window in windows]
    assert text.tolist() == [i for i, _ in expected]
    names = {}
    for (_, window), v in zip(expected, value.tolist()):
        assert names.setdefault(window, v) == v
    assert len(set(names.values())) == len(names)


def test_hashes_do_not_depend_on_where_a_text_is_cut():
    long = " ".join(f"w{i}" for i in range(400_000))
    whole = w.words_of(pa.array([long]))
    parts = w.words_of(pa.array([f"w{i}" for i in range(400_000)]))
    assert np.array_equal(whole.hash, parts.hash)
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 700_000, None, "b", long, ""]})
    assert [part.num_rows for part in w.slices(batch, "text")] == [1, 2, 1, 1]
