import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stratus.llm import words as W

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n ß\U0001f600", max_size=40)), max_size=8))
def test_hashes_tell_words_apart_as_the_regex_does(texts):
    seen = {}
    for text, got in zip(texts, W.doc_words(pa.array(texts, pa.string()))):
        want = _WORD.findall((text or "").translate(_LOWER))
        assert len(got) == len(want)
        for w, h in zip(want, got):
            assert seen.setdefault(w, int(h)) == int(h)
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_pieces_alike(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000)) + " " + "x" * 3000 + " end"
    whole = next(W.doc_words(pa.array([text])))
    monkeypatch.setattr(W, "PIECE", 100)
    parts = next(W.doc_words(pa.array([text])))
    assert (whole == parts).all()


def test_sliced_and_chunked_columns():
    col = pa.chunked_array([pa.array(["a b", None, "c"]).slice(1), pa.array(["d e f"])])
    assert [len(x) for x in W.doc_words(col)] == [0, 1, 3]


def test_shingles():
    one = W.shingles(np.arange(7, dtype=np.uint64))
    assert len(one) == 3 and len(set(one.tolist())) == 3
    assert len(W.shingles(np.arange(4, dtype=np.uint64))) == 1
    assert len(W.shingles(np.empty(0, np.uint64))) == 0
    a, b = np.array([1, 2], np.uint64), np.array([2, 1], np.uint64)
    assert W.shingles(a)[0] != W.shingles(b)[0]
