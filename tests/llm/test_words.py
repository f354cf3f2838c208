"""Words on bytes against a regular expression on characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyport.llm import words

from .conftest import BLANK, PLAIN, lower

LETTERS = words.PLAIN_WORDS | words.byte_class((65, 90))
TEXTS = st.lists(st.one_of(st.none(), st.text("aB9 .,\né漢\x00", max_size=30)), max_size=6)


@settings(deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    data, offsets = words.text_bytes(column)
    for table, pattern in ((LETTERS, PLAIN), (words.BLANK_WORDS, BLANK)):
        found = words.find_words(data, offsets, table, lower=True)
        wanted = [pattern.findall(lower(t)) for t in texts]
        assert found.counts.tolist() == [len(w) for w in wanted]
        flat = [w for row in wanted for w in row]
        ids = {}
        for word, h in zip(flat, found.hashes.tolist(), strict=True):
            assert ids.setdefault(word, h) == h
        assert len(set(ids.values())) == len(ids)


def test_windows_cut_no_word():
    text = ("ab" * 150_000) + " " + "c" * 300_000 + " d"
    data, offsets = words.text_bytes(pa.array([text, text]))
    found = words.find_words(data, offsets, words.BLANK_WORDS)
    assert found.counts.tolist() == [3, 3]
    assert np.array_equal(found.hashes[:3], found.hashes[3:])


def test_pieces_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, None, "", "y" * 100, "z"])], names=["t"])
    parts = list(words.pieces(iter([batch]), "t", 20))
    assert [v for p in parts for v in p.column("t").to_pylist()] == batch.column("t").to_pylist()
    assert len(parts) > 1
