"""Words and hashes found on bytes, against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from veilwork.llm.textbytes import Words, as_texts, chunks, grams

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.none() | st.text(alphabet="aAbB é\n\t\x0b\x85ß中 ", max_size=30), max_size=8)


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(values):
    found = Words(as_texts(pa.array(values, pa.string())))
    want = [WORD.findall((v or "").translate(LOW)) for v in values]
    assert found.counts().tolist() == [len(w) for w in want]
    flat = [w for words in want for w in words]
    by_word = {}
    for word, value in zip(flat, found.hashes.tolist(), strict=True):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_a_slice_of_a_batch_has_its_own_words():
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "text": ["a b", "c", "a b"]})
    parts = [Words(as_texts(p.column(1))).hashes.tolist() for p in chunks(batch, most=1)]
    assert [len(p) for p in parts] == [2, 1, 2] and parts[0] == parts[2]


def test_grams_depend_on_order_and_step():
    h = np.arange(1, 6, dtype=np.uint64)
    assert len(grams(h, 3)) == 3 and len(grams(h, 2, 2)) == 3 and len(grams(h, 9)) == 0
    assert grams(h, 2)[0] != grams(h[::-1].copy(), 2)[-1] and grams(h, 2)[0] != grams(h, 2, 2)[0]
