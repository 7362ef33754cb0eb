import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from larderlake.llm.words import LETTERS, VISIBLE, hashed_words, windows

PATTERNS = {"letters": (LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "visible": (VISIBLE, r"[^\x20\x09-\x0D]+")}


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.mark.parametrize("kind", PATTERNS)
@given(texts=st.lists(st.none() | st.text(alphabet="aAbZ09 \t\n.é \U0001f600\x00\x7f_-")))
def test_words_are_those_of_the_pattern(kind, texts):
    alphabet, pattern = PATTERNS[kind]
    seen, names = [], {}
    for _, w in hashed_words(pa.array(texts, pa.string()), alphabet):
        for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
            seen.append(w.text(a, b))
            for word, h in zip(w.text(a, b), w.hashes[a:b].tolist(), strict=True):
                assert names.setdefault(word, h) == h
    assert seen == [re.findall(pattern, lower(t)) for t in texts]
    assert len(set(names.values())) == len(names)


def test_hashes_do_not_depend_on_place_or_chunk():
    texts = ["a b c " * 200_000, "c", "b a"]
    found = {}
    for _, w in hashed_words(pa.array(texts), LETTERS):
        for i, word in enumerate(w.text(0, len(w.hashes))):
            found.setdefault(word, set()).add(int(w.hashes[i]))
    assert {k: len(v) for k, v in found.items()} == {"a": 1, "b": 1, "c": 1}


def test_windows_tell_order_and_length():
    h = np.array([1, 2, 3, 1, 2], dtype=np.uint64)
    pairs = windows(h, 2)
    assert pairs[0] == pairs[3] and len(set(pairs.tolist())) == 3
    assert len(windows(h, 6)) == 0
    assert windows(h[:1], 1)[0] != pairs[0]
