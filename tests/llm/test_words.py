import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from vantrail.llm import golomb
from vantrail.llm.words import split_words

TEXT = st.text(alphabet="abAB \t\n\x0b\x1cé漢", max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6), st.booleans())
def test_words_are_those_of_the_pattern(texts, lower):
    words = split_words(pa.array(texts, pa.string()), lower)
    seen = {}
    for text, (a, b) in zip(texts, words.bounds(), strict=True):
        text = text or ""
        if lower:
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        want = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert b - a == len(want)
        for w, h in zip(want, words.hashes[a:b].tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_grams_tell_order_and_length():
    words = split_words(pa.array(["a b c", "c b a", "a b c d"]))
    grams, whole = words.grams(3)
    found = grams[whole].tolist()
    assert len(found) == 4 and found[0] == found[2] and len(set(found)) == 3
    assert words.whole(0, 2) != words.whole(1, 3)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=200))
def test_golomb_round_trip(numbers):
    ordered = np.array(sorted(numbers), np.uint64)
    assert np.array_equal(golomb.decode(golomb.encode(ordered)), ordered)


def test_golomb_is_near_the_bound():
    x = np.unique(np.random.default_rng(0).integers(0, 2**63, 100_000).astype(np.uint64))
    assert len(golomb.encode(x)) * 8 / len(x) < 63 - np.log2(len(x)) + 2.2
