import numpy as np
from hypothesis import given, settings, strategies as st

from silvermill.llm.text import distinct, mix, shingles, word_hashes
from tests.llm.brute import words

TEXT = st.text(st.sampled_from(list("abAB \t\n\r\x0b\x0c\x1c\x85\xa0éÉ𝄞\0")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_equal_words_and_only_they_hash_alike(a, b):
    left, right = word_hashes(a), word_hashes(b)
    assert len(left) == len(words(a))
    for x, h in zip(words(a), left):
        for y, g in zip(words(b), right):
            assert (x == y) == (h == g)


def test_words_longer_than_the_table_of_factors():
    long = "x" * 10_000
    a, b = word_hashes(f"{long}a{long} y"), word_hashes(f"{long}b{long} y")
    assert a[0] != b[0] and a[1] == b[1]


def test_shingles():
    h = word_hashes("a b c d a b c")
    assert len(shingles(h, 3)) == 5 and len(distinct(shingles(h, 3))) == 4
    assert len(shingles(h, 9)) == 1 and len(shingles(h[:0], 3)) == 0
    assert shingles(word_hashes("a b"), 3)[0] != shingles(word_hashes("b a"), 3)[0]
    assert len(np.unique(mix(np.arange(10_000, dtype=np.uint64)))) == 10_000
