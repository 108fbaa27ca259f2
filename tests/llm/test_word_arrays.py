import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linkframe.llm import text as X


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_words_are_runs_of_letters_and_digits(text):
    low = text.lower()
    words, run = [], ""
    for c in low + " ":
        if c.isalnum():
            run += c
        elif run:
            words.append(run)
            run = ""
    hashes, start, end = X.word_hashes(text)
    assert [low[a:b] for a, b in zip(start, end)] == words
    assert len(set(hashes.tolist())) == len(set(words))


def test_equal_words_hash_alike_anywhere():
    a, b = X.word_hashes("One two, three")[0], X.word_hashes("zero... one TWO three")[0][1:]
    assert a.tolist() == b.tolist()


def test_ngrams_and_shingles():
    words = X.word_hashes("a b c a b c")[0]
    grams = X.ngrams(words, 3)
    assert len(grams) == 4 and grams[0] == grams[3] and len(set(grams.tolist())) == 3
    assert len(X.shingles("a b c a b c", 3)) == 3
    assert len(X.shingles("a b", 3)) == 1 and X.shingles("a b", 3)[0] != X.shingles("b a", 3)[0]
    assert not len(X.shingles(None, 5)) and not len(X.shingles("...", 5))


def test_mix_is_one_to_one():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(X.mix(x))) == len(x)
    assert re.fullmatch("[01]", str(int(X.mix(x)[0] & np.uint64(1))))
