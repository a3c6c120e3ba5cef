"""The word encoder against the tokenizer itself, on random Unicode."""

import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioforge.llm import tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(WORDS)
ENCODER = tokens.WordEncoder(WORDS)
#: Letters whose lower case decomposes or composes anew, marks, white space of several kinds, and ordinary characters.
ODD = st.sampled_from([*"İIıßẞǅÅΣςäÄé東ｱﬁ½²", *"़̧̣́̇ͅ‍﻿­", *" \n\t\r\x0b\x0c\x1c\x85\xa0  　", *"abcXYZ019.,'-_<>|[]"])
TEXT = st.lists(ODD | st.characters(codec="utf-8"), max_size=24).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_equals_the_tokenizer(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert ids[at : at + n].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
        at += n
    assert at == len(ids)


def test_words_that_change_when_normalised_twice_and_alternating_words():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    texts = ["İ̧ x", "İ़", a, b, f"{b} {a}", None, ""]
    ids, counts = tokens.WordEncoder(WORDS).encode(pa.array(texts, pa.string()))
    expected = [TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, expected)) and ids.tolist() == [i for e in expected for i in e]
