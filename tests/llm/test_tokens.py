"""Ids by remembered words against the tokenizers library on whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm.tokens import Encoder, at_blanks, at_spaces, whole

CASES = [("byte_bpe_50k.json", at_spaces), ("word_bpe_49k.json", at_blanks), ("byte_bpe_50k.json", whole)]
ENCODERS = [
    (Encoder(public_tokenizers.path(n), cut), Tokenizer.from_file(public_tokenizers.path(n)))
    for n, cut in CASES
]


def check(case, text):
    encoder, plain = ENCODERS[case]
    ids = np.frombuffer(next(encoder.ids([text], 2)), dtype=encoder.dtype).tolist()
    assert ids == [*plain.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("case", range(len(CASES)))
@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), max_size=60))
def test_latin(case, text):
    check(case, text)


@pytest.mark.parametrize("case", range(len(CASES)))
@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(" \n\t'sStTvel1²½ªµßÿİıǅɏɐΣéÀ.,! ́­漢"), max_size=40))
def test_awkward(case, text):
    check(case, text)


@pytest.mark.parametrize("case", range(len(CASES)))
def test_every_latin_character(case):
    for code in range(0x2B0):
        check(case, f"a{chr(code)}b {chr(code)}{chr(code)} 1{chr(code)}")


@pytest.mark.parametrize("case", range(len(CASES)))
def test_added_tokens_have_their_own_ids(case):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "<|ENDOFTEXT|> <|startoftext|>x", "<|endoftext"):
        check(case, text)
    encoder, _ = ENCODERS[case]
    assert len(next(encoder.ids([None], 2))) == encoder.width
    assert list(encoder.ids([None, ""], 2)) == [next(encoder.ids([""], 2))] * 2


AWKWARD = st.text(st.sampled_from(" \n\t'sStTvel1²½ªµßÿİıǅɏΣéÀ.,! \u0301\x00\x85\xa0漢"), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | AWKWARD | st.sampled_from(["x <|endoftext|>", "\x001", "it's, don't."]), max_size=6))
def test_ids_by_chunk(texts):
    encoder, plain = ENCODERS[1]
    ids, counts = encoder.ids_by_chunk(texts, 2)
    expected = [[*plain.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert ids.tolist() == [i for own in expected for i in own]
    assert counts.tolist() == [len(own) for own in expected]


def test_equal_chunks_are_cut_once():
    seen = []

    def cut(text):
        seen.append(text)
        return at_blanks(text)

    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"), cut)
    ids, _ = encoder.ids_by_chunk(["one-two three " * 500] * 4, 2)
    assert len(ids) == 4 * (500 * 4 + 1)
    assert sorted(filter(None, seen)) == ["one-two", "three"]
