"""The memory of the encoder, and units whose ends the tokens do not meet."""

import itertools

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tesselar.llm.encode import SLICE_ROWS, WordEncoder
from tesselar.llm.word_pointers import Pointers
from tests.llm.test_free import TEXTS

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def as_loaded(name, texts):
    return [Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids for text in texts]


def as_lists(found):
    return [np.frombuffer(ids, "<u4").tolist() for ids in found]


def test_words_of_many_slices_are_encoded_once():
    words = map("".join, itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4))
    texts = ["".join(f" {word}" for word in itertools.islice(words, 150)) for _ in range(5 * SLICE_ROWS)]
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    first = encoder.ids(texts)
    assert as_lists(first[::500]) == as_loaded("word_bpe_49k.json", texts[::500])
    # Nothing is left to encode.
    encoder.tokenizer = None
    assert encoder.ids(texts) == first


@pytest.mark.parametrize("name", NAMES)
def test_tokens_that_do_not_end_with_the_words(name):
    encoder = WordEncoder(public_tokenizers.path(name), added_tokens=True)
    encoder.token_bytes[::3] += 1
    assert as_lists(encoder.ids(TEXTS)) == as_loaded(name, TEXTS)


@pytest.mark.parametrize("name", NAMES)
def test_units_with_one_hash(name, monkeypatch):
    monkeypatch.setattr(Pointers, "hashes", lambda self, seed=0: np.full(len(self), 7, np.uint64))
    encoder = WordEncoder(public_tokenizers.path(name), memory=40, added_tokens=True)
    for _ in range(3):
        assert as_lists(encoder.ids(TEXTS)) == as_loaded(name, TEXTS)
