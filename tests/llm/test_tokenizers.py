"""Distinct units through the library's model give what the library gives for whole texts, also for tokenizers of other kinds."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quern.llm.tokens import WordTokenizer

ALPHABET = "abcXYZ éÉßñÀ09'!.,;#$-_İΣσςЖжあ\u0301eµǅ\t\n\x1c\u2028  日本🎉'sS'LL'dD~"


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_equal_to_the_library(name):
    file = public_tokenizers.path(name)
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "<|endoftext|> x <|startoftext|>", "it's I'LL 'S", "x" * 500, "word " * 3000]
    own, whole = WordTokenizer(file), Tokenizer.from_file(file)
    assert own.by_units == (name == "word_bpe_49k.json")
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.array_equal(ids, np.array(whole.encode(text, add_special_tokens=False).ids, np.int32)), text
