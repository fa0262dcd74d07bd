import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cardwarden.llm.packing import IdBytes

PARTS = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " \n ", "\x85", "\xa0", "　", "\x1c", "\x1f", "word", "Word", "don't", "'S", "x's", "12", "a1", "\xe9t\xe9", "世界", ".", "...", ",", "'", "(", "_", "\U0001f600", "é"]


def test_random_runs_of_space_give_the_tokenizers_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain, r = IdBytes(path), Tokenizer.from_file(path), random.Random(4)
    for _ in range(4000):
        text = "".join(r.choices(PARTS, k=r.randint(0, 9)))
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_with_line_breaks_are_not_encoded_whole():
    encode = IdBytes(public_tokenizers.path("byte_bpe_50k.json"))
    whole, given = encode._encode, []
    encode._encode = lambda text: given.append(text) or whole(text)
    encode("one two\n\nthree  four \n")
    assert "one two\n\nthree  four \n" not in given
    assert {" two", " four"} <= set(encode.cache)
