import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cardwarden.llm.packing import IdBytes


def test_ids_equal_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain = IdBytes(path), Tokenizer.from_file(path)
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    assert "<|endoftext|>" in added
    for text in ["a plain text", "", *[f"{a}{t}{b}" for t in added for a in ("", "one ", "one two", "x  ") for b in ("", " three", "four five", "\n")]]:
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, text
