import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cardwarden.llm import packing

PARTS = [
    " ", "  ", "\n", "\n\n", "\t ", " \n ", "\r\n", "\x0b", "\x85", "\xa0", " ", "　", "\x1c", "\x00", "word", "Words", "\xe9t\xe9", "na\xefve", "Stra\xdfe", "łódź", "ɐx", "\xaa", "\xd7", "\xf7",
    "12", "2024", "٣", "\xbd", "a1", "it's", "'", "'ll", ".", "...", ",", "(", "\\", "`", "_", "-", "’", "世界", "мир", "é", "\U0001f600", "<|endoftext|>", "<|endof",
]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("together", [3, 40, 1 << 20])
def test_texts_encoded_together_have_the_tokenizers_ids(path, monkeypatch, together):
    monkeypatch.setattr(packing, "TOGETHER", together)
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    encode, plain, r = packing.IdBytes(path), Tokenizer.from_file(path), random.Random(together)
    texts = ["", "", *["".join(r.choices(PARTS, k=r.randint(0, 12))) for _ in range(4000)], ""]
    found = list(encode.many(texts))
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character_of_a_known_kind_is_cut_as_the_tokenizer_cuts(path):
    encode, plain = packing.IdBytes(path), Tokenizer.from_file(path)
    texts = [f"a{c}b {c}1{c} {c}{c}.{c}\n{c} " for c in map(chr, [*range(0x300), *range(0x2000, 0x2070), 0x1680, 0x3000, 0x3001, 0x3002])]
    for text, ids in zip(texts, encode.many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_frequent_words_stay_when_the_cache_is_full(path, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    encode = packing.IdBytes(path)
    chunk, asked = encode._chunk, []
    encode._chunk = lambda c: asked.append(c) or chunk(c)
    letters = "abcdefghij"
    for i in range(60):
        encode("start often " + " ".join(f"w{letters[i // 10]}{letters[i % 10]}{x}{y}" for x in letters[:4] for y in letters[:5]))
    assert asked.count(" often") == 1
    assert len(encode.cache) + len(encode.older) < 200


def test_letters_digits_and_marks_are_cut_before_they_are_encoded(path):
    encode = packing.IdBytes(path)
    whole, given = encode._encode, []
    encode._encode = lambda text: given.append(text) or whole(text)
    encode("un \xe9t\xe9, (na\xefve) caf\xe9! caf\xe9? item-12, item-7")
    assert not [t for t in given if any(c.isalpha() for c in t)]


def test_pieces_of_a_batch_have_each_documents_ids(path):
    plain = Tokenizer.from_file(path)
    texts = [None, "", "one two three", "x " * 1500, "one two three", "<|endoftext|> y"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, None, 3, 4, 3, 6], pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    (out,) = packing._pieces(path, 1024)(iter([batch]))
    totals = [len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    rows = out.to_pylist()
    firsts = [p for p in rows if p["start"] == 0]
    assert [(p["doc_id"], p["doc_tokens"]) for p in firsts] == list(zip([1, None, 3, 4, 3, 6], totals))
    assert sum(p["length"] for p in rows) == sum(totals)
