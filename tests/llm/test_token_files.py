import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cardwarden.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, part int, key string"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(plain, text):
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_ids_equal_those_of_the_library(plain):
    rng = random.Random(3)
    pieces = ["Word", "straße", "ÉCOLE", "école.", "it's", "IT'S!!", "a.b", "x1y2", "…", "é", "́", " ", "  ", "\n", "\r\n", "\t", "\x1c", " ", "　", "ΑΣ", "ΟΔΟΣ.", "İ", "<|endoftext|>", "<|startoftext|>x", "日本", "😀", "\0", ".,;", "'re", "µ", "ª1", "ÿ", "×÷", "word" * 80]
    encode = tf.WordIds(PATH)
    assert encode.cuts and encode.kind.itemsize == 2
    for _ in range(3000):
        text = rng.choice([" ", "", "\n"]).join(rng.choices(pieces, k=rng.randrange(0, 12)))
        assert np.frombuffer(encode(text), "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_settings_are_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, other = tf.WordIds(path), Tokenizer.from_file(path)
    assert not encode.cuts
    for text in ["", "a  b\n c", "Straße."]:
        assert np.frombuffer(encode(text), "<u2").tolist() == other.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(10**12, n, replace=False) - 10**11
    none, zero = np.zeros(n, bool), np.zeros(n, np.int64)
    hashes = tf.key_hash(keys, none, zero, 0)
    index = tf.PerfectHash.build(hashes)
    assert sorted(index.slots(hashes)) == list(range(n))
    assert tf.PerfectHash.build(np.array([5, 5], np.uint64)) is None
    if n:
        file = tf.IdFile(tf.pack_file(sorted(keys.tolist()), [b"\2\0"] * n, np.dtype("<u2"), 0, 0) + b"\n")
        assert (file.find(keys, none, zero) >= 0).all()
        assert (file.find(keys + 10**13, none, zero) < 0).all() and (file.find(keys, none, zero + 1) < 0).all()
        assert len(index.words) * 8 <= 1.2 * n + 64  # bytes of bits


ROWS = [(5, "five five", 1, "x"), (-3, "minus", 1, "x"), (5, "five five", 1, "x"), (5, None, 1, "x"), (None, "no id", 1, "x"), (None, "", 1, "x"), (0, "", 1, "x"), (8, "very long " * 60_000, 1, "x")]


@pytest.mark.parametrize("file_bytes", [1, 400, 32 << 20])
def test_round_trip_against_brute_force(spark, plain, file_bytes):
    rng = random.Random(file_bytes)
    rows = ROWS + [(rng.randrange(-50, 10**6), " ".join(rng.choices(["One", "two,", "drei", "…"], k=rng.randrange(40))), 1, "x") for _ in range(300)] + [(77, "hot key", 1, "x")] * 150
    path = tempfile.mkdtemp(prefix="token-files-") + "/files"
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tf.write_token_files(docs, path, PATH, file_bytes=file_bytes)
    got = sorted(tf.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    at, want = 0, []
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    for doc, text, *_ in rows:
        ids = ids_of(plain, text)
        want.append((doc, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got], key=repr) == sorted(want, key=repr)
    fetched = tf.fetch(spark, path, [5, 77, 0, 123456789012]).collect()
    assert sorted((r["key"], len(r["ids"])) for r in fetched) == sorted((k, len(ids_of(plain, t))) for k, t, *_ in rows if k in (5, 77, 0))
    payload = b"".join(tf.IdFile(bytes(f["content"])).payload.tobytes() for f in sorted(tf._files(spark, path).collect(), key=lambda f: (lambda x: (x["part"], x["piece"]))(tf.IdFile(bytes(f["content"])).footer)))
    assert len(payload) == 2 * at


def test_no_documents(spark):
    path = tempfile.mkdtemp(prefix="token-files-") + "/files"
    tf.write_token_files(spark.createDataFrame([], SCHEMA), path, PATH)
    assert tf.read_token_files(spark, path).collect() == [] and tf.fetch(spark, path, [1]).collect() == []


def test_a_file_is_sealed_in_place_and_handed_over_without_a_copy():
    content = bytearray(b"\x01\x00\x02\x00\x02\x00")
    held = tf.sealed([3, 5], content, [4, 2], np.dtype("<u2"), 0, 0)
    assert held is content
    assert bytes(held) == tf.pack_file([3, 5], [b"\x01\x00\x02\x00", b"\x02\x00"], np.dtype("<u2"), 0, 0)
    cell = tf._file_row(held).column(0)
    assert cell[0].as_py() == bytes(held)
    assert cell.buffers()[2].address == np.frombuffer(held, np.uint8).ctypes.data
