import random
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
import public_tokenizers
from cardwarden.llm.packing import pack_documents
from cardwarden.llm.sharding import shard_documents
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    own = [" ".join(rng.choices(words, k=int(rng.paretovariate(0.9) * 6) % 1500)) for _ in range(1300)]
    return own + ["the same text for a third of all rows"] * 700


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_shards(docs, texts):
    rows = shard_documents(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    slots = defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))


def test_packing(docs, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pack_documents(docs).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(range(len(texts)))
    for doc, found in pieces.items():
        ids = plain.encode(texts[doc], add_special_tokens=False).ids + [0]
        at = 0
        for start, length, crc, total in sorted(found):
            raw = b"".join(i.to_bytes(4, "little") for i in ids[at : at + length])
            assert (start, crc, total) == (at, zlib.crc32(raw), len(ids))
            at += length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024


def test_exact_stage_of_the_pipeline(spark, docs, texts):
    assert corpus_pipeline.STAGES[1] == ("exact_dedup", corpus_pipeline.drop_copies)
    kept = corpus_pipeline.drop_copies(spark, docs, "").collect()
    assert Counter(r["doc_id"] for r in kept) == Counter({t: i for i, t in enumerate(texts)}.values())
