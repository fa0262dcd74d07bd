"""Token ids in binary files, each with its own index for access by key.

Documents are dealt by ranges of the key, sorted, encoded and packed into files of about ``FILE_BYTES``. A file
is one row of Spark's text writer, so it is written, committed and repeated like any other Spark output, in
any store that Spark reaches; it ends with the writer's line break. Its parts, little-endian:

    payload       ids of all documents in the order of their keys, each document closed by the end id
    keys          8 bytes a document, in the same order, null keys first
    bits, ranks   minimal perfect hash: bits of all levels, and the ones before each 64 of them
    offsets, lengths, fingerprints     by hash slot: first id in the payload, number of ids, 32 bits of the key's hash
    footer        JSON of ``FOOTER`` bytes: sizes, levels, seed, first and last key, place among all files

A key is hashed level by level until its bit is set; the ones before that bit are its slot. No level holds more
than about a third of the keys of the level before, so a look-up touches two levels on average, whatever
the number of documents, and the fingerprint tells a key that was never stored.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, new_path, table

END_ID = 2
FILE_BYTES = 32 << 20
PART_BYTES = 64 << 20
LEAST_PART = 4 << 20
FOOTER = 512
CACHE_WORDS = 250_000
_FOOTER = "part long, piece long, docs long, ids long, first long, last long"

# fixed values: the settings of a tokenizer file under which spaces and line breaks always separate
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LATIN = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)}
_MARKS = ".,;:!?*#$%&\"()[]{}<>=+-/|_~^@"


class WordIds:
    """A text's ids as little-endian bytes, equal to those of ``tokenizers`` without special tokens.

    Where the file's settings let no token cross a space or a line break, texts are cut there and each distinct
    chunk is encoded once. A chunk of Latin letters and closing marks is two tokens' worth of work: normalizing is
    then lower-casing, so its letters go to the model directly, once for all spellings. With other settings texts
    are encoded whole. The caches, some 200 bytes a word, only save time; they are emptied when they are full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        normal, split = settings["normalizer"] or {}, settings["pre_tokenizer"] or {}
        parts = split.get("pretokenizers") or [{}]
        self.cuts = normal.get("normalizers") == _NORMALIZER and parts[0].get("pattern") == {"Regex": _PATTERN} and len(parts) == 2 and parts[1].get("use_regex") is False
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {ord(c): level.pre_tokenize_str(c)[0][0] for c in _LATIN if ord(c) > 127}
        self.model = self.tokenizer.model
        self.chunks: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.code = {2: "H", 4: "I"}[self.kind.itemsize]

    def _bytes(self, ids: list[int]) -> bytes:
        held = array(self.code, ids)
        if sys.byteorder == "big":
            held.byteswap()
        return held.tobytes()

    def _chunk(self, chunk: str) -> bytes:
        core = chunk.rstrip(_MARKS)
        if not core or not _LATIN.issuperset(core):
            return self._bytes(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        low = core.lower()
        found = self.letters.get(low)
        if found is None:
            text = low if low.isascii() else low.translate(self.mapped)
            found = self.letters[low] = self._bytes([t.id for t in self.model.tokenize(text)])
        tail = chunk[len(core) :]
        if tail not in self.marks:
            self.marks[tail] = self._bytes(self.tokenizer.encode(tail, add_special_tokens=False).ids)
        return found + self.marks[tail]

    def __call__(self, text: str) -> bytes:
        if not self.cuts:
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        chunks = text.replace("\n", " ").split(" ")
        found = list(map(self.chunks.get, chunks))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    found[i] = self.chunks[chunks[i]] = self._chunk(chunks[i])
            for cache, empty in ((self.chunks, {"": b""}), (self.letters, {}), (self.marks, {"": b""})):
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                    cache.update(empty)
        return b"".join(found)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (xor, shift, multiply)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = 0x9E3779B97F4A7C15


def key_hash(keys: np.ndarray, nulls: np.ndarray, copies: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of (key, copy); a repeated key's rows are told apart by their copy number."""
    once = mix(np.where(nulls, 0, keys).astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * _STEP % (1 << 64)))
    more = copies.astype(np.uint64) * np.uint64(2) + nulls.astype(np.uint64)
    return mix(once + more * np.uint64(_STEP))


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64((level + 1) * _STEP % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes: in each level a key that is alone in its place sets the
    place's bit; the others go on to the next level."""

    def __init__(self, words: np.ndarray, ranks: np.ndarray, sizes: list[int]):
        self.words, self.ranks, self.sizes = words, ranks, sizes

    @classmethod
    def build(cls, hashes: np.ndarray, levels: int = 64) -> PerfectHash | None:
        """None where two hashes are equal."""
        found, sizes = [], []
        while len(hashes):
            if len(sizes) == levels:
                return None
            size = -(-2 * len(hashes) // 64) * 64
            at = _place(hashes, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            found.append(alone)
            sizes.append(size)
            hashes = hashes[~alone[at]]
        bits = np.concatenate(found) if found else np.zeros(0, bool)
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.int64)
        return cls(words, (np.cumsum(ones) - ones).astype("<u4"), sizes)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where no level has its bit."""
        out = np.full(len(hashes), -1, np.int64)
        open_, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(hashes[open_], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = self.ranks[at[hit] >> 6].astype(np.int64) + below[hit]
            open_, base = open_[~hit], base + size
            if not len(open_):
                break
        return out


def _copies(keys: np.ndarray, nulls: int) -> np.ndarray:
    """For sorted keys with nulls first, how many equal ones stand before each."""
    at = np.arange(len(keys))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    new[1:nulls] = False
    if nulls < len(keys):
        new[nulls] = True
    return at - np.maximum.accumulate(np.where(new, at, 0)) if len(keys) else at


def pack_file(keys: list[int | None], documents: list[bytes], kind: np.dtype, part: int, piece: int) -> bytes:
    """One file: documents (ids with their end id) in the order of their keys, nulls first."""
    return bytes(sealed(keys, bytearray(b"".join(documents)), [len(d) for d in documents], kind, part, piece))


def sealed(keys: list[int | None], content: bytearray, sizes: list[int], kind: np.dtype, part: int, piece: int) -> bytearray:
    """``content``, a file's payload with documents of ``sizes`` bytes, made a whole file in place, so that the payload
    is held once."""
    nulls = sum(k is None for k in keys)
    held = np.array([0 if k is None else k for k in keys], "<i8")
    lengths = np.array(sizes, np.int64) // kind.itemsize
    lengths = lengths.astype("<u4")
    offsets = np.cumsum(lengths, dtype="<u8") - lengths
    empty = np.arange(len(keys)) < nulls
    for seed in range(100):
        hashes = key_hash(held, empty, _copies(held, nulls), seed)
        index = PerfectHash.build(hashes)
        if index is not None:
            break
    else:
        raise ValueError("no seed tells the keys apart")
    slot = index.slots(hashes)
    by_slot = np.empty(len(keys), np.int64)
    by_slot[slot] = np.arange(len(keys))
    sections = [
        held.tobytes(), index.words.tobytes(), index.ranks.tobytes(),
        offsets[by_slot].astype("<u8").tobytes(), lengths[by_slot].tobytes(), (hashes[by_slot] >> np.uint64(32)).astype("<u4").tobytes(),
    ]
    footer = {
        "part": part, "piece": piece, "docs": len(keys), "ids": int(lengths.sum()), "first": keys[0], "last": keys[-1],
        "nulls": nulls, "width": kind.itemsize, "seed": seed, "sizes": [len(content), *map(len, sections)], "levels": index.sizes,
    }
    for section in sections:
        content += section
    content += json.dumps(footer, separators=(",", ":")).encode().ljust(FOOTER)
    return content


class IdFile:
    """A file's documents by key."""

    def __init__(self, content: bytes):
        end = len(content) - 1  # the writer's line break
        self.footer = json.loads(bytes(content[end - FOOTER : end]))
        kinds = [f"<u{self.footer['width']}", "<i8", "<u8", "<u4", "<u8", "<u4", "<u4"]
        at, parts = 0, []
        for size, kind in zip(self.footer["sizes"], kinds):
            parts.append(np.frombuffer(content, kind, size // np.dtype(kind).itemsize, at))
            at += size
        self.payload, self.keys, words, ranks, self.offsets, self.lengths, self.marks = parts
        self.nulls = np.arange(len(self.keys)) < self.footer["nulls"]
        self.copies = _copies(self.keys, self.footer["nulls"])
        self.index = PerfectHash(words, ranks, self.footer["levels"])

    def find(self, keys: np.ndarray, nulls: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """The slot of each (key, copy), -1 where the file does not hold it (but for one in 2^32)."""
        hashes = key_hash(keys, nulls, copies, self.footer["seed"])
        slot = self.index.slots(hashes)
        if not len(self.marks):
            return slot
        return np.where((slot >= 0) & (self.marks[slot] == hashes >> np.uint64(32)), slot, -1)

    def ids(self, slot: int) -> np.ndarray:
        start = int(self.offsets[slot])
        return self.payload[start : start + int(self.lengths[slot])].astype("<u4")


def _packed(path: str, end_id: int, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        end = np.array([end_id], encode.kind).tobytes()
        part, piece = TaskContext.get().partitionId(), 0
        keys: list = []
        sizes: list[int] = []
        content = bytearray()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                before = len(content)
                content += encode(text.as_py() or "")
                content += end
                keys.append(key)
                sizes.append(len(content) - before)
                if len(content) >= limit:
                    yield _file_row(sealed(keys, content, sizes, encode.kind, part, piece))
                    keys, sizes, content, piece = [], [], bytearray(), piece + 1
        if keys:
            yield _file_row(sealed(keys, content, sizes, encode.kind, part, piece))

    return run


def _file_row(content: bytearray) -> pa.RecordBatch:
    """A batch of one file, whose bytes are not copied."""
    ends = pa.py_buffer(np.array([0, len(content)], np.int32))
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(content)])], names=["file"])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Write all texts in ascending order of their keys, nulls first.

    A null text is empty and gives its end id alone; rows of one key stay side by side, in the order of a hash of
    their texts; other columns are not stored. No rows give no files.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("key"), body.alias("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-total // PART_BYTES), min(total // LEAST_PART, 2 * cores))
    # the last column lets rows that agree in key and text go to several parts
    order = ["key", "same", "row"]
    dealt = rows.withColumns({"same": F.xxhash64("body"), "row": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("key", "body")
    files = arrow_map(dealt, _packed(tokenizer, end_id, file_bytes), "file binary")
    writer = files.select(F.col("file").cast("string").alias("value")).write
    writer.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).where("length > 0")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, from the footers: path, part, piece, docs, ids, first, last, base (ids in the files before).
    A single task adds up the ids, one row a file."""
    footer = F.from_json(F.substring(F.col("content"), F.col("length").cast("int") - FOOTER, F.lit(FOOTER)).cast("string"), _FOOTER)
    read = _files(spark, path).select("path", footer.alias("footer")).select("path", "footer.*")
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return read.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "piece", "key", "at", "n_tokens", "ids_crc32"]
    for batch in batches:
        for content in batch.column(0):
            held = IdFile(content.as_buffer())
            slots = held.find(held.keys, held.nulls, held.copies)
            if (slots < 0).any():
                raise ValueError("a stored key is not in its file's index")
            n = len(slots)
            columns = [
                pa.array(np.full(n, held.footer["part"])), pa.array(np.full(n, held.footer["piece"])), pa.array(held.keys.astype(np.int64), mask=held.nulls),
                pa.array(held.offsets[slots].astype(np.int64)), pa.array(held.lengths[slots].astype(np.int64)),
                pa.array([zlib.crc32(held.ids(s).tobytes()) for s in slots], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, each fetched by its key: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as 32-bit numbers, end id included)."""
    found = arrow_map(_files(spark, path).select("content"), _looked_up, "part long, piece long, key long, at long, n_tokens long, ids_crc32 long")
    base = manifest(spark, path).select(F.col("part").alias("m_part"), F.col("piece").alias("m_piece"), "base")
    held = found.join(base, (F.col("part") == F.col("m_part")) & (F.col("piece") == F.col("m_piece")))
    return held.select(F.col("key").alias("doc_id"), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _fetched(keys: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.array(sorted(set(keys)), np.int64)
        for batch in batches:
            for content in batch.column(0):
                held = IdFile(content.as_buffer())
                out, copy, left = [], 0, asked
                while len(left):
                    slots = held.find(left, np.zeros(len(left), bool), np.full(len(left), copy))
                    out += [(int(k), held.ids(s).tolist()) for k, s in zip(left, slots) if s >= 0]
                    left, copy = left[slots >= 0], copy + 1
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.int64()))], names=["key", "ids"])

    return run


def fetch(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """Key and ids (with the end id) of the asked documents, one row for each stored copy; keys that are not stored
    give no row. Only files whose key range holds an asked key are opened."""
    wanted = F.array(*[F.lit(int(k)).cast("long") for k in keys])
    # nulls come first, so a file that begins with them may hold any key up to its last
    inside = F.exists(wanted, lambda k: (k <= F.col("last")) & (F.col("first").isNull() | (k >= F.col("first"))))
    paths = [r["path"] for r in manifest(spark, path).where(inside).select("path").collect()] if keys else []
    if not paths:
        return spark.createDataFrame([], "key long, ids array<long>")
    return arrow_map(_files(spark, paths).select("content"), _fetched(list(keys)), "key long, ids array<long>")


def op13_perfect_hash_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)
