"""Exact duplicates by Patricia tries: each partition of the space of (length, content hash) inserts whole
byte strings into a compressed radix trie whose terminal nodes hold the row that owns the text.

Copies meet twice. Each scan task builds tries of what it reads and passes on one row for each distinct
text, so a text that a third of all rows share reaches its owner partition once per scan task. The owner
partition inserts those rows into its own trie, compares every byte on the way and merges ids at the
terminal node. Rows then look their owner up by length and hash in a plain join, whose hot keys adaptive
execution may split.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, table

TRIE_MB = 96
_SCHEMA = "__length long, __sha string, __text binary, __best long, __tag long, __n long"


def common_prefix(a: bytes, at: int, b: bytes) -> int:
    """Length of the longest common prefix of ``a[at:]`` and ``b``."""
    low, high = 0, min(len(a) - at, len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[at + low : at + mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Node:
    __slots__ = ("label", "children", "value", "spilled")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value, self.spilled = label, {}, value, None


class PatriciaTrie:
    """Byte strings to values; ``merge`` joins the values of equal strings.

    Once the labels take more than ``limit`` bytes, the heaviest subtree below the first branch goes to a
    temporary file of the task, as (rest of key, value); later keys of that subtree follow it there. Where a
    part of the subtree was spilled before, its file is copied into the new one.
    ``drain`` gives all values, in-memory ones first, then each spilled subtree through a trie of its own.
    """

    def __init__(self, merge: Callable, limit: int = TRIE_MB << 20):
        self.root, self.merge, self.limit, self.held = Node(b""), merge, limit, 0

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            if node.spilled is not None:
                pickle.dump((key[at:], value), node.spilled, protocol=5)
                return
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                self.held += len(key) - at + 200
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common_prefix(key, at, label)
            middle = Node(label[:same])
            child.label = label[same:]
            middle.children[child.label[0]] = child
            node.children[key[at]] = middle
            self.held += 200
            node, at = middle, at + same
        if self.held > self.limit:
            self._spill()

    @staticmethod
    def _read(file) -> Iterator[tuple[bytes, object]]:
        """What was spilled to ``file``, which is then closed."""
        file.seek(0)
        while True:
            try:
                entry = pickle.load(file)
            except EOFError:
                break
            yield entry
        file.close()

    @staticmethod
    def _entries(node: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        """All of a subtree, what was spilled below it included; those files are used up."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.spilled is not None:
                for rest, value in PatriciaTrie._read(node.spilled):
                    yield prefix + rest, value
            elif node.value is not None:
                yield prefix, node.value
            for child in node.children.values():
                stack.append((child, prefix + child.label))

    @staticmethod
    def _weight(node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            if node.spilled is None:
                total += len(node.label) + 200
            stack.extend(node.children.values())
        return total

    def _spill(self) -> None:
        top = self.root
        while len([c for c in top.children.values() if c.spilled is None]) == 1 and len(top.children) == 1:
            top = next(iter(top.children.values()))
        heavy = max((c for c in top.children.values() if c.spilled is None), key=self._weight, default=None)
        if heavy is None:
            return
        weight = self._weight(heavy)
        file = tempfile.TemporaryFile()
        for rest, value in self._entries(heavy, b""):
            pickle.dump((rest, value), file, protocol=5)
        heavy.children, heavy.value, heavy.spilled = {}, None, file
        self.held -= weight

    def drain(self, prefix: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """All (key, value), without holding the values of more than one subtree beyond the limit."""
        files, stack = [], [(self.root, prefix)]
        while stack:
            node, at = stack.pop()
            if node.spilled is not None:
                files.append((node.spilled, at))
            elif node.value is not None:
                yield at, node.value
            stack.extend((c, at + c.label) for c in node.children.values())
        self.root = Node(b"")
        for file, at in files:
            inner = PatriciaTrie(self.merge, self.limit)
            for rest, value in self._read(file):
                inner.insert(rest, value)
            yield from inner.drain(at)


def _merger(largest: bool) -> Callable:
    """Of two terminal values (id, row tag, rows, hash): the owner is the row with the largest or smallest
    id, of repeated rows the one with the smaller tag; a null id owns nothing that has another."""

    def first(a, b):
        if a[0] is None or b[0] is None:
            if (a[0] is None) != (b[0] is None):
                return b[0] is None
        elif a[0] != b[0]:
            return (a[0] > b[0]) == largest
        return a[1] <= b[1]

    def merge(a, b):
        won = a if first(a, b) else b
        return (won[0], won[1], a[2] + b[2], won[3])

    return merge


def _tries(largest: bool, limit: int, keep_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _merger(largest)
        trie = PatriciaTrie(merge, limit)

        def rows(found) -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            for key, (best, tag, n, sha) in found:
                out.append((len(key) - 8, sha, key[8:] if keep_text else None, best, tag, n))
                size += len(key) if keep_text else 100
                if size > 8 << 20:
                    yield batch(out)
                    out, size = [], 0
            if out:
                yield batch(out)

        for b in batches:
            for length, sha, text, best, tag, n in zip(*[c.to_pylist() for c in b.columns]):
                trie.insert(length.to_bytes(8, "big") + text, (best, tag, n, sha))
            if keep_text and trie.held > limit // 2:  # the scan side passes on what it has and starts anew
                yield from rows(trie.drain())
                trie = PatriciaTrie(merge, limit)
        yield from rows(trie.drain())

    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def batch(out) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest", limit_mb: int = TRIE_MB) -> DataFrame:
    """Add ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` to every row of ``df``.

    Texts are equal when their bytes are; a null text counts as empty. The row with the largest (or
    smallest) ``key`` of a group stays; a null key stays only where the group has no other, and of rows
    with the same key the one that is read first stays. An empty table gives an empty one; columns of
    ``df`` with the names of the added ones are replaced. ``df`` must give the same rows in the same
    partitions when read twice, as any table does.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    marked = df.withColumns({"__tag": F.monotonically_increasing_id(), "__text": content})
    marked = marked.withColumns({"__length": F.octet_length("__text").cast("long"), "__sha": F.sha2("__text", 256)})
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    seen = marked.withColumns({"__best": F.col(key).cast("long"), "__n": F.lit(1).cast("long")}).select(*names)
    largest, limit = keep == "largest", limit_mb << 20
    local = arrow_map(seen, _tries(largest, limit, True), _SCHEMA)
    owners = arrow_map(local.repartition("__length", "__sha"), _tries(largest, limit, False), _SCHEMA)
    owners = owners.select(
        F.col("__length").alias("__l"), F.col("__sha").alias("__s"), F.col("__best").alias("__keep"),
        F.col("__tag").alias("__owner"), F.col("__n").alias("__rows"),
    )
    found = marked.join(owners, (F.col("__length") == F.col("__l")) & (F.col("__sha") == F.col("__s")), "left")
    owned = lambda c: F.when(F.col("__owner").isNull(), F.raise_error(F.lit("exact_dedup: a row without an owner"))).otherwise(c)
    rest = [c for c in df.columns if c not in added]
    return found.select(
        *rest, owned(F.col("__keep")).alias("keep_id"), owned(F.col("__rows")).alias("group_size"),
        owned(F.col("__tag") == F.col("__owner")).alias("kept"), F.col("__sha").alias("text_sha256"),
    )


def op3_patricia_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
