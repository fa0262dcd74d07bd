"""Pack documents into sequences by column generation for the cutting-stock problem.

A document's ids are cut every 1024; from what remains, 512 are cut off where there are as many, so that
pieces which are not full or half a sequence are short and fit together well. Full pieces are sequences of
their own. For the rest only the histogram of lengths, at most 512 counts, goes to the driver: a linear
program chooses how often each pattern of lengths is used, and a knapsack by dynamic programming prices new
patterns from its dual values. Pattern counts are rounded down, what is left is filled greedily, and the
pieces of each length, ranked in parallel, take the places that the patterns have for that length.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, ranked, stage, table

LENGTH = 1024
GAP = 0.0005
CACHE_WORDS = 150_000
TOGETHER = 1 << 20  # characters that are cut and looked up at a time
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# White space as the tokenizer's rule has it. A run before a word is one chunk but for its last character, which
# goes to the word if it is a space; so the byte-level rule never joins what these chunks separate.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]")
_LATIN = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x250) if c not in (0xD7, 0xF7))
_MARKS = string.punctuation.replace("'", "")
_WORD = re.compile(f" ?[{_LATIN}]+")
_BLANK = "\u0120"  # how the byte-level rule writes a space
# kinds of characters, the least for those of no other kind; the last place stands for all above
_OTHER, _WHITE = 0, 1
_KIND = np.full(0x3002, _OTHER, np.uint8)
for _kind, _those in enumerate((_SPACE, _LATIN, string.digits, _MARKS), _WHITE):
    _KIND[[ord(c) for c in _those]] = _kind


def _before(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Each place's value one place before; 0 at the places ``firsts``."""
    out = np.zeros_like(values)
    out[1:] = values[:-1]
    out[firsts] = 0
    return out


def chunks_of(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The chunks of all texts, one after another, and how many each text has."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    firsts = (ends - sizes)[sizes > 0]
    kind = _KIND[np.minimum(points, len(_KIND) - 1)]
    white = kind == _WHITE
    after = _before(white, firsts)
    # whether a place of its text comes next that is not white
    to_word = _before((~white)[::-1], len(points) - firsts[1:])[::-1]
    begins = (white & (~after | to_word)) | (~white & after & (_before(points, firsts) != ord(" ")))
    begins[firsts] = True
    starts = np.flatnonzero(begins)
    if len(starts):
        # where all characters of a chunk are of known kinds, the rule cuts it wherever the kind changes
        known = np.minimum.reduceat(kind, starts) > _OTHER
        change = ~white & ~after & (kind != _before(kind, firsts))
        begins |= change & np.repeat(known, np.diff(starts, append=len(points)))
        starts = np.flatnonzero(begins)
    width = 1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
    offsets = np.zeros(len(starts) + 1, np.int64)
    if len(starts):
        np.cumsum(np.add.reduceat(width, starts, dtype=np.int64), out=offsets[1:])
    chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
    return chunks, np.diff(np.searchsorted(starts, ends), prepend=0)


class IdBytes:
    """A text's ids as little-endian 32-bit bytes, equal to those of ``tokenizers``.

    Texts are cut where the byte-level rule cuts at white space and, in chunks of Latin letters, digits and marks,
    between these, and each distinct chunk in about ``TOGETHER`` characters is looked up once. One word of letters goes
    to the model directly. Texts with the string of an added token are encoded whole.
    The cache only saves time; it keeps what was used of late, at most about twice ``CACHE_WORDS`` chunks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = {ord(c): level.pre_tokenize_str(c)[0][0] for c in _LATIN if not c.isascii()}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        if not _WORD.fullmatch(chunk):
            return self._encode(chunk)
        written = chunk if chunk.isascii() else chunk.translate(self.written)
        ids = [t.id for t in self.model.tokenize(written.replace(" ", _BLANK))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _look_up(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks. A full cache steps back, and what is asked for again returns from there."""
        found = list(map(self.cache.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, map(self.older.get, map(chunks.__getitem__, new))):
            found[i] = self._chunk(chunks[i]) if ids is None else ids
        if len(self.cache) >= CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        self.cache.update((chunks[i], found[i]) for i in new)
        return found

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _together(self, texts: list[str]) -> list[bytes]:
        whole = {i: self._encode(t) for i, t in enumerate(texts) if self._adds(t)}
        chunks, counts = chunks_of(["" if i in whole else t for i, t in enumerate(texts)])
        held = chunks.dictionary_encode()
        found = self._look_up(held.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = held.indices.to_numpy()
        sizes = size[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        # a chunk's ids stand together, so all of them lie equally far from their places in ``found``
        away = np.repeat((np.cumsum(size) - size)[at] - ends[:-1], sizes)
        ids = np.frombuffer(b"".join(found), "<u4")[np.arange(len(away)) + away].tobytes()
        cuts = [0, *(4 * ends[np.cumsum(counts)]).tolist()]
        return [whole.get(i) or ids[a:b] for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]

    def _adds(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of a text, and whether it is the last: cut, where the text is long, before a run of white space."""
        at, long = 0, len(text) > TOGETHER and not self._adds(text)
        while long and len(text) - at > TOGETHER and (cut := _RUN.search(text, at + TOGETHER)):
            yield text[at : cut.start()], False
            at = cut.start()
        yield text[at:], True

    def _groups(self, texts: Iterable[str]) -> Iterator[list[tuple[str, bool]]]:
        group, total = [], 0
        for text in texts:
            for part in self._parts(text):
                group.append(part)
                total += len(part[0])
                if total >= TOGETHER:
                    yield group
                    group, total = [], 0
        if group:
            yield group

    def many(self, texts: Iterable[str]) -> Iterator[bytes]:
        begun: list[bytes] = []
        for group in self._groups(texts):
            for (_, last), ids in zip(group, self._together([part for part, _ in group])):
                begun.append(ids)
                if last:
                    yield b"".join(begun)
                    begun = []

    def __call__(self, text: str) -> bytes:
        return next(self.many([text]))


@lru_cache(maxsize=2)
def id_bytes(path: str) -> IdBytes:
    return IdBytes(path)


def _pieces(path: str, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_bytes(path)
        step = 4 * length
        names = [x.split()[0] for x in _PIECES.split(", ")]
        for b in batches:
            out: list[tuple] = []
            texts = (t.as_py() or "" for t in b.column(1))
            for doc, ids in zip(b.column(0).to_pylist(), encode.many(texts)):
                ids += b"\0\0\0\0"
                whole = len(ids) - len(ids) % step
                cuts = [*range(0, whole, step), whole, len(ids)]
                if len(ids) - whole > step // 2:
                    cuts.insert(-1, whole + step // 2)
                for at, end in zip(cuts, cuts[1:]):
                    if at == end:
                        continue
                    piece = ids[at:end]
                    out.append((doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def pieces_of(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return arrow_map(texts, _pieces(path, length), _PIECES)


def _cost(total: int, length: int) -> int:
    """Padded size: full, or the ids alone where their number is a power of two."""
    return total if total & (total - 1) == 0 else length


def _best_patterns(values: np.ndarray, length: int) -> list[tuple[float, list[int]]]:
    """Unbounded knapsack: for capacity ``length`` and for each exact power of two below it, the pattern
    with the highest value minus cost. ``values`` by length; zero at 0."""
    best = np.full(length + 1, -np.inf)
    best[0] = 0.0
    took = np.zeros(length + 1, dtype=np.int64)
    for t in range(1, length + 1):
        gain = best[t - 1 :: -1][: t] + values[1 : t + 1]
        k = int(np.argmax(gain))
        best[t], took[t] = gain[k], k + 1
    ends = [int(np.argmax(best))] + [2**k for k in range(length.bit_length()) if 2**k < length]
    found = []
    for end in ends:
        if not np.isfinite(best[end]):
            continue
        pattern, t = [], end
        while t:
            pattern.append(int(took[t]))
            t -= int(took[t])
        found.append((float(best[end]) - _cost(end, length) / length, pattern))
    return found


def _first_basis(sizes: np.ndarray, demand: np.ndarray, length: int) -> list[list[int]]:
    """A pattern for each length, found one after another: a full pattern that prefers long pieces is used
    until it uses up a length, which then leaves. Each pattern holds the length it uses up and none that
    was used up before, so the patterns are independent and their amounts are not negative."""
    left = {int(s): float(n) for s, n in zip(sizes, demand)}
    basis: dict[int, list[int]] = {}
    while left:
        values = np.full(length + 1, -np.inf)
        values[0] = 0.0
        here = np.array(list(left))
        values[here] = here / length + 0.002 * (here / length) ** 2
        pattern = max(_best_patterns(values, length))[1]
        need = {s: pattern.count(s) for s in set(pattern)}
        gone = min(need, key=lambda s: left[s] / need[s])
        times = left[gone] / need[gone]
        for s, n in need.items():
            left[s] = max(left[s] - times * n, 0.0)
        del left[gone]
        basis[gone] = pattern
    return [basis[int(s)] for s in sizes]


def solve_patterns(counts: dict[int, int], length: int = LENGTH, gap: float = GAP, rounds: int = 500) -> list[tuple[list[int], int]]:
    """Patterns (lists of lengths) and how often to use each, so that every length is used as often as
    ``counts`` says. The linear program is solved by the revised simplex method, a column at a time, until
    its bound shows that no more than ``gap`` can be gained; any stop leaves a valid packing."""
    sizes = np.array(sorted(counts), dtype=np.int64)
    m = len(sizes)
    if not m:
        return []
    place = {int(s): i for i, s in enumerate(sizes)}
    demand = np.array([counts[int(s)] for s in sizes], dtype=float)
    basis = _first_basis(sizes, demand, length)
    cost = np.array([_cost(sum(p), length) / length for p in basis])
    columns = np.zeros((m, m))
    for k, p in enumerate(basis):
        for s in p:
            columns[place[s], k] += 1
    inverse = np.linalg.inv(columns)
    amount = np.maximum(inverse @ demand, 0.0)
    ideal = sizes / length  # the dual values of a packing without waste
    least = float(ideal @ demand)
    pull = 0.9
    for _ in range(rounds):
        objective = float(cost @ amount)
        if objective <= least * (1 + gap):
            break
        dual = cost @ inverse
        values = np.full(length + 1, -np.inf)
        values[0] = 0.0
        # pricing between the current and the ideal values finds full patterns and steadies the search
        values[sizes] = pull * ideal + (1 - pull) * dual
        found = []
        for _, pattern in _best_patterns(values, length):
            column = np.zeros(m)
            for s in pattern:
                column[place[s]] += 1
            found.append((float(dual @ column) - _cost(sum(pattern), length) / length, pattern, column))
        reduced, pattern, column = max(found, key=lambda x: x[0])
        if reduced <= 1e-9:
            if pull == 0.0:
                break
            pull = 0.0 if pull < 0.1 else pull / 2
            continue
        if pull == 0.0 and objective / (1.0 + reduced) >= objective * (1 - gap):
            break
        direction = inverse @ column
        able = direction > 1e-9
        if not able.any():
            break
        ratio = np.where(able, amount / np.where(able, direction, 1.0), np.inf)
        leave = int(np.argmin(ratio))
        step = ratio[leave]
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
        amount = np.maximum(amount - step * direction, 0.0)
        amount[leave] = step
        basis[leave], cost[leave] = pattern, _cost(sum(pattern), length) / length
    left = {int(s): int(c) for s, c in zip(sizes, demand)}
    chosen: list[tuple[list[int], int]] = []
    for pattern, x in sorted(zip(basis, amount), key=lambda p: -p[1]):
        times = int(x + 1e-6)
        need = {s: pattern.count(s) for s in set(pattern)}
        times = min([times, *[left[s] // n for s, n in need.items()]])
        if times > 0:
            for s, n in need.items():
                left[s] -= times * n
            chosen.append((sorted(pattern, reverse=True), times))
    return chosen + _fill(left, length)


def _fill(left: dict[int, int], length: int) -> list[tuple[list[int], int]]:
    """What rounding left: each sequence starts with the longest piece and is filled up as far as the
    pieces that are left can fill it (a subset sum over what is left, longer pieces first)."""
    left = {s: n for s, n in left.items() if n}
    out: list[tuple[list[int], int]] = []
    while left:
        first = max(left)
        pattern = [first]
        left[first] -= 1
        room = length - first
        while room > 0:
            fits = [s for s, n in left.items() if n and s <= room]
            if not fits:
                break
            open_ = set(fits)
            pair = max(((a + b, a) for a in fits for b in ((room - a,) if room - a in open_ and (room - a != a or left[a] > 1) else ())), default=None)
            s = room if room in open_ else pair[1] if pair else max(fits)
            pattern.append(s)
            left[s] -= 1
            room -= s
        for s in set(pattern):
            if not left.get(s):
                left.pop(s, None)
        out.append((pattern, 1))
    return out


def pack_pieces(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``length`` ids (columns as ``pieces_of``).

    Every piece gets exactly one place; sequences have no gaps before their padding. Equal pieces may
    trade places. No rows give no rows.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    full = counts.pop(length, 0)
    plan = solve_patterns(counts, length) + ([([length], full)] if full else [])
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for s in dict.fromkeys(pattern):
            n = pattern.count(s)
            begin = taken.get(s, 0)
            taken[s] = begin + n * times
            rows.append((s, begin, taken[s], sequence, n, offset))
            offset += s * n
        sequence += times
    places = spark.createDataFrame(rows, "p_length long, p_from long, p_to long, p_sequence long, p_each long, p_offset long")
    numbered = ranked(pieces, ["length"], ["doc_id", "start", "ids_crc32"], "__rank", sum(counts.values()) + full)
    # at most one row per pattern and length, and a basis has no more patterns than there are lengths
    held = numbered.join(F.broadcast(places), (F.col("length") == F.col("p_length")) & (F.col("__rank") >= F.col("p_from")) & (F.col("__rank") < F.col("p_to")))
    at = F.col("__rank") - F.col("p_from")
    return held.select(
        *pieces.columns, (F.col("p_sequence") + F.floor(at / F.col("p_each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + (at % F.col("p_each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, name: str = "pieces") -> DataFrame:
    """One row per piece of each document. A null text is empty and gives its end id alone; repeated rows
    are documents of their own; extra columns are not carried; no documents give no rows."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_pieces(stage(pieces_of(docs, path, length=length), name), length)


def op7_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
