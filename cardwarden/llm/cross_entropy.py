"""Cross-entropy difference: how much better a target model than a background model predicts a document.

Both are bigram models that fall back on words, of the same order and smoothing over one vocabulary, all words of
the corpus. Nearly every bigram of a corpus is distinct, so no bigram is a row of a table: documents are dealt into
blocks of bounded size, and a block sends each of its distinct bigrams and words once, with its counts, to the bucket
that adds them up over all blocks. A bucket answers with the totals in the order in which the block asked,
so keys travel once and a frequent bigram is one entry a block.

Keys are 63 bits of a hash and meet only inside the bucket that an independent hash names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, stage, table

WORD = r"[^\x20\x09-\x0D]+"
BIGRAM_WEIGHT = 0.7
BLOCK_TOKENS = 1 << 19
BUCKET_TOKENS = 1 << 20
COUNTS = ["target", "target_last", "background", "background_last"]
_ASKED = "bucket long, block long, n long, keys binary, " + ", ".join(f"{c} binary" for c in COUNTS)
_TOTALS = "bucket long, block long, n long, " + ", ".join([*[f"{c} binary" for c in COUNTS], "words long", *[f"all_{c} long" for c in COUNTS]])


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that near numbers have unrelated hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray) -> bytes:
    """Compressed, bytes of the same rank side by side: the high ones of small numbers are all zero."""
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, kind: type, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).reshape(n)


def _blocker(limit: int) -> Callable:
    """Rows (row, key, hashes of words) as blocks of about ``limit`` tokens, each named by its first row."""

    def block(first: int, keys: list, words: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        unique, ids = np.unique(np.concatenate(words), return_inverse=True)
        columns = [
            pa.array([first], pa.int64()), pa.array([keys], pa.list_(kind)), pa.array([[len(w) for w in words]], pa.list_(pa.int64())),
            pa.array([unique.tobytes()], pa.binary()), pa.array([pack(ids.astype(np.uint32))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "keys", "sizes", "words", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, keys, words, held, kind = 0, [], [], 0, None
        for b in batches:
            kind, lists = b.schema.field(1).type, b.column(2)
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for i, (row, key) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if not keys:
                    first = row
                keys.append(key)
                words.append(np.array(values[offsets[i] : offsets[i + 1]], np.int64))
                held += len(words[-1]) + 1
                if held >= limit:
                    yield block(first, keys, words, kind)
                    keys, words, held = [], [], 0
        if keys:
            yield block(first, keys, words, kind)

    return run


def _events(sizes: np.ndarray, words: bytes, ids: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a block by (bucket, key), their buckets, the numbers among them of each token's bigram and then of
    each token's word, and the document of each token. The lowest bit of a key tells bigrams from words."""
    unique, ids = np.frombuffer(words, np.uint64), unpack(ids, np.uint32, int(sizes.sum()))
    word, owner = unique[ids], np.repeat(np.arange(len(sizes)), sizes)
    before = np.zeros_like(word)
    before[1:] = np.where(owner[1:] == owner[:-1], word[:-1], np.uint64(0))
    factor, salt = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
    pairs, at, number = np.unique(_mix(_mix(before + np.uint64(1)) * factor + word) | np.uint64(1), return_index=True, return_inverse=True)
    keys = np.concatenate([pairs, unique & ~np.uint64(1)])
    deal = np.concatenate([_mix(_mix(before[at] + salt) + word[at] * salt), _mix(unique * salt + np.uint64(1))])
    bucket = (deal % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return keys[order], bucket[order], np.concatenate([place[number], place[len(pairs) + ids]]), owner


def _last(owner: np.ndarray) -> np.ndarray:
    """Whether a token is the last one of its document."""
    return np.append(owner[1:] != owner[:-1], True)[: len(owner)]


def _asker(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ASKED.split(", ")]
        for b in batches:
            for block in range(b.num_rows):
                r = {c: b.column(c)[block].as_py() for c in b.schema.names}
                keys, bucket, event, owner = _events(np.array(r["sizes"], np.int64), r["words"], r["ids"], buckets)
                if not len(keys):
                    continue
                marked = np.zeros(len(r["sizes"]), bool)
                marked[np.array(r["places"] or [], np.int64)] = True
                marked, last, counts = marked[owner], _last(owner), []
                for side in (marked, ~marked):
                    counts.append(np.bincount(event[np.tile(side, 2)], minlength=len(keys)))
                    counts.append(np.bincount(event[len(owner) :][side & last], minlength=len(keys)))
                cuts, out = np.flatnonzero(np.diff(bucket)) + 1, []
                for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                    steps = np.diff(keys[lo:hi], prepend=np.uint64(0))
                    out.append((int(bucket[lo]), r["block"], int(hi - lo), pack(steps), *[pack(c[lo:hi].astype(np.int64)) for c in counts]))
                kinds = [pa.int64()] * 3 + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return run


def _totals(asked: pa.Table) -> pa.Table:
    """Counts of one bucket over all blocks, dealt back to them; what is counted once a bucket stands in its first row."""
    n = asked["n"].to_numpy()
    column = lambda c, kind: [unpack(x.as_py(), kind, k) for x, k in zip(asked[c], n)]
    unique, inverse = np.unique(np.concatenate([np.cumsum(k, dtype=np.uint64) for k in column("keys", np.uint64)]), return_inverse=True)
    sums = [np.bincount(inverse, np.concatenate(column(c, np.int64)), len(unique)).astype(np.int64) for c in COUNTS]
    words, ends = (unique & np.uint64(1)) == 0, np.cumsum(n)
    once = [pa.array([int(x), *[0] * (len(n) - 1)], pa.int64()) for x in (words.sum(), *[s[words].sum() for s in sums])]
    dealt = [pa.array([pack(s[inverse[end - k : end]]) for k, end in zip(n, ends)], pa.binary()) for s in sums]
    columns = [asked[c].combine_chunks() for c in ("bucket", "block", "n")]
    return pa.Table.from_arrays([*columns, *dealt, *once], names=[c.split()[0] for c in _TOTALS.split(", ")])


def _loss(pair: np.ndarray, before: np.ndarray, word: np.ndarray, total: int, words: int) -> np.ndarray:
    """Negative logarithm of the mixture of bigram and word probability."""
    after = np.divide(pair, before, out=np.zeros(len(pair)), where=before > 0)
    return -np.log(BIGRAM_WEIGHT * after + (1 - BIGRAM_WEIGHT) * (word + 1.0) / float(total + words))


def _scorer(buckets: int, words: int, *all_: int) -> Callable:
    def run(block: pa.Table, totals: pa.Table) -> pa.Table:
        out = []
        totals = totals.sort_by("bucket")
        for b in block.to_pylist():
            sizes = np.array(b["sizes"], np.int64)
            _, _, event, owner = _events(sizes, b["words"], b["ids"], buckets)
            starts, sums = np.append(True, _last(owner)[:-1])[: len(owner)], []
            for i in (0, 2) if len(owner) else ():
                count, last = (np.concatenate([unpack(x.as_py(), np.int64, k.as_py()) for x, k in zip(totals[c], totals["n"])]) for c in COUNTS[i : i + 2])
                pair, word = np.split(event, 2)
                before = np.roll((count - last)[word], 1)  # a word comes before another wherever it is not the last
                before[starts] = all_[i + 1]
                sums.append(np.bincount(owner, _loss(count[pair], before, count[word], all_[i], words), len(sizes)))
            out.append((b["keys"], sizes, *(sums or [np.zeros(len(sizes))] * 2)))
        kind = block.schema.field("keys").type.value_type
        keys = pa.array([k for o in out for k in o[0]], kind)
        rest = [pa.array(np.concatenate([o[i] for o in out])) for i in (1, 2, 3)] if out else [pa.array([], t) for t in (pa.int64(), pa.float64(), pa.float64())]
        return pa.Table.from_arrays([keys, *rest], names=["key", "tokens", "st", "sb"])

    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, key: str = "doc_id", text: str = "text", name: str = "lm") -> DataFrame:
    """One row per row of ``docs``: key, ``tokens``, mean ``target_loss`` and ``background_loss`` per token, and
    ``difference`` (target less background; the lower, the more like the target).

    The target are rows whose key is in ``target_ids``; all others are background, null keys among them. A null
    or empty text has no tokens and zero losses. Repeated rows count and are scored each. Where the target is
    empty its model is the uniform one. Extra columns are not carried; no rows give no rows.
    """
    ids = target_ids.select(F.col(key).alias("__key")).where("__key IS NOT NULL").distinct()
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.transform(words, lambda w: F.xxhash64(w)).alias("w"))
    kind = texts.schema["key"].dataType.simpleString()
    blocks = stage(arrow_map(texts, _blocker(BLOCK_TOKENS), f"block long, keys array<{kind}>, sizes array<long>, words binary, ids binary"), f"{name}-blocks")
    placed = blocks.select("block", F.posexplode("keys").alias("place", "key")).join(ids, F.col("key") == F.col("__key"))
    marks = stage(placed.groupBy("block").agg(F.collect_list("place").alias("places")), f"{name}-marks")  # a written table: its size decides how blocks meet it
    tokens = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = tokens // BUCKET_TOKENS + 1
    asked = arrow_map(blocks.drop("keys").join(marks, "block", "left"), _asker(buckets), _ASKED)
    totals = stage(asked.groupBy("bucket").applyInArrow(_totals, _TOTALS), f"{name}-totals")
    sizes = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ["words", *[f"all_{c}" for c in COUNTS]]]).first()
    answers = totals.select("bucket", "block", "n", *COUNTS)
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scorer(buckets, *sizes), f"key {kind}, tokens long, st double, sb double")
    mean = lambda c: F.when(F.col("tokens") > 0, F.col(c) / F.col("tokens")).otherwise(0.0)
    return scored.select(F.col("key").alias(key), "tokens", mean("st").alias("target_loss"), mean("sb").alias("background_loss"), (mean("st") - mean("sb")).alias("difference"))


def op9_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    out = cross_entropy_difference(table(spark, sf_dir, "documents"), good)
    return out.select("doc_id", "tokens", *[F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "difference")])


ORACLE_SQL = r"""
WITH good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
texts AS (
  SELECT row_number() OVER () AS r, d.doc_id, (g.doc_id IS NOT NULL)::BIGINT AS t,
         list_prepend('', regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+')) AS w
  FROM documents d LEFT JOIN good g ON d.doc_id = g.doc_id),
placed AS (SELECT r, t, w, unnest(range(1, len(w))) AS i FROM texts),
pairs AS (SELECT r, t, w[i] AS prev, w[i + 1] AS word FROM placed),
bigrams AS (SELECT prev, word, sum(t)::DOUBLE AS ct, sum(1 - t)::DOUBLE AS cb FROM pairs GROUP BY ALL),
unigrams AS (SELECT word, sum(ct) AS wt, sum(cb) AS wb FROM bigrams GROUP BY word),
befores AS (SELECT prev, sum(ct) AS pt, sum(cb) AS pb FROM bigrams GROUP BY prev),
sizes AS (SELECT count(*) AS n, sum(wt) AS nt, sum(wb) AS nb FROM unigrams),
losses AS (
  SELECT b.prev, b.word,
         -ln(0.7::DOUBLE * CASE WHEN pt > 0 THEN ct / pt ELSE 0 END + 0.3::DOUBLE * (wt + 1) / (nt + n)) AS lt,
         -ln(0.7::DOUBLE * CASE WHEN pb > 0 THEN cb / pb ELSE 0 END + 0.3::DOUBLE * (wb + 1) / (nb + n)) AS lb
  FROM bigrams b JOIN unigrams u ON b.word = u.word JOIN befores p ON b.prev = p.prev, sizes),
sums AS (SELECT r, avg(lt) AS st, avg(lb) AS sb FROM pairs JOIN losses USING (prev, word) GROUP BY r)
SELECT doc_id, (len(w) - 1)::BIGINT AS tokens, round(coalesce(st, 0), 6) AS target_loss, round(coalesce(sb, 0), 6) AS background_loss,
       round(coalesce(st, 0) - coalesce(sb, 0), 6) AS difference
FROM texts LEFT JOIN sums ON texts.r = sums.r
"""
