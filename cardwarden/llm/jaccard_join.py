"""Similarity self-join on word shingles, MinHash candidates pruned by Bayesian posterior, rest verified exactly.

Rows with the same set of shingles are one representative. Representatives that share a band of their MinHash
signature meet in that band's bucket; buckets with the same members are one, and a bucket joins the larger one
that holds a quarter of its rows, so a group of near copies is compared once and not once for each band. A bucket
is cut into blocks and each pair of blocks is a tile of bounded size, so no task holds a whole bucket and no pair
of rows is ever a row of a table. Inside a tile, signatures are compared ``STEP`` values at a time: a pair is dropped as soon as
the posterior probability (uniform prior) that its similarity reaches the threshold is below ``TOLERANCE``.
What survives is verified on the exact shingle sets. Only rows that meet another one have their signature and
shingles made a second time, from their text; no table holds those of all rows. A tile gives each row its number of links and the smallest
row of its part of the graph; parts are merged into classes by alternating star contraction.

A pair at the threshold misses every band with probability (1 - 0.8 ** 5) ** 24, below 0.0001.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, stage, table

WORDS = 5
THRESHOLD = 0.8
BANDS = 24
PER_BAND = 5
HASHES = BANDS * PER_BAND
STEP = 20
TOLERANCE = 1e-4
BLOCK_ROWS = 1024
OVERLAP = 4
BLOCK_BYTES = 24 << 20
BATCH_ROWS = 256
COLUMNS = 1024
FILTER_BITS = 1 << 26
_SETS = "mid long, key long, text_hash long, text_check long, n long, set_hash long, set_check long, bands array<long>"
_WIDE = "mid long, weight long, buckets array<long>, blocks array<int>, signature binary, shingles binary"
_FOUND = "mid long, low long, links long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that near numbers have unrelated hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of every ``WORDS`` words in a row; a shorter text is one shingle, no words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    w = words.view(np.uint64)
    size = min(WORDS, len(w))
    total = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        total = _mix(total * np.uint64(31) + w[i : len(w) - size + 1 + i])
    return np.unique(total)


_seeds = _mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_factors, _offsets = _seeds[:HASHES] | np.uint64(1), _seeds[HASHES:]


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        values = ((part[None, :] * _factors[:, None] + _offsets[:, None]) >> np.uint64(32)).astype(np.uint32)
        np.minimum(low, values.min(axis=1), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sig.reshape(BANDS, PER_BAND).T.astype(np.uint64):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return (keys | np.uint64(1)).view(np.int64)  # never 0


def _shingles(words: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each list of word hashes."""
    values, offsets = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    for i in range(len(words)):
        yield shingle_set(np.ascontiguousarray(values[offsets[i] : offsets[i + 1]], dtype=np.int64))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        out = []
        for s in _shingles(b.column(4)):
            check = np.bitwise_xor.reduce(_mix(s + np.uint64(77))) if len(s) else np.uint64(0)
            out.append((len(s), int(s.sum().astype(np.uint64).view(np.int64)), int(check.view(np.int64)), band_keys(signature(s))))
        n, total, check, bands = zip(*out)
        made = [pa.array(n, pa.int64()), pa.array(total, pa.int64()), pa.array(check, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], *made], names=["mid", "key", "text_hash", "text_check", "n", "set_hash", "set_check", "bands"])


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _slices(batches):
        sets = list(_shingles(b.column(4)))
        made = [pa.array([signature(s).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], *made], names=["mid", "weight", "buckets", "blocks", "signature", "shingles"])


@lru_cache(maxsize=8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For each number n of compared values the fewest matches m that keep a pair: with a uniform prior,
    P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = [0]
    for n in range(1, HASHES + 1):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def pruned(sa: np.ndarray, sb: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) of rows of two signature tables, of those that ``may`` marks, that no prefix of the
    comparison rules out. While many pairs are open whole columns are compared, then pair by pair."""
    need, matched = least_matches(), np.zeros(may.shape, np.uint8)
    ta, tb, at = np.ascontiguousarray(sa.T), np.ascontiguousarray(sb.T), 0
    while at < HASHES and np.count_nonzero(may) * 8 > may.size:
        for h in range(at, at + STEP):
            matched += (ta[h][:, None] == tb[h][None, :]).view(np.uint8)
        at += STEP
        may = may & (matched >= need[at])
    a, b = np.nonzero(may)
    matched = matched[a, b].astype(np.int32)
    for at in range(at, HASHES, STEP):
        matched += (sa[a, at : at + STEP] == sb[b, at : at + STEP]).sum(axis=1, dtype=np.int32)
        alive = matched >= need[at + STEP]
        a, b, matched = a[alive], b[alive], matched[alive]
    return a, b


def met_before(buckets: list[list[int]], key: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a ``left`` and a ``right`` row also share a bucket with a smaller number than ``key``."""
    met = np.zeros((len(left), len(right)), bool)
    row = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    number = np.concatenate([np.asarray(b, np.int64) for b in buckets])
    row, number = row[number < key], number[number < key]
    if not len(number):
        return met
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    place_left, place_right = np.full(len(buckets), -1), np.full(len(buckets), -1)
    place_left[left], place_right[right] = np.arange(len(left)), np.arange(len(right))
    for members in np.split(row, np.flatnonzero(np.diff(number)) + 1):
        if len(members) > 1:
            a, b = place_left[members], place_right[members]
            met[np.ix_(a[a >= 0], b[b >= 0])] = True
    return met


def similar(common, na, nb):
    return common * 5 >= 4 * (na + nb - common)


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of ``left`` rows with ``right`` rows, through incidence matrices of the
    shingles that more than one row has."""
    every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    held = often[column]
    row, column = row[held], number[column[held]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, int(often.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[row[lo:hi], column[lo:hi] - at] = 1
        out += m[left] @ m[right].T
    return out


def tile_links(rows: list[tuple], key: int, same: bool) -> list[tuple[int, int, int]]:
    """(mid, smallest mid of its part, links) of the rows of a tile that have a link there.

    A row is (mid, weight, buckets, signature, shingles, is left). A pair belongs to the smallest bucket its rows
    share.
    """
    side = np.array([r[5] for r in rows])
    left = np.arange(len(rows)) if same else np.flatnonzero(side)
    right = left if same else np.flatnonzero(~side)
    if not len(left) or not len(right):
        return []
    sig = np.stack([np.frombuffer(r[3], np.uint32) for r in rows])
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    sizes = np.array([len(s) for s in sets], np.int64)
    met = met_before([r[2] for r in rows], key, left, right)
    found_a, found_b = [], []
    for at in range(0, len(left), 128):
        part = left[at : at + 128]
        may = ~met[at : at + 128]
        if same:
            may &= part[:, None] < right[None, :]
        a, b = pruned(sig[part], sig[right], may)
        found_a.append(part[a])
        found_b.append(right[b])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if not len(a):
        return []
    if len(a) > 4 * len(rows):
        where = np.full(len(rows), -1)
        where[right] = np.arange(len(right))
        place = np.full(len(rows), -1)
        place[left] = np.arange(len(left))
        common = common_counts(sets, left, right)[place[a], where[b]].astype(np.int64)
    else:
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    good = similar(common, sizes[a], sizes[b])
    a, b = a[good], b[good]
    weight = np.array([r[1] for r in rows], np.int64)
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, a, weight[b])
    np.add.at(links, b, weight[a])
    low = np.array([r[0] for r in rows], np.int64)
    while len(a):  # smallest neighbour until nothing changes
        before = low.copy()
        np.minimum.at(low, a, before[b])
        np.minimum.at(low, b, before[a])
        if (low == before).all():
            break
    return [(rows[i][0], int(low[i]), int(links[i])) for i in np.flatnonzero(links)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(at, BATCH_ROWS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples, few of them at a time: a batch of wide rows and a copy of all of it would be held together."""
    for b in _slices(batches):
        yield from zip(*[c.to_pylist() for c in b.columns])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, rows, out = None, [], []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["mid", "low", "links"])

    for key, i, j, block, *row in _rows(batches):
        if (key, i, j) != at:
            if len(rows) > 1:
                out.extend(tile_links(rows, at[0], at[1] == at[2]))
            at, rows = (key, i, j), []
            if len(out) > 50_000:
                yield batch()
                out = []
        rows.append((*row, block == i))
    if len(rows) > 1:
        out.extend(tile_links(rows, at[0], at[1] == at[2]))
    if out:
        yield batch()


def classes(edges: DataFrame, name: str) -> DataFrame:
    """(mid, class) for edges (mid, low): the smallest node of each connected part, by alternating large and
    small stars; every round is a written table."""
    now = stage(edges.where("mid != low").distinct(), f"{name}-edges")
    seen = None
    while True:
        both = now.select(F.col("mid").alias("u"), F.col("low").alias("v")).unionAll(now.select(F.col("low").alias("u"), F.col("mid").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")).withColumnRenamed("u", "w")
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("mid"), F.col("m").alias("low")).distinct()
        large = stage(large.where("mid != low"), f"{name}-large")
        down = large.groupBy("mid").agg(F.min("low").alias("m")).withColumnRenamed("mid", "w")
        small = large.join(down, F.col("mid") == F.col("w"))
        small = small.select(F.col("low").alias("mid"), F.col("m").alias("low")).unionAll(small.select("mid", F.col("m").alias("low")))
        now = stage(small.where("mid != low").distinct(), f"{name}-small")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("mid", "low"))).first()
        if state == seen:
            return now.select("mid", F.col("low").alias("class"))
        seen = state


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the tables that are written inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def small_batches(spark: SparkSession):
    """Arrow batches of few rows: a row holds all words or shingles of a text, and a batch is held by Spark and by Python."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)})


def early_filter(spark: SparkSession, items: int):
    """Spark's runtime Bloom filters at every size of the filtered table and of the ``items`` keys that it may meet: most
    rows have no candidate, and their texts then drop out before they are sorted and shuffled."""
    bloom, items = "spark.sql.optimizer.runtime.bloomFilter", max(items, 1000)
    return settings(spark, {
        f"{bloom}.enabled": "true", f"{bloom}.applicationSideScanSizeThreshold": "0", f"{bloom}.creationSideThreshold": "1t",
        f"{bloom}.expectedNumItems": str(items), f"{bloom}.maxNumItems": str(items), f"{bloom}.numBits": str(min(8 * items, FILTER_BITS)),
    })


def word_hashes(content: Column) -> Column:
    return F.transform(F.filter(F.split(F.lower(content), r"(?U)\W+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def bucket_homes(reps: DataFrame, name: str) -> DataFrame:
    """(mid, size, bucket): the buckets of more than one row that each representative belongs to, each once.

    Buckets with the same members are one. Each row names the largest of its buckets; a bucket joins the one
    that most of its rows name if these are at least one in ``OVERLAP``. A joined bucket holds all rows of its
    parts, so no pair that met is lost.
    """
    places = reps.select("mid", "size", F.explode("bands").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("bucket")
    met = stage(places.join(stage(shared, f"{name}-shared"), "bucket"), f"{name}-met")  # most buckets have one row and need no more than a count
    buckets = met.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("mid")).alias("x"), F.bit_xor(F.xxhash64("mid", F.lit(1))).alias("y"),
    )
    kept = buckets.groupBy("rows", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "rows")
    held = stage(met.join(kept, "bucket"), f"{name}-places")
    largest = F.max(F.struct("rows", "bucket")).over(Window.partitionBy("mid"))  # at most one row per band
    named = held.select("bucket", "rows", largest["bucket"].alias("top")).groupBy("bucket", "top").agg(F.count(F.lit(1)).alias("votes"), F.max("rows").alias("rows"))
    best = named.groupBy("bucket", "rows").agg(F.max(F.struct("votes", "top")).alias("best"))
    joined = best.where(F.col("best.votes") * OVERLAP >= F.col("rows")).select(F.col("bucket").alias("mid"), F.col("best.top").alias("low"))
    merged = classes(joined, f"{name}-buckets").withColumnRenamed("mid", "bucket")
    homes = held.join(merged, "bucket", "left").select("mid", "size", F.coalesce("class", "bucket").alias("bucket")).distinct()
    return stage(homes, f"{name}-homes")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "jaccard", row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its key, ``class_id`` (smallest key of its class), ``links`` (other rows with
    similarity of at least 0.8, copies included) and ``kept`` (one row of each class).

    Words are runs of letters, digits and underscores, in lower case. Texts without words, null ones among
    them, have no links and are classes of their own; so do they stay. Repeated rows are copies. Of rows with
    one key, one stays; a null key counts after all others. Extra columns are not carried; no rows give no rows.
    ``row`` names a column of distinct numbers that is to be ``row_id``; without it rows are numbered here.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = [F.xxhash64(content).alias("text_hash"), F.xxhash64(F.lit(1), content).alias("text_check")]
    mid = F.col(row).cast("long") if row else F.monotonically_increasing_id()
    raw = docs.select(mid.alias("mid"), F.col(key).cast("long").alias("key"), *texts, word_hashes(content).alias("words"))
    with small_batches(docs.sparkSession):
        sets = stage(arrow_map(raw, _sets, _SETS), f"{name}-sets")
    same = ["n", "set_hash", "set_check"]
    groups = sets.where("n > 0").groupBy(*same).agg(F.min("mid").alias("rep"), F.count(F.lit(1)).alias("weight"))
    groups = stage(groups, f"{name}-groups")
    reps = sets.select("mid", "text_hash", "text_check", "bands", F.col("n").alias("size")).join(groups.select(F.col("rep").alias("mid"), "weight"), "mid")
    reps = stage(reps, f"{name}-reps")
    homes = bucket_homes(reps, name)
    stats = homes.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("size") * 8 + 700).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    mine = homes.select("mid", "bucket").join(stats.select("bucket", blocks.alias("blocks")), "bucket")
    mine = mine.groupBy("mid").agg(F.collect_list(F.struct("bucket", "blocks")).alias("mine"))  # at most one per band
    wanted = reps.select(F.col("text_hash").alias("w_hash"), F.col("text_check").alias("w_check"), "mid", "weight").join(mine, "mid")
    wanted = stage(wanted, f"{name}-wanted")  # a written table: its size decides how texts meet it
    # equal texts are one row before they are dealt; the filtered side lets Spark build a Bloom filter of it
    payload = docs.select(*texts, content.alias("content")).groupBy("text_hash", "text_check").agg(F.min("content").alias("content"))
    payload = payload.join(wanted.where("weight > 0"), (F.col("text_hash") == F.col("w_hash")) & (F.col("text_check") == F.col("w_check")))
    payload = payload.select("mid", "weight", F.col("mine.bucket").alias("buckets"), F.col("mine.blocks").alias("blocks"), word_hashes(F.col("content")).alias("words"))
    met = F.explode(F.arrays_zip(F.col("buckets").alias("bucket"), F.col("blocks").alias("blocks"))).alias("m")
    sent = arrow_map(payload, _wide, _WIDE).select("mid", "weight", F.col("buckets").alias("bands"), "signature", "shingles", met)
    block = F.pmod(F.xxhash64("mid", F.lit(2)), F.col("m.blocks")).cast("int")
    sent = sent.select("*", block.alias("block")).select("*", F.explode(F.sequence(F.lit(0), F.col("m.blocks") - 1)).alias("other"))
    tiles = sent.select(
        F.col("m.bucket").alias("bucket"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
        "mid", "weight", "bands", "signature", "shingles",
    )
    tiles = tiles.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    with small_batches(docs.sparkSession), early_filter(docs.sparkSession, wanted.count()):
        found = stage(arrow_map(tiles, _tiles, _FOUND), f"{name}-found")
    linked = found.groupBy("mid").agg(F.sum("links").alias("others")).withColumnRenamed("mid", "rep")
    merged = classes(found.select("mid", "low"), name).withColumnRenamed("mid", "rep")
    group = groups.join(linked, "rep", "left").join(merged, "rep", "left")
    group = group.select(*[F.col(c).alias(f"g_{c}") for c in same], "weight", "others", F.coalesce("class", "rep").alias("class"))
    match = (F.col("n") == F.col("g_n")) & (F.col("set_hash") == F.col("g_set_hash")) & (F.col("set_check") == F.col("g_set_check"))
    all_ = sets.select("mid", "key", *same).join(group, match, "left")
    all_ = all_.select("mid", "key", F.coalesce("class", "mid").alias("class"), (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    all_ = stage(all_, f"{name}-rows")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mid"))
    tops = all_.groupBy("class").agg(first.alias("top"))
    return all_.join(tops, "class").select(
        F.col("key").alias(key), F.col("top.key").alias("class_id"), "links", (F.col("mid") == F.col("top.mid")).alias("kept"), F.col("mid").alias("row_id"),
    )


def op2_bayes_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "links", "kept")
