"""The trie of all conversations' beginnings, from vertical bitmaps.

Conversations are numbered by id and cut into shards of ``SHARD``; their turns are cut every ``SEGMENT``
positions, so what one task holds is bounded whatever one conversation's length is. A shard indexes
(position, turn) to the set of its conversations that have the turn there, one bit a conversation. A node is
a set of conversations; depth first, the set is cut with the posting of its first member's next turn, which
gives a child, and what remains gives the other children. Counts are popcounts.

A node is named by its depth and by two 60-bit sums of hashes of (position, turn) along its path. Shards agree
on these names without seeing each other, and the name at a segment's start is a sum over the segments before.
Nodes of all shards are then merged by name. Of a merged node the smallest member is its owner; what a
subtree saves is the turns of its members that others own, and its leaves are the members that own one. So both
are sums over members, taken in a second walk with the owners known, and no step goes level by level.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import arrow_map, numbered, ship, stage, table
from cardwarden.llm.merkle import CRC32

SHARD = 2048
SEGMENT = 256
CHUNK = 512  # ids in one row of an end list
MASK = (1 << 60) - 1
KEY = ["depth", "a", "b"]
EMPTY = hashlib.sha256(b"").hexdigest()


class Shard:
    """Bitmaps of one shard and segment. ``rows``: lists conv_id, position, a, b, words, seed_a, seed_b, length and, in
    the second walk, owned, has_leaf, later."""

    def __init__(self, rows: dict[str, list]):
        self.ids = sorted(set(rows["conv_id"]))
        bit = {c: 1 << i for i, c in enumerate(self.ids)}
        self.postings: dict[tuple, int] = defaultdict(int)
        self.turn: dict[int, dict[int, tuple]] = defaultdict(dict)
        self.words: dict[tuple, int] = {}
        self.present: dict[int, int] = defaultdict(int)
        self.seeds: dict[tuple, int] = defaultdict(int)
        self.ending: dict[int, int] = defaultdict(int)
        self.owning: dict[int, int] = defaultdict(int)
        self.leaves = 0
        self.later: dict[int, int] = {}
        second = "owned" in rows
        for k, c in enumerate(rows["conv_id"]):
            at, one = rows["position"][k], bit[c]
            key = (at, rows["a"][k], rows["b"][k])
            self.postings[key] |= one
            self.turn[at][one] = key
            self.words[key] = rows["words"][k]
            self.present[at] |= one
            self.seeds[rows["seed_a"][k], rows["seed_b"][k]] |= one
            self.ending[rows["length"][k]] |= one
            if second:
                self.owning[rows["owned"][k]] |= one
                self.leaves |= one if rows["has_leaf"][k] else 0
                if rows["later"][k]:
                    self.later[one] = rows["later"][k]
        self.first, self.last = min(self.turn, default=0), max(self.turn, default=0)

    def nodes(self) -> Iterator[tuple[int, tuple[int, int], tuple[int, int], int, tuple]]:
        """Depth, path, parent's path, members and turn of every node, parents before children, depth first."""
        open_ = [(self.first - 1, path, members) for path, members in self.seeds.items()]
        while open_:
            depth, path, members = open_.pop()
            rest = members & self.present.get(depth + 1, 0)
            while rest:
                key = self.turn[depth + 1][rest & -rest]
                child = rest & self.postings[key]
                rest ^= child
                below = ((path[0] + key[1]) & MASK, (path[1] + key[2]) & MASK)
                yield depth + 1, below, path, child, key
                open_.append((depth + 1, below, child))

    def lowest(self, members: int) -> int:
        return self.ids[(members & -members).bit_length() - 1]

    def listed(self, members: int) -> Iterator[int]:
        while members:
            one = members & -members
            yield self.ids[one.bit_length() - 1]
            members ^= one


def _walk_counts(_: tuple, rows: pa.Table) -> pa.Table:
    shard = Shard(rows.to_pydict())
    found = [
        (depth, *path, *above, members.bit_count(), (members & shard.ending.get(depth, 0)).bit_count(), shard.lowest(members), shard.words[key])
        for depth, path, above, members, key in shard.nodes()
    ]
    names = ["depth", "a", "b", "up_a", "up_b", "n_convs", "n_ends", "conv_id", "words"]
    return pa.table({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate(names)})


def _walk_sums(_: tuple, rows: pa.Table) -> pa.Table:
    shard = Shard(rows.to_pydict())
    owners, owned = {}, 0
    for depth in range(0, shard.last + 1) if shard.owning else ():
        owned |= shard.owning.get(depth, 0)
        owners[depth] = owned
    order, saved, place = [], [], {}
    for depth, path, above, members, key in shard.nodes():
        # of a node's members at most one owns it; the others' turns are saved
        sum_ = shard.words[key] * (members & ~owners[depth]).bit_count()
        if depth == shard.last and shard.later:
            sum_ += sum(n for one, n in shard.later.items() if members & one)
        place[depth, *path] = len(order)
        order.append((depth, path, above, members))
        saved.append(sum_)
    for k in range(len(order) - 1, -1, -1):
        depth, path, above, _ = order[k]
        parent = place.get((depth - 1, *above))
        if parent is not None:
            saved[parent] += saved[k]
    out: list[tuple] = []
    for (depth, path, _, members), sum_ in zip(order, saved):
        out.append((depth, *path, (members & shard.leaves).bit_count(), sum_, None, None))
        ending = list(shard.listed(members & shard.ending.get(depth, 0)))
        for i in range(0, len(ending), CHUNK):
            out.append((depth, *path, 0, 0, ending[i], ",".join(map(str, ending[i : i + CHUNK]))))
    kinds = {"depth": pa.int64(), "a": pa.int64(), "b": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "end": pa.int64(), "ids": pa.string()}
    return pa.table({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate(kinds.items())})


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's joined lists, from rows sorted by node and first id; only a hash state is held."""
    now, state = None, None

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array([d[0][i] for d in done], pa.int64()) for i in range(3)], pa.array([d[1] for d in done], pa.string())], names=[*KEY, "ends_sha256"]
        )

    for batch in batches:
        done = []
        for depth, a, b, ids in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in [*KEY, "ids"]]):
            if (depth, a, b) != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = (depth, a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield rows(done)
    if now is not None:
        yield rows([(now, state.hexdigest())])


def _part(digest: Column, start: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("long")


def _running(turns: DataFrame) -> DataFrame:
    """One row per conversation and segment: the path's name before it and the words up to its end."""
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    sums = turns.groupBy("conv_id", "segment").agg(wide("a").alias("sum_a"), wide("b").alias("sum_b"), F.sum("words").alias("sum_words"))
    order = Window.partitionBy("conv_id").orderBy("segment")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seed = lambda c: (F.coalesce(F.sum(c).over(before), F.lit(0)) % F.lit(MASK + 1)).cast("long")
    return sums.select("conv_id", "segment", seed("sum_a").alias("seed_a"), seed("sum_b").alias("seed_b"), F.sum("sum_words").over(order).alias("words_here"))


def _walked(turns: DataFrame, segments: DataFrame, walk: Callable, schema: str) -> DataFrame:
    ship(turns.sparkSession)
    at = segments.withColumnsRenamed({"conv_id": "s_conv", "segment": "s_segment"})
    held = turns.join(at, (F.col("conv_id") == F.col("s_conv")) & (F.col("segment") == F.col("s_segment")))
    return held.drop("s_conv", "s_segment").groupBy("shard", "segment").applyInArrow(walk, schema)


def prefix_trie(turns: DataFrame, convs: DataFrame, name: str = "trie") -> DataFrame:
    """One row per node of the trie of all conversations.

    ``turns``: conv_id, position (1, 2, ... without gaps), turn (string that names role and text), words.
    ``convs``: distinct conv_id, not null, and length; conversations without turns belong to the root alone.
    No conversations give no rows.
    """
    digest = F.sha2(F.concat(F.col("position").cast("string"), F.lit(":"), F.col("turn")), 256)
    rows = turns.withColumn("digest", digest).select("conv_id", "position", _part(F.col("digest"), 1).alias("a"), _part(F.col("digest"), 16).alias("b"), F.col("words").cast("long").alias("words"))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("position"), zero.alias("a"), zero.alias("b"), zero.alias("words"))
    segment = F.floor(F.col("position") / SEGMENT).cast("long")
    rows = stage(rows.unionByName(roots).withColumn("segment", segment), f"{name}-rows")
    ranked = numbered(convs.select("conv_id", F.col("length").cast("long").alias("length")), [], ["conv_id"], f"{name}-convs")
    ranked = ranked.select(F.col("conv_id").alias("r_conv"), "length", F.floor(F.col("__at") / SHARD).cast("long").alias("shard"))
    segments = _running(rows).join(ranked, F.col("conv_id") == F.col("r_conv")).drop("r_conv")
    segments = stage(segments, f"{name}-segments")

    schema = "depth long, a long, b long, up_a long, up_b long, n_convs long, n_ends long, conv_id long, words long"
    first = _walked(rows, segments.drop("words_here"), _walk_counts, schema)
    nodes = first.groupBy(*KEY).agg(
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_ends").alias("n_ends"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
    )
    nodes = stage(nodes, f"{name}-nodes")

    owners = nodes.groupBy(F.col("conv_id").alias("o_conv")).agg(
        F.min("depth").alias("o_depth"), F.max(F.col("n_convs") == F.col("n_ends")).alias("o_leaf"), F.sum("words").alias("o_words"),
    )
    totals = segments.groupBy(F.col("conv_id").alias("t_conv")).agg(F.max("words_here").alias("total"))
    known = totals.join(owners, F.col("t_conv") == F.col("o_conv"), "left")
    known = known.select("t_conv", (F.col("total") - F.coalesce("o_words", F.lit(0))).alias("shared"), "o_depth", "o_leaf")
    again = segments.join(known, F.col("conv_id") == F.col("t_conv")).select(
        "conv_id", "segment", "seed_a", "seed_b", "length", "shard",
        F.coalesce("o_depth", F.col("length") + 1).alias("owned"), F.coalesce("o_leaf", F.lit(False)).alias("has_leaf"),
        F.greatest(F.col("shared") - F.col("words_here"), F.lit(0)).cast("long").alias("later"),
    )
    sums = stage(_walked(rows, again, _walk_sums, "depth long, a long, b long, n_leaves long, saved_tokens long, end long, ids string"), f"{name}-sums")
    ends = sums.where("ids is not null").select(*KEY, "end", "ids").repartition(*KEY).sortWithinPartitions(*KEY, "end")
    ends = arrow_map(ends.select(*KEY, "ids"), _hash_ends, "depth long, a long, b long, ends_sha256 string")

    children = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"), F.lit(1).cast("long").alias("n_children"))
    parts = nodes.select(*KEY, "up_a", "up_b", "conv_id", "n_convs").unionByName(children, allowMissingColumns=True)
    parts = parts.unionByName(sums.where("ids is null").select(*KEY, "n_leaves", "saved_tokens"), allowMissingColumns=True)
    parts = parts.unionByName(ends, allowMissingColumns=True)
    whole = parts.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("up_a", "up_b", "conv_id", "n_convs", "ends_sha256")],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
    )
    whole = stage(whole, f"{name}-whole")
    above = nodes.select(F.col("depth").alias("p_depth"), F.col("a").alias("p_a"), F.col("b").alias("p_b"), F.col("conv_id").alias("parent_conv_id"))
    parent = (F.col("depth") - 1 == F.col("p_depth")) & (F.col("up_a") == F.col("p_a")) & (F.col("up_b") == F.col("p_b"))
    return whole.join(above, parent, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def rebuilt(conversations: DataFrame, name: str = "rebuilt") -> tuple[DataFrame, DataFrame]:
    """Turns and conversations for ``prefix_trie``, rebuilt by the rule of the query.

    Turns are ordered by turn, null first, and where that ties by a hash of role and text. Null roles and texts
    are empty. Rows without a conv_id belong to no conversation. Other columns don't count.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turn = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    own = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("nth"), turn.alias("turn"), words.alias("words"))
    own = numbered(stage(own, f"{name}-own"), ["conv_id"], ["nth", "turn"], f"{name}-ordered")
    own = stage(own.select("conv_id", (F.col("__at") - F.col("__first") + 1).alias("position"), "turn", "words"), f"{name}-turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    bases = sizes.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = sizes.withColumns({"h": h, "of": F.col("conv_id") - F.col("conv_id") % 20}).join(bases, F.col("of") == F.col("base"), "left")
    taken = F.least(F.col("h"), F.coalesce("base_size", F.lit(0)))
    convs = stage(convs.select("conv_id", "of", "h", taken.alias("taken"), (taken + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length")), f"{name}-convs")
    heads = own.where("position <= 3 and conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    first = convs.where("taken > 0").join(heads, (F.col("of") == F.col("base")) & (F.col("position") <= F.col("taken")))
    tails = own.where(F.col("position") > h).join(convs.select(F.col("conv_id").alias("c"), "h", "taken"), F.col("conv_id") == F.col("c"))
    turns = first.select("conv_id", "position", "turn", "words").unionByName(
        tails.select("conv_id", (F.col("taken") + F.col("position") - F.col("h")).alias("position"), "turn", "words")
    )
    return turns, convs.select("conv_id", "length")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = rebuilt(table(spark, sf_dir, "conversations"))
    return prefix_trie(turns, convs)


ORACLE_SQL = rf"""
WITH own AS (
  SELECT conv_id AS c, turn, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT c, t, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) AS p FROM own),
convs AS (SELECT c, c - c % 20 AS b, {CRC32.format('c')} % 4 AS h FROM (SELECT DISTINCT c FROM turns)),
heads AS (SELECT k.c, t.p, t.t, t.w FROM convs k JOIN turns t ON t.c = k.b AND t.p <= k.h),
taken AS (SELECT c, count(*) AS n FROM heads GROUP BY c),
made AS (
  SELECT * FROM heads
  UNION ALL
  SELECT t.c, coalesce(n, 0) + t.p - k.h, t.t, t.w FROM turns t JOIN convs k ON k.c = t.c LEFT JOIN taken ON taken.c = t.c WHERE t.p > k.h),
lists AS (SELECT k.c, coalesce(list(t ORDER BY p) FILTER (t IS NOT NULL), []) AS ts, coalesce(list(w ORDER BY p) FILTER (t IS NOT NULL), []) AS ws FROM convs k LEFT JOIN made m ON m.c = k.c GROUP BY k.c),
prefixes AS (SELECT c, d, array_to_string(ts[:d], ',') AS path, array_to_string(ts[:d - 1], ',') AS up, coalesce(ws[d], 0) AS w, len(ts) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM lists)),
nodes AS (SELECT d, path, max(up) AS up, min(c) AS conv_id, count(*) AS n, max(w) AS w, count(*) FILTER (ends) = count(*) AS leaf,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM prefixes GROUP BY d, path),
sums AS (SELECT a.d, a.path, sum((u.n - 1) * u.w)::BIGINT AS saved, count(*) FILTER (u.leaf) AS leaves
  FROM nodes u JOIN prefixes a ON a.c = u.conv_id AND a.d <= u.d GROUP BY a.d, a.path),
children AS (SELECT d - 1 AS d, up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(k.n, 0) AS n_children,
  s.leaves AS n_leaves, s.saved AS saved_tokens, v.ends_sha256
FROM nodes v JOIN sums s ON s.d = v.d AND s.path = v.path LEFT JOIN children k ON k.d = v.d AND k.up = v.path
  LEFT JOIN nodes p ON p.d = v.d - 1 AND p.path = v.up
"""
