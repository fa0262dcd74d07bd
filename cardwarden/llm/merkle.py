"""A dataset manifest: one Merkle tree per source, one over their roots, and proofs by a recursive climb.

Leaves are numbered in the order of (source, id), so every node of every tree covers a run of consecutive
leaves and can be named by its level and its first leaf. Each level is one aggregate over the level below
and is written as rows that name their parent. A recursive query then starts at all leaves, and each of its
steps joins the rows to their parents, appends the siblings and folds the hash that the leaf has now.

Near the root a node has many leaves below it. Its row is therefore stored once for each block of leaves
(``BLOCK``) that it covers, and the climb joins on (node, block): no join key has more rows than a block.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import new_path, numbered, stage, table

FAN = 3
BLOCK = 4096
ROWS_PER_FILE = 20_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = 64  # levels of the tree over the sources are numbered from here


def record(fields: dict[str, Column]) -> Column:
    """The fields one after another: ``-`` for null, else byte count, colon and value."""
    texts = [c.cast("string") for c in fields.values()]
    return F.concat(*[F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in texts])


def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _joined(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), "")


def _node(level: int, number: Column) -> Column:
    return F.lit(level << 48) + number


@dataclass
class Manifest:
    """``leaves``: at, doc_id, node, up, place, hash, altered. ``nodes``: node, up, place, first, last, children, hash,
    subroot. ``root``: hex, None without leaves. ``levels``: built levels."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None
    levels: int


def _level(below: DataFrame, level: int, base: int, top: bool) -> DataFrame:
    """Parents of the rows of unfinished trees; ``base`` is the level at which the trees' leaves are."""
    runs = below.where("n > 1").withColumn("run", F.floor(F.col("i") / FAN).cast("long"))
    made = runs.groupBy("tree", "run").agg(
        F.array_sort(F.collect_list(F.struct("i", "hash")))["hash"].alias("children"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("n").alias("below"),
    )
    number = F.col("i") if top else F.col("tree") + F.col("i") * FAN ** (level - base)
    above = F.floor(F.col("i") / FAN).cast("long")
    parent = _node(level + 1, above if top else F.col("tree") + above * FAN ** (level + 1 - base))
    named = made.select("tree", F.col("run").alias("i"), F.ceil(F.col("below") / FAN).cast("long").alias("n"), "first", "last", "children", _digest(_joined(F.col("children"))).alias("hash"))
    return named.select(
        "*", _node(level, number).alias("node"), F.when(F.col("n") > 1, parent).alias("up"),
        (F.col("i") % FAN).cast("int").alias("place"),
    )


def _grow(leaves: DataFrame, base: int, top: bool, name: str) -> list[DataFrame]:
    """All levels above ``leaves`` (tree, i, n, first, last, hash), each from the written level below. High levels have
    few rows and are written in few files."""
    most, rows, trees = leaves.agg(F.max("n"), F.count(F.lit(1)), F.count(F.when(F.col("i") == 0, 1))).first()
    levels, below, level = [], leaves, base
    while (most or 0) > 1:
        level, most, rows = level + 1, -(-most // FAN), rows // FAN + trees
        below = stage(_level(below, level, base, top).coalesce(-(-rows // ROWS_PER_FILE)), f"{name}-{level}")
        levels.append(below)
    return levels


def build_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source", altered: Column | None = None, name: str = "merkle") -> Manifest:
    """Leaves and nodes of the trees over ``docs``; ``altered`` is a hash that a leaf has now, null where it is unchanged.

    Null keys and groups come first; equal rows are leaves of their own, equal leaves may trade places. Columns that
    are not in ``fields`` don't count. Without rows there are no leaves, no nodes and no root.
    """
    own = _digest(record({f: F.col(f) for f in fields}))
    changed = F.lit(None).cast("binary") if altered is None else altered
    hashed = stage(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(group).cast("string").alias("source"), own.alias("hash"), changed.alias("altered")), f"{name}-leaves")
    leaves = numbered(hashed, ["source"], ["doc_id", "hash"], f"{name}-ordered")
    leaves = leaves.select(
        F.col("__at").alias("at"), "doc_id", "hash", F.coalesce("altered", "hash").alias("altered"), F.col("__first").alias("tree"),
        (F.col("__at") - F.col("__first")).alias("i"), F.col("__size").alias("n"), F.col("__at").alias("first"), F.col("__at").alias("last"),
    )
    up = _node(1, F.col("tree") + F.floor(F.col("i") / FAN).cast("long") * FAN)
    leaves = stage(leaves.select("*", _node(0, F.col("at")).alias("node"), F.when(F.col("n") > 1, up).alias("up"), (F.col("i") % FAN).cast("int").alias("place")), f"{name}-placed")
    levels = _grow(leaves, 0, False, f"{name}-level")
    linked = ["node", "up", "place", "first", "last", "children", "hash"]
    ends = leaves.where("n = 1").select("node", "hash", "first", "last")
    for at in levels:
        ends = ends.unionByName(at.where("n = 1").select("node", "hash", "first", "last"))
    sources = numbered(ends, [], ["first"], f"{name}-sources")
    top_up = F.when(F.col("__size") > 1, _node(_TOP + 1, F.floor(F.col("__at") / FAN).cast("long")))
    sources = stage(sources.select(
        F.lit(0).alias("tree"), F.col("__at").alias("i"), F.col("__size").alias("n"), "first", "last", "hash", "node",
        top_up.alias("top_up"), (F.col("__at") % FAN).cast("int").alias("top_place"),
    ), f"{name}-subroots")
    top = _grow(sources.drop("node", "top_up", "top_place"), _TOP, True, f"{name}-top")
    final = (top[-1] if top else sources).agg(F.max(F.hex("hash"))).first()[0]
    links = sources.select(F.col("node").alias("end"), "top_up", "top_place")

    def tied(rows: DataFrame) -> DataFrame:
        """Subroots, one row a source, get their parent in the tree over the sources."""
        found = rows.where("n = 1").join(links, F.col("node") == F.col("end"))
        patched = found.withColumns({"up": F.col("top_up"), "place": F.col("top_place")}).select(*rows.columns)
        return rows.where("n > 1").unionByName(patched)

    leaf_columns = ["at", "doc_id", "node", "up", "place", "hash", "altered"]
    leaves = tied(leaves).select(*leaf_columns)
    nodes = docs.sparkSession.createDataFrame([], "node long, up long, place int, first long, last long, children array<binary>, hash binary, subroot boolean")
    for at in levels:
        nodes = nodes.unionByName(tied(at).select(*linked, (F.col("n") == 1).alias("subroot")))
    for at in top:
        nodes = nodes.unionByName(at.select(*linked, F.lit(False).alias("subroot")))
    return Manifest(leaves, nodes, final and final.lower(), len(levels) + len(top))


def _twin(spark: SparkSession, **settings: str) -> SparkSession:
    """A session beside ``spark`` with its settings and some others, so that no other query sees those."""
    twin = spark.newSession()
    for row in spark.sql("SET").collect():
        if spark.conf.isModifiable(row["key"]):
            twin.conf.set(row["key"], row["value"])
    for k, v in settings.items():
        twin.conf.set(k, v)
    return twin


# A step is height * 4 + place among the siblings, siblings are their hashes one after another: the rows of all steps
# are shuffled, so they are kept short.
_CLIMB = """
WITH RECURSIVE climb(at, step, up, folded, own, siblings) AS (
  SELECT at, CAST(coalesce(place, 0) AS bigint), up, altered, hash, CAST(NULL AS binary) FROM {leaves}
  UNION ALL
  SELECT c.at, (c.step DIV 4 + 1) * 4 + coalesce(s.place, 0), s.up,
         unhex(sha2(array_join(transform(s.children, (x, i) -> lower(hex(if(i = c.step % 4, c.folded, x)))), ''), 256)),
         s.hash, aggregate(s.children, named_struct('i', 0, 'all', CAST('' AS binary)),
           (sum, x) -> named_struct('i', sum.i + 1, 'all', if(sum.i = c.step % 4, sum.all, concat(sum.all, x))), sum -> sum.all)
  FROM climb c JOIN {steps} s ON c.up = s.node AND c.at DIV {block} = s.block
)
SELECT at, step DIV 4 AS height, if(up IS NULL, folded, NULL) AS folded, own, siblings FROM climb
"""


def climb(manifest: Manifest, name: str = "merkle") -> DataFrame:
    """One row a leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The recursive query gives one row for each leaf and height, with the siblings met there; one aggregate puts a
    leaf's rows together. Its rows, levels and join keys grow with the leaves and the logarithm of their number.
    """
    spark = manifest.leaves.sparkSession
    covered = F.sequence((F.col("first") / BLOCK).cast("long"), (F.col("last") / BLOCK).cast("long"))
    steps = manifest.nodes.select("node", "up", "place", "children", F.when(F.col("subroot"), F.col("hash")).alias("hash"), F.explode(covered).alias("block"))
    paths = {n: new_path(spark, f"{name}-{n}") for n in ("starts", "steps", "climb")}
    manifest.leaves.write.parquet(paths["starts"])
    steps.write.parquet(paths["steps"])
    # the limits guard against endless recursion; here the number of levels is known
    twin = _twin(spark, **{"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": str(manifest.levels + 2)})
    views = {"leaves": f"leaves_{uuid.uuid4().hex}", "steps": f"steps_{uuid.uuid4().hex}"}
    starts = twin.read.parquet(paths["starts"])
    starts.createOrReplaceTempView(views["leaves"])
    twin.read.parquet(paths["steps"]).createOrReplaceTempView(views["steps"])
    met = twin.sql(_CLIMB.format(block=BLOCK, **views))
    # a leaf's id, kept out of the climb, comes in beside its rows; dealing first spares a list for each row
    ids = starts.select("at", F.lit(-1).alias("height"), "doc_id", *[F.lit(None).cast("binary").alias(c) for c in ("folded", "own", "siblings")])
    rows = met.withColumn("doc_id", F.lit(None).cast("long")).unionByName(ids).repartition("at")
    proof = F.transform(F.array_sort(F.collect_list(F.struct("height", "siblings"))), lambda x: F.lower(F.hex(F.coalesce(x["siblings"], F.lit(b"")))))
    folded = rows.groupBy("at").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(F.col("height") == 0, F.col("own"))).alias("leaf"),
        F.max(F.when(F.col("height") > 0, F.col("own"))).alias("subroot"),
        F.max("folded").alias("folded"),
        F.sha2(F.array_join(proof, ""), 256).alias("proof_sha256"),
    )
    hexed = lambda c: F.lower(F.hex(c))
    folded.select(
        "doc_id", hexed("leaf").alias("leaf"), hexed(F.coalesce("subroot", "leaf")).alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"), "proof_sha256", hexed("folded").alias("folded_root"),
        (hexed("folded") == F.lit(manifest.root).cast("string")).alias("verified"),
    ).write.parquet(paths["climb"])
    return spark.read.parquet(paths["climb"])


def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document, by a checksum of its id, is altered: line breaks are deleted. A null id is not altered."""
    docs = table(spark, sf_dir, "documents")
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    fields = {f: F.col(f) for f in FIELDS} | {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return climb(build_manifest(docs, altered=F.when(hit, _digest(record(fields)))))


# crc32 of a decimal number, bit by bit
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""

_SQL_RECORD = "concat({})".format(", ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode({f}::VARCHAR))::VARCHAR || ':' || {f}::VARCHAR END" for f in FIELDS))

ORACLE_SQL = f"""
WITH RECURSIVE rec AS (
  SELECT *, {CRC32.format('doc_id')} % 2 = 0 AS hit FROM documents),
hashed AS (
  SELECT doc_id, source, sha256({_SQL_RECORD}) AS h, CASE WHEN hit THEN sha256({_SQL_RECORD.replace('text', "replace(text, chr(10), '')").replace("replace(text, chr(10), '') IS NULL", "text IS NULL")}) END AS altered FROM rec),
leaves AS (
  SELECT doc_id, h, coalesce(altered, h) AS altered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM hashed),
low(l, s, i, n, h) AS (
  SELECT 0, s, i, n, h FROM leaves
  UNION ALL
  SELECT l + 1, s, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT * FROM low WHERE n > 1) GROUP BY l, s, n, i // 3),
subroots AS (SELECT l, s, h, count(*) OVER () AS n FROM low WHERE n = 1),
high(l, i, n, h) AS (
  SELECT 0, s, n, h FROM subroots
  UNION ALL
  SELECT l + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT * FROM high WHERE n > 1) GROUP BY l, n, i // 3),
root AS (SELECT h FROM high WHERE n = 1),
runs AS (SELECT 0 AS top, s AS tree, l, i // 3 AS run, list(h ORDER BY i) AS hs FROM low WHERE n > 1 GROUP BY s, l, i // 3
  UNION ALL SELECT 1, 0, l, i // 3, list(h ORDER BY i) FROM high WHERE n > 1 GROUP BY l, i // 3),
tall AS (SELECT max(l) AS tops FROM high),
steps AS (
  SELECT a.doc_id, a.s, a.i AS leaf_i, r.top, r.l, (a.i // pow(3, r.l)::BIGINT) % 3 AS place, r.hs
  FROM leaves a JOIN runs r ON r.top = 0 AND r.tree = a.s AND r.run = a.i // pow(3, r.l + 1)::BIGINT
  UNION ALL
  SELECT a.doc_id, a.s, a.i, r.top, r.l, (a.s // pow(3, r.l)::BIGINT) % 3, r.hs
  FROM leaves a JOIN runs r ON r.top = 1 AND r.run = a.s // pow(3, r.l + 1)::BIGINT),
path AS (
  SELECT s, leaf_i, list({{'place': place, 'hs': hs}} ORDER BY top, l) AS path FROM steps GROUP BY s, leaf_i),
folded AS (
  SELECT a.doc_id, a.s, a.h, coalesce(p.path, []) AS path, list_reduce(list_prepend(a.altered, list_transform(coalesce(p.path, []), lambda x: x.place::VARCHAR || array_to_string(x.hs, ''))),
    lambda f, x: sha256(substr(x, 2, 64 * substr(x, 1, 1)::INT) || f || substr(x, 66 + 64 * substr(x, 1, 1)::INT))) AS folded_root
  FROM leaves a LEFT JOIN path p ON p.s = a.s AND p.leaf_i = a.i)
SELECT f.doc_id, f.h AS leaf, b.h AS subroot, root.h AS root,
  sha256(array_to_string(list_transform(f.path, lambda x: array_to_string(x.hs[:x.place::INT], '') || array_to_string(x.hs[x.place::INT + 2:], '')), '')) AS proof_sha256,
  f.folded_root, f.folded_root = root.h AS verified
FROM folded f JOIN subroots b ON b.s = f.s, root
"""
