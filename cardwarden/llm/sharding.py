"""Shards of near equal bytes by histogram sort.

Rows are put in order of (hash of the text, id), so equal texts lie side by side. The boundaries between
shards are found without moving a row: every round counts the exact bytes and rows in 4096 ranges of the
key, then probes again only inside the ranges that hold a boundary, until each boundary is within the
tolerance or no key lies between its probes. Only then are the rows exchanged, once.

The same search also cuts each shard into parts, so that no task has to number a whole shard: a row's slot
is the number of rows counted before its part plus its place there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import stage, table

SHARDS = 16
TOLERANCE = 0.001
BITS = 12
ROWS_PER_PART = 200_000


def _cell(key: Column, shift: int) -> Column:
    return F.shiftright(key, shift) if shift else key


def _search(keyed: DataFrame, targets: list[float], tolerance: float) -> list[tuple[int | None, int | None, int, int]]:
    """For each target the first key (hash, id) that is not below the boundary, and bytes and rows below it.

    A hash is probed from its upper bits down; where one hash holds more than the tolerance (many copies of
    one text) the boundary goes between ids, probed in the same way. Each round is one aggregation with at
    most 4096 rows per open range.
    """
    state = [{"target": t, "bytes": 0, "rows": 0, "hash": None, "prefix": None, "done": None} for t in targets]
    for column in ("__h", "__id"):
        above = 64
        while above > 0:
            shift = max(above - BITS, 0)
            open_ = [s for s in state if s["done"] is None]
            if not open_:
                break
            where = None
            if column == "__id":
                for h in {s["hash"] for s in open_}:
                    here = F.col("__h") == F.lit(h).cast("long")
                    prefixes = {s["prefix"] for s in open_ if s["hash"] == h}
                    if prefixes != {None}:
                        here = here & _cell(F.col("__id"), above).isin([p for p in prefixes if p is not None])
                    where = here if where is None else where | here
            elif open_[0]["prefix"] is not None:
                where = _cell(F.col("__h"), above).isin(list({s["prefix"] for s in open_}))
            near = keyed if where is None else keyed.where(where)
            outer = F.col("__h") if column == "__id" else F.lit(0).cast("long")
            counted = near.groupBy(outer.alias("o"), _cell(F.col(column), shift).alias("c")).agg(F.sum("__size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
            cells: dict = {}
            for r in counted:
                cells.setdefault(r["o"], []).append((r["c"], r["b"], r["n"]))
            for rows in cells.values():
                rows.sort()
            for s in open_:
                mine = cells.get(s["hash"] if column == "__id" else 0, [])
                if s["prefix"] is not None and above < 64:
                    width = above - shift
                    mine = [x for x in mine if x[0] >> width == s["prefix"]]
                for c, b, n in mine:
                    if s["bytes"] + b < s["target"]:
                        s["bytes"], s["rows"] = s["bytes"] + b, s["rows"] + n
                        continue
                    first = c << shift
                    key = (s["hash"], first) if column == "__id" else (first, None)
                    short, over = s["target"] - s["bytes"], s["bytes"] + b - s["target"]
                    if short <= tolerance or (n == 1 and short <= over):
                        s["done"] = (*key, s["bytes"], s["rows"])
                    elif over <= tolerance or n == 1 or (column == "__id" and shift == 0 and over <= short):
                        after = (c + 1) << shift
                        end = after >= 1 << 63
                        key = (s["hash"] + 1, None) if column == "__id" and end else (s["hash"], after) if column == "__id" else (None if end else after, None)
                        s["done"] = (*key, s["bytes"] + b, s["rows"] + n)
                    elif column == "__id" and shift == 0:
                        s["done"] = (*key, s["bytes"], s["rows"])
                    elif column == "__h" and shift == 0:
                        s["hash"], s["prefix"] = c, None
                    else:
                        s["prefix"] = c
                    break
            above = shift
    return [s["done"] for s in state]


def histogram_shards(keyed: DataFrame, hash_column: str, key: str, size: str, shards: int = SHARDS, tolerance: float = TOLERANCE, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to every row.

    Shards differ from equal bytes by at most ``tolerance`` of a shard or half of a row. Rows of one hash
    stay together unless that would break the tolerance. Null keys come first among equal hashes; rows
    that are equal in hash, key and size may trade slots, and where more of them than the tolerance share
    one key, they stay together. An empty table gives an empty one.
    """
    plain = keyed.withColumns({
        "__h": F.coalesce(F.col(hash_column), F.lit(0)).cast("long"),
        "__id": F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")),
        "__size": F.col(size),
    })
    total = plain.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count(F.lit(1))).first()
    bytes_, rows = int(total[0]), total[1]
    parts = max(1, -(-rows // (shards * rows_per_part)))
    found = _search(plain.select("__h", "__id", "__size"), [bytes_ * i / (shards * parts) for i in range(1, shards * parts)], tolerance * bytes_ / shards) if rows else []
    # a part's number is the count of boundaries at or below the row's key; boundaries are sorted
    bounds = [(i + 1, f) for i, f in enumerate(found) if f is not None and f[0] is not None]
    part: Column = F.lit(0)
    if bounds:
        listed = F.array(*[F.struct(F.lit(h).cast("long").alias("h"), F.lit(-(1 << 63) if i is None else i).cast("long").alias("i")) for _, (h, i, _, _) in bounds])
        here = F.struct(F.col("__h").alias("h"), F.col("__id").alias("i"))
        part = F.size(F.filter(listed, lambda b: b <= here))
    starts = [0] + [f[3] for _, f in bounds]
    placed = plain.withColumn("__part", part.cast("int"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy("__h", "__id", "__size")) - 1
    shard_start = [starts[min(s * parts, len(starts) - 1)] for s in range(shards)]
    shard = F.least(F.floor(F.col("__part") / parts), F.lit(shards - 1)).cast("int")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(int(v)) for v in values]), at.cast("int") + 1).cast("long")
    placed = placed.withColumns({"__place": place, "__shard": shard})
    slot = F.col("__place") + pick(starts, F.col("__part")) - pick(shard_start, F.col("__shard"))
    kept = [c for c in keyed.columns if c not in ("shard", "slot")]
    return placed.select(*kept, F.col("__shard").alias("shard"), slot.cast("long").alias("slot"))


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot. A null text is empty: no bytes, size 1."""
    raw = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("text_hash"),
    )
    return histogram_shards(stage(keyed, "shard-keys"), "text_hash", "doc_id", "size", shards)


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
