"""Mix sources to target weights by weighted fair queueing.

Each source is shuffled and repeated up to ``max_epochs`` times. A document's virtual finish time is the
number of its source's words up to and with it, divided by the source's target. All (document, pass) are
put in order of finish time and cut off where the budget is used up: sources then run out of their targets
at the same time. Cumulative sums come from bins, so neither a large source nor the global order is summed
by one task: the cut is found by counting words in 4096 ranges of finish time, again inside the range that
holds it, until few rows are left to be put in order one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import hex_digits, stage, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
BINS = 4096
FEW = 20_000


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: its size and its target of the total.

    Sources in the order of their code points, null last, take ``weights`` in turn. No target is above
    ``max_epochs`` times its source; what is cut off goes to the others by weight. That is a level x with
    target = min(cap, weight * x), found in order of cap / weight. The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    position = F.row_number().over(ordered) - 1
    per = per.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (position % len(weights) + 1).cast("int")))
    per = per.withColumn("__cap", (F.col("source_size") * max_epochs).cast("double"))
    by_level = Window.partitionBy(F.lit(1)).orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(1))
    before, onward = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    capped = F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    per = per.withColumns({"__level": (F.sum("source_size").over(all_rows) - capped) / F.sum("__w").over(onward), "__at": F.col("__cap") / F.col("__w")})
    level = F.min(F.when(F.col("__level") <= F.col("__at"), F.struct("__at", "__level"))).over(all_rows)["__level"]
    return per.select("source", "source_size", F.least("__cap", F.col("__w") * level).alias("target"))


def _passes(df: DataFrame, max_epochs: int) -> DataFrame:
    passes = F.explode(F.array(*[F.lit(e) for e in range(max_epochs)]))
    out = df.select("*", passes.alias("__epoch"))
    return out.withColumn("__finish", finish_time(F.col("__epoch")))


def finish_time(epoch):
    return (epoch * F.col("source_size") + F.col("__cum")).cast("double") / F.col("target")


def fair_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, name: str = "mix") -> DataFrame:
    """One row per document: key, size, source, source_size, target, copies and taken (= copies * size).

    A null text has size 0; a null source is a source of its own. A document of size 0 costs nothing: it
    is taken with its neighbours. Repeated rows count as often as they occur. Sources without words have
    target 0 and give nothing. Extra columns are not carried; an empty table gives an empty one.
    """
    sized = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"))
    order = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = stage(sized.withColumn("__order", order), f"{name}-sized")
    rows = sized.count()
    digits = hex_digits(rows)
    bin_of = F.substring("__order", 1, digits) if digits else F.lit("")
    sized = sized.withColumn("__bin", bin_of)
    targets = source_targets(sized, weights, max_epochs).withColumnRenamed("source", "__source")
    totals = sized.groupBy("source", "__bin").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("__s"), F.col("__bin").alias("__b"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("source", "__bin").orderBy("__order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = sized.withColumn("__inside", F.sum("size").over(inside))
    summed = summed.join(totals, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bin") == F.col("__b")))
    summed = summed.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    summed = summed.select("doc_id", "source", "size", "__order", "source_size", "target", (F.col("__offset") + F.col("__inside")).alias("__cum"))
    summed = stage(summed, f"{name}-cumulative")
    cut = _cut(summed, max_epochs)
    copies = F.lit(0)
    if cut is not None:
        last = F.struct(F.lit(cut[0]), F.lit(cut[1]), F.lit(cut[2]), F.lit(cut[3]).cast("long"))
        for e in range(max_epochs):
            this = F.struct(finish_time(F.lit(e)), F.lit(e), F.col("__order"), F.col("doc_id"))
            copies = copies + F.when((F.col("target") > 0) & (this <= last), 1).otherwise(0)
    out = summed.select("doc_id", "size", "source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), copies.cast("long").alias("copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def _cut(summed: DataFrame, max_epochs: int) -> tuple | None:
    """(finish time, pass, order, id) of the last (document, pass) within the budget, which is the sum of
    all sizes; none where nothing has words."""
    total = summed.agg(F.sum("size")).first()[0] or 0
    if total == 0:
        return None
    passes = _passes(summed.where(F.col("target") > 0), max_epochs)
    low, high, used = 0.0, 2.0, 0
    inside = passes
    while True:
        step = (high - low) / BINS
        if low + step == low:
            break
        place = F.least(F.floor((F.col("__finish") - F.lit(low)) / F.lit(step)), F.lit(BINS))
        counted = inside.groupBy(place.alias("b")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.min("__finish").alias("a"), F.max("__finish").alias("z")).orderBy("b").collect()
        hit = None
        for r in counted:
            if used + r["words"] > total:
                hit = r
                break
            used += r["words"]
        if hit is None:  # the budget takes all there is
            last = passes.agg(F.max(F.struct("__finish", "__epoch", "__order", "doc_id"))).first()[0]
            return tuple(last)
        inside = passes.where(F.col("__finish").between(hit["a"], hit["z"]))
        if hit["n"] <= FEW or hit["a"] == hit["z"]:
            break
        low, high = hit["a"], max(hit["z"], math.nextafter(hit["a"], math.inf))
    running = Window.partitionBy(F.lit(1)).orderBy("__finish", "__epoch", "__order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    ordered = inside.withColumn("__run", F.sum("size").over(running)).where(F.col("__run") <= F.lit(total - used))
    last = ordered.agg(F.max(F.struct("__finish", "__epoch", "__order", "doc_id"))).first()[0]
    if last is None:  # the range's first document is over the budget: all before the range
        last = passes.where(F.col("__finish") < inside.agg(F.min("__finish")).first()[0]).agg(F.max(F.struct("__finish", "__epoch", "__order", "doc_id"))).first()[0]
    return tuple(last) if last is not None else None


def op8_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = fair_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 3.0::DOUBLE AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM per),
levels AS (
  SELECT *, cap / w AS brim,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
chosen AS (SELECT level FROM levels WHERE level <= brim ORDER BY brim, level LIMIT 1),
targets AS (SELECT source, source_size, least(cap, w * chosen.level) AS target FROM levels, chosen),
cumulated AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, (epoch * source_size + cum)::DOUBLE / target AS finish
  FROM cumulated, (VALUES (0), (1), (2)) e(epoch) WHERE target > 0),
running AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, epoch, ord, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run,
         (SELECT sum(size) FROM sized) AS total
  FROM passes),
took AS (SELECT doc_id, sum(CASE WHEN run <= total THEN size ELSE 0 END)::BIGINT AS taken FROM running GROUP BY doc_id)
SELECT c.doc_id, c.size, c.source_size, c.target, coalesce(k.taken, 0) AS taken
FROM cumulated c LEFT JOIN took k ON c.doc_id IS NOT DISTINCT FROM k.doc_id
"""
