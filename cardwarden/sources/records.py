"""Records that may hold their own separator inside quotes, put together in parallel.

Spark cuts a text file into splits and a split into pieces (lines, or what stands between commas). Whether a
piece begins inside quotes depends on all pieces before it. Only pieces with an odd number of quotes change
that, so each split is summed up as what it does to the state; a running total over the splits of a file, one
row a split, gives every split its state at the start, and windows inside a split do the rest. A record that
crosses splits is joined from its fragments. A split that starts outside quotes and has no odd piece passes
through without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwarden.session import staging_root
from cardwarden.sources.staging import stage

SPLIT = ["file", "block"]
# A quoted cell that covers whole splits of more characters than this is an unclosed quote.
LONGEST = 64 << 20


def land_pieces(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write pieces with their file, split and place in it. Splits depend on the cores there are when a scan is
    planned, so what is compared across passes has to come from one written table."""
    place = df.select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    return stage(place, f"{staging_root(spark)}/pieces/{name}")


def _carried(splits: DataFrame) -> DataFrame:
    """Adds ``start`` (1: the split begins inside quotes) and ``owner``, the split in which a record that is open
    at the start began."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.coalesce(F.col("flips"), F.lit(0))
    summed = splits.withColumn("summed", F.sum(flips).over(upto))
    # a piece that closes for certain makes everything before it irrelevant
    since = F.last(F.when(F.col("closes"), F.col("summed") - flips), ignorenulls=True).over(before)
    summed = summed.withColumn("start", ((F.coalesce(F.lag("summed").over(Window.partitionBy("file").orderBy("block")), F.lit(0)) - F.coalesce(since, F.lit(0))) % 2).cast("int"))
    inside = (F.col("start") == 1) & F.col("flips").isNull()
    owned = summed.withColumn("owner", F.last(F.when(~inside, F.col("block")), ignorenulls=True).over(before))
    run = F.sum(F.when(inside, F.col("chars"))).over(Window.partitionBy("file", "owner"))
    return owned.select(
        *SPLIT, "start", "owner", F.col("flips").isNull().alias("even"),
        F.when(run > LONGEST, F.raise_error(F.concat(F.lit("unclosed quote in "), F.col("file")))).cast("string").alias("fault"),
    )


def whole_records(pieces: DataFrame, separator: str) -> DataFrame:
    """Records (file, block, place, value) from pieces with ``flips`` (1 where the piece changes the state) and
    ``closes`` (true where the piece ends outside quotes, whatever the state was)."""
    order = Window.partitionBy(*SPLIT).orderBy("place")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    odd = pieces.where("flips = 1 or closes").select(*SPLIT, "place", "flips", "closes")
    odd = odd.withColumn("summed", F.sum("flips").over(upto))
    last = odd.groupBy(*SPLIT).agg(
        F.max("closes").alias("closes"), F.sum("flips").alias("total"),
        F.max_by(F.col("summed"), F.when(F.col("closes"), F.col("place"))).alias("closed_at"),
    )
    odd_splits = last.select(*SPLIT, "closes", (F.col("total") - F.when(F.col("closes"), F.col("closed_at")).otherwise(0)).alias("flips"))
    sizes = pieces.groupBy(*SPLIT).agg(F.sum(F.length("value") + 1).alias("chars"))
    splits = _carried(sizes.join(odd_splits, SPLIT, "left").withColumn("closes", F.coalesce("closes", F.lit(False))))
    # one row a split
    tagged = pieces.join(F.broadcast(splits), SPLIT).where("fault is null")
    calm = (F.col("start") == 0) & F.col("even")
    rough = tagged.where(~calm)
    rough = rough.withColumn("summed", F.sum("flips").over(upto))
    since = F.last(F.when(F.col("closes"), F.col("summed")), ignorenulls=True)
    state = lambda total, at: (total + F.coalesce(-at, F.col("start"))) % 2
    rough = rough.withColumns({"inside": state(F.col("summed") - F.col("flips"), since.over(before)), "after": state(F.col("summed"), since.over(upto))})
    rough = rough.withColumn("record", F.sum((F.col("inside") == 0).cast("int")).over(upto))
    grouped = rough.groupBy(*SPLIT, "record").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("place", "value")))["value"], separator).alias("value"),
        F.max_by("after", "place").alias("open"), F.min("place").alias("place"), F.first("owner").alias("owner"),
    )
    cut = (F.col("record") == 0) | (F.col("open") == 1)
    fragments = grouped.where(cut).withColumn("owner", F.when(F.col("record") == 0, F.col("owner")).otherwise(F.col("block")))
    glued = fragments.groupBy("file", "owner").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "value")))["value"], separator).alias("value"), F.min_by("place", "block").alias("place"),
    )
    kept = [*SPLIT, "place", "value"]
    return tagged.where(calm).select(*kept).unionByName(grouped.where(~cut).select(*kept)).unionByName(glued.select("file", F.col("owner").alias("block"), "place", "value"))
