"""Previous row and running totals per key, without putting all rows of a key in one task.

A plain window per user sends every row of a hot user to one task. Here a user's time line is cut into
chunks (a day by default). Windows run inside a chunk; what crosses a chunk border is carried over from
a summary that has one row per user and chunk.

A chunk that is measured to hold more than ``ROWS_PER_CHUNK`` rows is cut into hours, an hour that still does
into minutes, and so on down to the microsecond, so a user with most rows of one day is spread as well. Only
rows of one key at one microsecond stay together. Without a crowded chunk this costs one count a call.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.session import staging_root
from cardwarden.sources.staging import stage

MICROS_PER_DAY = 86_400_000_000
# day, hour, minute, second, millisecond, microsecond
WIDTHS = (MICROS_PER_DAY, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)
ROWS_PER_CHUNK = 1_000_000


def micros(time: str) -> Column:
    """Microseconds since the epoch of a timestamp column."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def widths_below(widest: int, unit: int = 1) -> list[int]:
    """Chunk widths from ``widest`` down, where a microsecond is ``unit`` positions."""
    return [widest, *[w * unit for w in WIDTHS if w * unit < widest]]


def _start(position: Column, width: int) -> Column:
    return position - F.pmod(position, F.lit(width))


def crowded_chunks(
    points: DataFrame, keys: Sequence[str], position: Column, widths: Sequence[int], limit: int = ROWS_PER_CHUNK
) -> list[DataFrame]:
    """For each width in turn, the keys and starts of the chunks that hold more than ``limit`` points, until
    there are none. Each table has at most one row for ``limit`` points and is written once, so that its size
    is known when rows are joined to it."""
    spark = points.sparkSession
    found: list[DataFrame] = []
    for width in widths[:-1]:
        within = points.withColumn("chunk", _start(position, width))
        if found:
            outer = widths[len(found) - 1]
            within = _matched(within, keys, _start(position, outer), found[-1], "left_semi")
        counts = within.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        if counts.isEmpty():
            break
        found.append(stage(counts, f"{staging_root(spark)}/crowded/{uuid.uuid4().hex}"))
    return found


def _matched(rows: DataFrame, keys: Sequence[str], start: Column, crowded: DataFrame, how: str) -> DataFrame:
    marks = crowded.select(*[F.col(k).alias(f"crowded_{k}") for k in keys], F.col("chunk").alias("crowded_start"))
    same = start == F.col("crowded_start")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"crowded_{k}"))
    return rows.join(marks, same, how)


def with_chunk(
    rows: DataFrame, keys: Sequence[str], position: Column, widths: Sequence[int], crowded: Sequence[DataFrame]
) -> DataFrame:
    """Adds ``chunk``, the first position of the row's chunk."""
    chunked = rows.withColumn("chunk", _start(position, widths[0]))
    for outer, inner, found in zip(widths, widths[1:], crowded):
        cut = F.when(F.col("crowded_start").isNotNull(), _start(position, inner)).otherwise(F.col("chunk"))
        chunked = _matched(chunked, keys, _start(position, outer), found, "left").withColumn("chunk", cut)
        chunked = chunked.drop("crowded_start", *[f"crowded_{k}" for k in keys])
    return chunked


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    payload: Sequence[str],
    alias: str,
    following: bool = False,
    chunk_micros: int = MICROS_PER_DAY,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Adds ``alias``, a struct of the payload columns of the key's previous (or following) row in
    order of (time, tie); null for the first (last) row.

    The row carried over from the chunk before is added to a chunk as its first row, so that one
    window serves all and nothing has to be joined back.
    """
    direction, edge = (F.desc, F.min_by) if following else (F.asc, F.max_by)
    widths = widths_below(chunk_micros)
    crowded = crowded_chunks(df.select(*keys, time), keys, micros(time), widths, rows_per_chunk)
    rows = with_chunk(df, keys, micros(time), widths, crowded).withColumns(
        {"content": F.struct(*payload), "is_carried": F.lit(False)}
    )
    if list(payload) == [time]:
        # A plain minimum or maximum of a timestamp is hashed; picking a whole row has to sort.
        nearest = F.struct((F.min if following else F.max)(time).alias(time))
    else:
        nearest = edge("content", F.struct(time, tie))
    per_chunk = rows.groupBy(*keys, "chunk").agg(nearest.alias("content"))
    chunks = W.partitionBy(*keys).orderBy(direction("chunk"))
    carried = (
        per_chunk.withColumn("content", F.lag("content").over(chunks))
        .where("content is not null")
        .withColumn("is_carried", F.lit(True))
    )
    inside = W.partitionBy(*keys, "chunk").orderBy(
        F.desc("is_carried"), direction(time), direction(tie)
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(alias, F.lag("content").over(inside))
        .where("not is_carried")
        .drop("chunk", "content", "is_carried")
    )


def with_running_totals(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    measures: Sequence[str],
    widths: Sequence[int],
    crowded: Sequence[DataFrame] = (),
) -> DataFrame:
    """Replaces each measure by its running total over the key up to and including the row's
    position, rows of equal position counting together. ``crowded`` is what ``crowded_chunks`` found for
    the same widths."""
    rows = with_chunk(df, keys, F.col(position), widths, crowded).withColumn("is_carried", F.lit(False))
    per_chunk = rows.groupBy(*keys, "chunk").agg(*[F.sum(m).alias(m) for m in measures])
    earlier = W.partitionBy(*keys).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = per_chunk.withColumns({m: F.sum(m).over(earlier) for m in measures}).withColumn(
        "is_carried", F.lit(True)
    )
    upto = (
        W.partitionBy(*keys, "chunk")
        .orderBy(F.desc("is_carried"), position)
        .rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumns({m: F.sum(m).over(upto) for m in measures})
        .where("not is_carried")
        .drop("chunk", "is_carried")
    )
