"""Exact quantiles per group that no single task has to hold.

The built-in percentile keeps every distinct value of a group in one task's memory. Here the rows are first
merged into (group, value, count), which the map side pre-aggregates, and the wanted rank is found by radix
selection: a value is read as digits, from its sign, exponent and first bits down to its last ones. A level
counts the next digit among the rows that share the digits found so far, and keeps one digit per rank; the
last one takes the value. Each level is a plain aggregate, and a group's list has at most ``2 ** BITS`` counts
below the first level, whatever the number and the spread of its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 21
_FIRST = 10


def _digits(value: Column) -> list[Column]:
    """Whole numbers that order values as the values themselves do; the first holds sign, exponent and the first
    mantissa bits. Scaling by powers of two and taking off whole parts is exact."""
    size, sign = F.abs(value), F.signum(value)
    finite = (size > 0) & (size < float("inf"))
    exponent = F.floor(F.log2(F.when(finite, size)))
    rest = F.when(finite, size / F.pow(F.lit(2.0), exponent) - 1) * 2.0**_FIRST
    step = F.floor(rest)
    first = sign * ((exponent + 1100) * 2**_FIRST + step)
    far = F.when(F.isnan(value), 2e7).when(size == float("inf"), sign * 1e7).otherwise(0.0)
    second = sign * F.floor((rest - step) * 2.0**BITS)
    return [d.cast("long") for d in (F.coalesce(first, far), F.coalesce(second, F.lit(0.0)))]


def _picked(counts: Column, rank: Column) -> Column:
    """Of an array of (item, n) in order, the item that holds the 1-based rank, and the rows below it."""
    item = F.struct(counts[0]["item"].alias("item"), F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        counts, item,
        lambda s, x: F.when(s["upto"] >= rank, s).otherwise(F.struct(x["item"].alias("item"), s["upto"].alias("below"), (s["upto"] + x["n"]).alias("upto"))),
    )


def _values_at_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Column) -> DataFrame:
    """One row per (keys, slot): the value at each 1-based rank of the array ``ranks``, an
    expression over the group's row count ``total``."""
    digits = dict(zip(["digit_0", "digit_1"], _digits(F.col("value").cast("double"))))
    # The digits are never null, but stated here all levels share one shuffle of these counts: otherwise the
    # joins below would add it to some of them only.
    rows = (
        df.where(F.col(value).isNotNull())
        .select(*keys, F.col(value).alias("value"))
        .withColumns(digits)
        .where(" and ".join(f"{d} is not null" for d in digits))
        .groupBy(*keys, "value", *digits)
        .agg(F.count("*").alias("n"))
    )
    listed = lambda item: F.sort_array(F.collect_list(F.struct(F.col(item).alias("item"), "n")))
    first = rows.groupBy(*keys, "digit_0").agg(F.sum("n").alias("n")).groupBy(*keys).agg(listed("digit_0").alias("counts"), F.sum("n").alias("total"))
    state = first.select(*keys, "counts", "total", F.posexplode(ranks).alias("slot", "rank"))
    fixed = ["slot", "total"]
    for level in range(2):
        picked = state.withColumn("picked", _picked(F.col("counts"), F.col("rank")))
        state = picked.select(
            *[F.col(k).alias(f"{k}_chosen") for k in keys], *fixed, *[f"chosen_{i}" for i in range(level)],
            F.col("picked.item").alias(f"chosen_{level}"), (F.col("rank") - F.col("picked.below")).alias("rank"),
        )
        match = F.lit(True)
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"{k}_chosen"))
        for i in range(level + 1):
            match = match & (F.col(f"digit_{i}") == F.col(f"chosen_{i}"))
        item = f"digit_{level + 1}" if level < 1 else "value"
        inside = rows.join(state, match)
        group = [*keys, *fixed, "rank", *[f"chosen_{i}" for i in range(level + 1)]]
        state = inside.groupBy(*group, item).agg(F.sum("n").alias("n")).groupBy(*group).agg(listed(item).alias("counts"))
    return state.select(*keys, "slot", _picked(F.col("counts"), F.col("rank"))["item"].alias("value"), "total")


def quantile_disc(
    df: DataFrame, keys: Sequence[str], value: str, q: float, alias: str
) -> DataFrame:
    """Smallest value with at least the share ``q`` of the group's rows at or below it."""
    rank = F.greatest(F.ceil(F.col("total") * F.lit(float(q))), F.lit(1))
    found = _values_at_ranks(df, keys, value, F.array(rank))
    return found.select(*keys, F.col("value").alias(alias))


def quantile_cont(
    df: DataFrame, keys: Sequence[str], value: str, q: float, alias: str
) -> DataFrame:
    """Linear interpolation between the two values around the share ``q``."""
    place = (F.col("total") - 1) * F.lit(float(q))
    found = _values_at_ranks(df, keys, value, F.array(F.floor(place) + 1, F.ceil(place) + 1))
    ends = found.groupBy(*keys).agg(
        F.max(F.when(F.col("slot") == 0, F.col("value"))).alias("low"),
        F.max(F.when(F.col("slot") == 1, F.col("value"))).alias("high"),
        F.max("total").alias("total"),
    )
    weight = place - F.floor(place)
    return ends.select(
        *keys, (F.col("low") + (F.col("high") - F.col("low")) * weight).alias(alias)
    )
