"""Operators that cut hot groups, against brute force on small data with one dominant key."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.neighbours import with_neighbour
from cardwarden.operators.quantiles import quantile_cont, quantile_disc
from cardwarden.plans.behaviour import impossible_travel, novelty_flags, velocity_features

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("n", [1, 2, 3, 99, 100, 101, 350])
def test_quantiles(spark, n):
    rng = random.Random(n)
    hot = [round(rng.choice([rng.uniform(0, 9), rng.uniform(0, 5000)]), 2) for _ in range(n)]
    groups = {"hot": hot, "one": [7.25], None: [3.0, 3.0, 8.0]}
    rows = [(k, v) for k, values in groups.items() for v in values] + [("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for q in (0.0, 0.5, 0.99, 1.0):
        disc = {r.k: r.x for r in quantile_disc(df, ["k"], "v", q, "x").collect()}
        cont = {r.k: r.x for r in quantile_cont(df, ["k"], "v", q, "x").collect()}
        for k, values in groups.items():
            ordered = sorted(values)
            assert disc[k] == ordered[max(math.ceil(len(ordered) * q), 1) - 1]
            place = (len(ordered) - 1) * q
            low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
            assert cont[k] == pytest.approx(low + (high - low) * (place - math.floor(place)))


def test_quantiles_of_any_doubles(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * math.exp(rng.uniform(-700, 700)) for _ in range(900)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0**-1030, math.inf, -math.inf, 1.7e308] + [2.0**k for k in range(-40, 40)]
    close = [1e6 + i * 2.0**-33 for i in range(3000)]  # many values that share all but their last bits
    near = [math.nextafter(2.0**k, 0) for k in range(-30, 60)] + [2.0**k for k in range(-30, 60)]
    rows = [("wide", v) for v in values] + [("close", v) for v in close] + [("near", v) for v in near]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    groups = {"wide": values, "close": close, "near": near}
    for q in (0.0, 0.013, 0.5, 0.77, 0.99, 1.0):
        found = {r.k: r.x for r in quantile_disc(df, ["k"], "v", q, "x").collect()}
        assert found == {k: sorted(v)[max(math.ceil(len(v) * q), 1) - 1] for k, v in groups.items()}
    whole = sorted(close + near)
    numbers = df.where("k <> 'wide'")
    assert quantile_disc(numbers, [], "v", 0.9, "x").first().x == whole[math.ceil(len(whole) * 0.9) - 1]
    assert quantile_disc(numbers.where("v < -1"), [], "v", 0.9, "x").collect() == []


def test_quantiles_without_keys_keep_one_list_not_all_values_in_a_task(spark):
    df = spark.range(200_000).select((F.col("id") * 0.37).alias("v"))
    found = quantile_disc(df, [], "v", 0.5, "x")
    assert found.first().x == 99_999 * 0.37
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Sort [" not in text


def purchases(seed=3, n=260):
    """Two thirds belong to one user, with equal times, gaps of days and returns to merchants."""
    rng = random.Random(seed)
    when, rows = START, []
    for i in range(n):
        if rng.random() < 0.75:
            when += dt.timedelta(seconds=rng.choice([1, 600, 3600, 86400, 40 * 86400 if i == 200 else 7200]))
        user = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None])
        merchant = rng.choice(["m1", "m1", "m1", "m2", "m3", None])
        rows.append((f"t{i:04d}", user, merchant, when, rng.randrange(100, 90000) / 100,
                     rng.choice(["TX", "AK", "NY", "Italy", None]), str(rng.randrange(4)), when))
    return rows


COLUMNS = (
    "transaction_id string, user_id string, merchant_id string, event_time timestamp_ntz, amount double, "
    "merchant_state string, mcc string, transaction_date timestamp_ntz"
)


@pytest.mark.parametrize("rows_per_chunk", [1, 9, 1_000_000])
def test_velocity_features(spark, rows_per_chunk):
    rows = purchases()
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = velocity_features(df, "event_time", rows_per_chunk).collect()
    assert len(got) == len(rows)
    by_id = {r.transaction_id: r for r in got}
    for tid, user, _, when, *_ in rows:
        def within(**span):
            since = when - dt.timedelta(**span)
            return [r for r in rows if r[1] == user and since <= r[3] <= when]

        month = within(days=30)
        row = by_id[tid]
        assert row.txns_last_hour == len(within(hours=1))
        assert row.txns_last_day == len(within(days=1))
        assert row.merchants_last_day == len({r[2] for r in within(days=1)} - {None})
        assert row.mean_amount_30d == pytest.approx(sum(r[4] for r in month) / len(month))


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("hours, rows_per_chunk", [(1, 10**6), (24, 10**6), (24, 1), (24, 9), (24 * 365, 10**6)])
def test_neighbour(spark, following, hours, rows_per_chunk):
    rows = purchases(5)
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = with_neighbour(
        df, ["user_id"], "event_time", "transaction_id", ["transaction_id", "amount"], "n", following,
        hours * 3_600_000_000, rows_per_chunk,
    ).collect()
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: (r[3], r[0]), reverse=following)
    last, want = {}, {}
    for r in ordered:
        want[r[0]] = last.get(r[1])
        last[r[1]] = (r[0], r[4])
    assert {r.transaction_id: tuple(r.n) if r.n else None for r in got} == want


def test_a_user_with_a_third_of_the_rows_in_one_day_is_spread(spark):
    micro = 1_704_067_200_000_000  # 2024-01-01
    hot = F.col("id") % 3 == 0
    df = spark.range(60_000).select(
        F.col("id").alias("transaction_id"),
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("user_id"),
        F.timestamp_micros(F.when(hot, micro + F.col("id") * 1_400_000).otherwise(micro + F.col("id") * 86_400_000_000 % 10**15)).alias("at"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        def largest(rows_per_chunk):
            paired = with_neighbour(df, ["user_id"], "at", "transaction_id", ["transaction_id"], "n", rows_per_chunk=rows_per_chunk)
            # counting n keeps the window in the plan
            parts = paired.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.count("n"))
            sizes = [r["rows"] for r in parts.collect()]
            assert sum(sizes) == 60_000
            return max(sizes) / (60_000 / 8)

        assert largest(500) < 2 < largest(1_000_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_impossible_travel(spark):
    hour = dt.timedelta(hours=1)
    rows = [
        ("1", "u", "m", START, 1.0, "TX", "1", START),
        ("2", "u", "m", START + hour, 1.0, "AK", "1", START),
        ("3", "u", "m", START + 2 * hour, 1.0, "AK", "1", START),
        ("4", "u", "m", START + 2 * hour, 1.0, "NY", "1", START),
        ("5", "u", "m", START + 3 * hour, 1.0, "Italy", "1", START),
        ("6", "u", "m", START + 90 * hour, 1.0, "TX", "1", START),
    ]
    got = impossible_travel(spark.createDataFrame(rows, COLUMNS), "event_time").collect()
    assert {(r.previous_id, r.transaction_id): r.impossible for r in got} == {
        ("1", "2"): True, ("2", "3"): False, ("3", "4"): True, ("4", "6"): False
    }


def test_novelty(spark):
    rows = purchases(9, 80)
    got = {r.transaction_id: r for r in novelty_flags(spark.createDataFrame(rows, COLUMNS), "event_time").collect()}
    seen = set()
    for tid, user, _, when, _, state, mcc, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        facts = {"new_category": mcc, "new_hour": when.hour, "new_state": state}
        for flag, value in facts.items():
            new = value is not None and (user, flag, value) not in seen
            assert got[tid][flag] == new, (tid, flag)
            seen.add((user, flag, value))
