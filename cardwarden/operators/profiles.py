"""Per-user and per-card profiles of the cleaned history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.config import DEFAULT_RULES, ScoreRules
from cardwarden.functions.numbers import ratio
from cardwarden.operators.quantiles import quantile_disc


@dataclass(frozen=True)
class Profiles:
    """What scoring needs to know about the whole history."""

    user_p99: DataFrame
    card_frequency: DataFrame


def user_p99(clean: DataFrame, rules: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """Amount that 99 % of a user's transactions stay at or below; an amount that occurred."""
    return quantile_disc(clean, ["user_id"], "amount", rules.user_quantile, "p99_amount")


def p99_by(clean: DataFrame, column: str, rules: ScoreRules = DEFAULT_RULES) -> DataFrame:
    """The same threshold per category, channel or any other column."""
    return quantile_disc(clean, [column], "amount", rules.user_quantile, "p99_amount")


def user_hour_profile(clean: DataFrame) -> DataFrame:
    """Share of a user's activity in each hour of the day.

    The window runs over the counts, at most 24 rows per user, not over the transactions.
    """
    per_hour = (
        clean.select("user_id", F.hour("transaction_date").cast("bigint").alias("hour"))
        .groupBy("user_id", "hour")
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(W.partitionBy("user_id"))
    return per_hour.select("user_id", "hour", ratio(F.col("n"), total).alias("hour_ratio"))


def card_frequency(clean: DataFrame) -> DataFrame:
    return clean.groupBy("card_id").agg(F.count("*").alias("card_txn_count"))


def build_profiles(clean: DataFrame, rules: ScoreRules = DEFAULT_RULES) -> Profiles:
    return Profiles(user_p99(clean, rules), card_frequency(clean))
