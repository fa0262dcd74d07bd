"""User panel: one user's profile, spending and history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.config import US_STATES
from cardwarden.functions.numbers import fixed_bin, money_sum
from cardwarden.plans.overview import month_of

USER_AMOUNT_TOP, USER_AMOUNT_BINS = 2000, 30


def top_fraud_users(profiles: DataFrame, n: int = 5) -> DataFrame:
    return (
        profiles.where("total_fraud > 0")
        .select("user_id", "total_transactions", "total_fraud", "fraud_rate")
        .orderBy(F.desc("total_fraud"), "user_id")
        .limit(n)
    )


def user_profile_lookup(profiles: DataFrame, user_id: str) -> DataFrame:
    return profiles.where(F.col("user_id") == user_id).drop("computed_at")


def of_user(facts: DataFrame, user_id: str) -> DataFrame:
    return facts.where(F.col("user_id") == user_id)


def user_monthly_spend(facts: DataFrame, user_id: str) -> DataFrame:
    return (
        of_user(facts, user_id)
        .where("transaction_date is not null")
        .groupBy(month_of("transaction_date").alias("month"))
        .agg(
            money_sum(F.col("amount")).alias("total_amount"),
            F.count("*").alias("total_txns"),
            F.count_if("is_fraud").alias("fraud"),
        )
        .orderBy("month")
    )


def user_amount_histogram(facts: DataFrame, user_id: str) -> DataFrame:
    """Thirty bins over amounts strictly between 0 and 2000, by fraud label."""
    shown = of_user(facts, user_id).where(f"amount > 0 and amount < {USER_AMOUNT_TOP}")
    # Scaled so that a bin is one unit wide: 2000/30 is not a whole number.
    scaled = F.col("amount").cast("double") * 3 / 200
    return (
        shown.groupBy(
            F.when(F.col("is_fraud"), "Fraude").otherwise("Legítima").alias("tipo"),
            fixed_bin(scaled, 0, 1, USER_AMOUNT_BINS).alias("bin"),
        )
        .agg(F.count("*").alias("n"))
    )


def user_category_mix(facts: DataFrame, user_id: str, n: int = 10) -> DataFrame:
    return (
        of_user(facts, user_id)
        .where("mcc_description is not null")
        .groupBy("mcc_description")
        .agg(
            F.count("*").alias("txns"),
            money_sum(F.col("amount")).alias("gasto"),
            F.count_if("is_fraud").alias("fraud"),
        )
        .orderBy(F.desc_nulls_last("gasto"), "mcc_description")
        .limit(n)
    )


def user_geography(facts: DataFrame, user_id: str) -> DataFrame:
    return (
        of_user(facts, user_id)
        .where(F.col("merchant_state").isin(*US_STATES))
        .groupBy(F.col("merchant_state").alias("state"))
        .agg(F.count("*").alias("txns"), F.count_if("is_fraud").alias("fraudes"))
    )


def user_history(facts: DataFrame, user_id: str, n: int = 100) -> DataFrame:
    """Newest transactions with a row status; equal times are ordered by id."""
    newest = (
        of_user(facts, user_id)
        .orderBy(F.desc_nulls_last("transaction_date"), F.desc("transaction_id"))
        .limit(n)
    )
    status = (
        F.when(F.col("is_fraud"), "fraud").when(F.col("is_suspicious"), "suspicious").otherwise("legit")
    )
    return newest.select(
        "transaction_date",
        "amount",
        "merchant_city",
        "merchant_state",
        "mcc_description",
        "transaction_type",
        "is_fraud",
        "is_suspicious",
        "suspicion_reasons",
        status.alias("status"),
    )
