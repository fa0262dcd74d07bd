"""Typed columns and the rows that survive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.parsing import parse_date, parse_flag, parse_money

MONEY_COLUMNS = ("amount", "credit_limit", "yearly_income", "total_debt")
FLAG_COLUMNS = ("has_chip", "card_on_dark_web")
# The least amount that, rounded to cents, does not fit the stored decimal(12,2).
AMOUNT_LIMIT = 1e10 - 0.005


def type_columns(df: DataFrame) -> DataFrame:
    """Dates, money and flags parsed where they are still text.

    Apply it to users and cards before they are joined, so that their texts are parsed once per user
    or card and not once per transaction.
    """
    kinds = dict(df.dtypes)
    typed = {c: parse_money(F.col(c)) for c in MONEY_COLUMNS if kinds.get(c) == "string"}
    typed |= {c: parse_flag(F.col(c)) for c in FLAG_COLUMNS if kinds.get(c) == "string"}
    if "date" in kinds and "transaction_date" not in kinds:
        typed["transaction_date"] = parse_date(F.col("date"))
    return df.withColumns(typed) if typed else df


def clean_transactions(merged: DataFrame) -> DataFrame:
    """Rows with a readable date and an amount of zero or more that the warehouse can hold."""
    storable = (F.col("amount") >= 0) & (F.col("amount") < AMOUNT_LIMIT)  # NaN is above every number
    return type_columns(merged).where(storable & F.col("transaction_date").isNotNull())


def rejected_rows(merged: DataFrame) -> DataFrame:
    """How many rows cleaning drops, by the first reason that applies."""
    reason = (
        F.when(F.col("amount").isNull(), "amount_unreadable")
        .when(F.col("amount") < 0, "amount_negative")
        .when(F.col("amount") >= AMOUNT_LIMIT, "amount_not_storable")
        .when(F.col("transaction_date").isNull(), "date_unreadable")
    )
    return (
        type_columns(merged)
        .select(reason.alias("reason"))
        .where("reason is not null")
        .groupBy("reason")
        .agg(F.count("*").alias("rejected"))
    )
