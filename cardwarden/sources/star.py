"""Adapter from the star-schema test tables to the five inputs (see FIXTURES.md)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.sources.files import card_columns, user_columns

# Merchant states by event, with a lower-case and an empty one on purpose.
_STATES = "AL,CA,TX,NY,FL,OH,WA,IL,GA,PA,MI,NC,AZ,CO,TN,MA,IN,MO,WI,MN,Italy,Mexico,Canada,ca,"


@dataclass(frozen=True)
class Inputs:
    """The five inputs, raw text columns, lazily read."""

    transactions: DataFrame
    users: DataFrame
    cards: DataFrame
    mcc: DataFrame
    labels: DataFrame


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(index: Column, *choices: str) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (index + 1).cast("int"))


def transactions_from(events: DataFrame) -> DataFrame:
    """Works on a batch or a streaming ``events`` table."""
    event, kind = F.col("event_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    shifted = F.col("ts") + F.make_dt_interval((event % 1000).cast("int"))
    date = (
        F.when(event % 53 == 0, F.lit("not-a-date"))
        .when(event % 4 == 1, F.date_format(shifted, "yyyy-MM-dd"))
        .when(event % 4 == 2, F.date_format(shifted, "MM/dd/yyyy HH:mm"))
        .otherwise(F.date_format(shifted, "yyyy-MM-dd HH:mm:ss"))
    )
    prefix = F.when((kind == "signup") & (event % 7 == 0), F.lit("$-")).otherwise(F.lit("$"))
    amount = F.concat(prefix, F.round(F.col("value") * 3, 2).cast("decimal(12,2)").cast("string"))
    chip = (
        F.when(kind == "click", F.lit("Online Transaction"))
        .when(event % 101 == 0, F.lit(None))
        .when(kind == "view", F.lit("Chip Transaction"))
        .otherwise(F.lit("Swipe Transaction"))
    )
    errors = F.when(
        kind == "error",
        F.when(event % 4 == 0, F.lit("")).when(event % 4 == 1, F.lit("nan")).otherwise(F.lit("Bad PIN")),
    )
    user = F.col("user_id") % 40
    return events.select(
        event.cast("string").alias("transaction_id"),
        date.alias("date"),
        user.cast("string").alias("client_id"),
        (user * 10 + k % 3).cast("string").alias("card_id"),
        amount.alias("amount"),
        chip.alias("use_chip"),
        k.cast("string").alias("merchant_id"),
        F.concat(F.lit("City_"), (k % 40).cast("string")).alias("merchant_city"),
        F.when(kind != "click", _pick(k % 25, *_STATES.split(","))).alias("merchant_state"),
        (5000 + k % 12).cast("string").alias("mcc"),
        errors.alias("errors"),
        F.col("ts").alias("event_time"),
    )


def users_from(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.where(key % 40 != 39).select(
        key.cast("string").alias("id"),
        (18 + key % 60).cast("int").alias("current_age"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
        (25 + (key * 7) % 24).cast("double").alias("latitude"),
        (-(70 + (key * 11) % 54)).cast("double").alias("longitude"),
        F.concat(F.lit("$"), F.floor(F.col("c_acctbal") * 10).cast("string")).alias("yearly_income"),
        F.concat(F.lit("$"), ((key * 137) % 90000).cast("string")).alias("total_debt"),
        (480 + (key * 13) % 370).cast("int").alias("credit_score"),
    )


def cards_from(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    card_type = (
        F.when(F.col("p_type").isin("STANDARD", "PROMO"), "Credit")
        .when(F.col("p_type").isin("ECONOMY", "MEDIUM"), "Debit")
        .otherwise("Debit (Prepaid)")
    )
    return part.select(
        key.cast("string").alias("id"),
        _pick(key % 4, "Visa", "Mastercard", "Amex", "Discover").alias("card_brand"),
        card_type.alias("card_type"),
        F.when(F.col("p_size") % 10 < 8, "YES").otherwise("NO").alias("has_chip"),
        F.concat(F.lit("$"), F.floor(F.col("p_retailprice") * 10).cast("string")).alias("credit_limit"),
        F.when(key % 41 == 0, "Yes").otherwise("No").alias("card_on_dark_web"),
    )


def mcc_from(part: DataFrame) -> DataFrame:
    last = F.col("p_partkey") % 10
    return part.select(
        (5000 + last).cast("string").alias("mcc"),
        F.concat(F.lit("Category_"), last.cast("string")).alias("mcc_description"),
    ).distinct()


def labels_from(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    fraud = ((F.col("value") * 3 > 300) & (event % 5 == 0)) | (event % 97 == 0)
    return events.where(event % 3 != 0).select(
        event.cast("string").alias("transaction_id"), fraud.alias("is_fraud")
    )


def star_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    events, part = _read(spark, sf_dir, "events"), _read(spark, sf_dir, "part")
    return Inputs(
        transactions=transactions_from(events),
        users=user_columns(users_from(_read(spark, sf_dir, "customer"))),
        cards=card_columns(cards_from(part)),
        mcc=mcc_from(part),
        labels=labels_from(events),
    )
