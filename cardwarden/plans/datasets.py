"""Data-set panel: what the five inputs look like once loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.config import UNKNOWN_CATEGORY
from cardwarden.functions.numbers import fixed_bin, money_avg, percent
from cardwarden.operators.quantiles import quantile_cont
from cardwarden.plans.views import one_row, with_share


def dataset_date_range(global_metrics: DataFrame) -> DataFrame:
    """Read from the stored metrics, not by scanning the facts."""
    return global_metrics.select(
        F.col("dataset_start_date").alias("dmin"), F.col("dataset_end_date").alias("dmax")
    )


def transaction_summary(facts: DataFrame) -> DataFrame:
    amount = F.col("amount")
    counted = facts.agg(
        F.count("*").alias("total"),
        F.count_distinct("user_id").alias("usuarios_unicos"),
        F.count_distinct("card_id").alias("tarjetas_unicas"),
        F.count_distinct("merchant_id").alias("comercios_unicos"),
        F.min("transaction_date").alias("desde"),
        F.max("transaction_date").alias("hasta"),
        F.round(money_avg(amount), 2).alias("monto_promedio"),
    )
    values = facts.select(amount.cast("double").alias("amount"))
    median = quantile_cont(values, [], "amount", 0.5, "median").select(
        F.round("median", 2).alias("monto_mediana")
    )
    return one_row(counted, median)


def yearly_volume(facts: DataFrame) -> DataFrame:
    return (
        facts.where("transaction_date is not null")
        .groupBy(F.year("transaction_date").alias("anio"))
        .agg(F.count("*").alias("transacciones"))
        .orderBy("anio")
    )


def channel_share(facts: DataFrame) -> DataFrame:
    channels = (
        facts.where("transaction_type is not null")
        .groupBy("transaction_type")
        .agg(F.count("*").alias("total"))
    )
    return with_share(channels, "total", 2)


def user_summary(profiles: DataFrame) -> DataFrame:
    def mean(column: str, digits: int):
        # Decimal and integer sums are exact, so the mean does not depend on row order.
        total = F.sum(column).cast("double")
        return F.round(F.try_divide(total, F.count(column).cast("double")), digits)

    return profiles.agg(
        F.count("*").alias("total_usuarios"),
        mean("age", 1).alias("edad_promedio"),
        mean("yearly_income", 0).alias("ingreso_promedio"),
        mean("credit_score", 0).alias("score_promedio"),
        mean("debt_income_ratio", 2).alias("dir_promedio"),
    )


def _histogram(df: DataFrame, column: str, low: float, width: float, bins: int) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(fixed_bin(F.col(column), low, width, bins).alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("bin", (F.lit(float(low)) + F.col("bin") * F.lit(float(width))).alias("bin_from"), "n")
    )


def age_histogram(profiles: DataFrame) -> DataFrame:
    """Thirty bins of three years from 15; older users fall into the last."""
    return _histogram(profiles, "age", 15, 3, 30)


def income_histogram(profiles: DataFrame) -> DataFrame:
    """Forty bins over incomes from 0 to 300,000."""
    shown = profiles.where(F.col("yearly_income").between(0, 300_000))
    return _histogram(shown, "yearly_income", 0, 7_500, 40)


def credit_histogram(profiles: DataFrame) -> DataFrame:
    """Thirty bins of twenty points from 300."""
    return _histogram(profiles, "credit_score", 300, 20, 30)


def gender_share(profiles: DataFrame) -> DataFrame:
    genders = profiles.where("gender is not null").groupBy("gender").agg(F.count("*").alias("total"))
    return with_share(genders, "total", 1)


def card_summary(facts: DataFrame) -> DataFrame:
    """Rows are merged per card before anything distinct is counted."""
    per_card = (
        facts.where("card_id is not null")
        .groupBy("card_id", "card_brand", "card_type")
        .agg(
            F.count_if("has_chip").alias("chip"), F.count_if("card_on_dark_web").alias("dark_web")
        )
    )
    return per_card.agg(
        F.count_distinct("card_id").alias("total_cards"),
        F.count_distinct("card_brand").alias("marcas"),
        F.count_distinct("card_type").alias("tipos"),
        F.coalesce(F.sum("chip"), F.lit(0)).alias("con_chip"),
        F.coalesce(F.sum("dark_web"), F.lit(0)).alias("en_dark_web"),
    )


def label_balance(facts: DataFrame) -> DataFrame:
    counts = facts.agg(
        F.count("*").alias("total"),
        F.count_if("is_fraud").alias("fraudes"),
        F.count_if(~F.col("is_fraud")).alias("legitimas"),
    )
    return counts.select(
        "*",
        percent(F.col("fraudes"), F.col("total"), 4).alias("pct_fraude"),
        F.floor(F.col("legitimas") / F.greatest(F.col("fraudes"), F.lit(1))).alias("ratio_desbalance"),
    )


def mcc_usage(facts: DataFrame) -> DataFrame:
    per_code = facts.groupBy("mcc", "mcc_description").agg(F.count("*").alias("n"))
    unknown = F.when(F.col("mcc_description") == UNKNOWN_CATEGORY, F.col("n"))
    return per_code.agg(
        F.count_distinct("mcc").alias("mccs_usados"),
        F.count_distinct("mcc_description").alias("descripciones"),
        F.coalesce(F.sum(unknown), F.lit(0)).alias("sin_descripcion"),
    )


def last_run(run_log: DataFrame) -> DataFrame:
    return (
        run_log.select("run_at", "status", "rows_processed", "rows_fraud")
        .orderBy(F.desc("run_at"))
        .limit(1)
    )
