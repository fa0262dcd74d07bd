"""General panel: key figures, channels, amounts, model quality, trends, dark web."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.config import DAY_NAMES
from cardwarden.functions.numbers import fixed_bin, money_avg, money_sum, money_sum_or_zero, percent, ratio
from cardwarden.plans.views import FRAUD, View

AMOUNT_TOP, AMOUNT_BINS = 2000, 50
SAMPLE_FRACTION = 0.02


def kpis(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    flag, amount = F.col(view.flag), F.col("amount")
    return facts.agg(
        F.count("*").alias("total_transactions"),
        F.count_if(flag).alias("total_flag"),
        money_sum_or_zero(amount, flag).alias("amount_flag"),
        F.coalesce(money_avg(amount, flag), F.lit(0.0)).alias("avg_flag"),
        F.coalesce(ratio(F.count_if(flag), F.count("*")), F.lit(0.0)).alias("rate"),
    )


def channel_breakdown(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    flag = F.col(view.flag)
    return (
        facts.where("transaction_type is not null")
        .groupBy("transaction_type")
        .agg(
            F.count("*").alias("total"),
            F.count_if(flag).alias("fraud"),
            percent(F.count_if(flag), F.count("*"), 4).alias("fraud_pct"),
            money_sum(F.col("amount"), flag).alias("amount_at_risk"),
        )
    )


def amount_histogram(
    facts: DataFrame, view: View = FRAUD, fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """Share of each class per amount bin, for amounts from 0 to 2000.

    With ``fraction``, the unflagged class is a Bernoulli sample, whatever the size of the table; without
    it, every row counts.
    """
    flag = F.col(view.flag)
    shown = facts.where(F.col("amount").between(0, AMOUNT_TOP)).select("amount", view.flag)
    if fraction is None:
        rows = shown
    else:
        rest = shown.where(~flag).sample(fraction=fraction, seed=seed)
        rows = shown.where(flag).unionByName(rest)
    width = AMOUNT_TOP / AMOUNT_BINS
    binned = rows.select(
        F.when(flag, view.flagged_label).otherwise(view.other_label).alias("tipo"),
        fixed_bin(F.col("amount"), 0, width, AMOUNT_BINS).alias("bin"),
    )
    counted = binned.groupBy("tipo", "bin").agg(F.count("*").alias("n"))
    return counted.select(
        "tipo",
        "bin",
        (F.col("bin") * F.lit(width)).alias("bin_from"),
        "n",
        (F.lit(100.0) * F.col("n") / F.sum("n").over(W.partitionBy("tipo"))).alias("pct"),
    )


def confusion_matrix(facts: DataFrame) -> DataFrame:
    fraud, flagged = F.col("is_fraud"), F.col("is_suspicious")
    return facts.agg(
        F.count_if(fraud & flagged).alias("tp"),
        F.count_if(~fraud & flagged).alias("fp"),
        F.count_if(fraud & ~flagged).alias("fn"),
        F.count_if(~fraud & ~flagged).alias("tn"),
    )


def precision_recall_f1(confusion: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    rates = confusion.select(
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fn")), zero).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.select(p, r, F.coalesce(ratio(2 * p * r, p + r), zero).alias("f1"))


def yearly_trend(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    flag = F.col(view.flag)
    return (
        facts.where("transaction_date is not null")
        .groupBy(F.year("transaction_date").alias("yr"))
        .agg(
            F.count("*").alias("total"),
            F.count_if(flag).alias("fraud"),
            percent(F.count_if(flag), F.count("*"), 4).alias("fraud_pct"),
            money_sum(F.col("amount"), flag).alias("amount_at_risk"),
        )
        .orderBy("yr")
    )


def month_of(column: str):
    return F.date_trunc("month", column).cast("timestamp_ntz")


def monthly_trend(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    flag = F.col(view.flag)
    return (
        facts.where("transaction_date is not null")
        .groupBy(month_of("transaction_date").alias("month"))
        .agg(
            F.count_if(flag).alias("fraud"),
            money_sum(F.col("amount"), flag).alias("amount_at_risk"),
        )
        .orderBy("month")
    )


def dow_hour_heatmap(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    """Flagged rows per weekday (Sunday is 0) and hour."""
    return (
        facts.where("transaction_date is not null")
        .groupBy(
            (F.dayofweek("transaction_date") - 1).alias("dow"),
            F.hour("transaction_date").alias("hr"),
        )
        .agg(F.count_if(view.flag).alias("fraud"))
    )


def dow_hour_pivot(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    """The heatmap with one row per day and one column per hour; null where nothing happened."""
    cells = dow_hour_heatmap(facts, view)
    wide = cells.groupBy("dow").pivot("hr", list(range(24))).agg(F.sum("fraud"))
    names = F.array(*[F.lit(day) for day in DAY_NAMES])
    return wide.select(
        "dow",
        F.element_at(names, F.col("dow") + 1).alias("dow_label"),
        *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)],
    ).orderBy("dow")


def dark_web_rates(facts: DataFrame, view: View = FRAUD) -> DataFrame:
    flag = F.col(view.flag)
    return (
        facts.where("card_on_dark_web is not null")
        .groupBy("card_on_dark_web")
        .agg(
            F.count("*").alias("total"),
            F.count_if(flag).alias("fraud"),
            percent(F.count_if(flag), F.count("*"), 4).alias("fraud_pct"),
        )
        .withColumn("label", F.when(F.col("card_on_dark_web"), "Sí").otherwise("No"))
    )
