"""Supervised classifier next to the rules, and the rule-or-model ensemble.

A transaction's part is fixed by a hash of its id: of ten buckets seven train the model, one chooses the
probability above which it flags (the best F1 on a grid), and two, which neither has seen, give the comparison.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "f_amount", "f_online", "f_error", "f_dark_web", "f_distance", "f_hour", "f_age", "f_credit_score",
    "f_debt_ratio", "f_card_use",
)
BUCKETS, TRAIN_BELOW, TEST_FROM = 10, 7, 8
THRESHOLDS = tuple(i / 20 for i in range(1, 20))


def bucket_of(key: str) -> Column:
    """0 to 9 from the first 28 bits of an MD5, which any engine can compute."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 7), 16, 10).cast("bigint") % BUCKETS


def part() -> Column:
    return F.when(F.col("bucket") < TRAIN_BELOW, "train").when(F.col("bucket") < TEST_FROM, "choose").otherwise("test")


def _number(column: Column) -> Column:
    """Trees need a number everywhere: a missing one gets a value of its own."""
    return F.coalesce(column.cast("double"), F.lit(-1.0))


def model_rows(facts: DataFrame) -> DataFrame:
    return facts.select(
        "transaction_id",
        "is_fraud",
        "is_suspicious",
        _number(F.col("amount")).alias("f_amount"),
        _number(F.col("transaction_type") == "Online").alias("f_online"),
        F.coalesce(~F.trim("errors").isin("", "nan"), F.lit(False)).cast("double").alias("f_error"),
        _number(F.col("card_on_dark_web")).alias("f_dark_web"),
        _number(F.col("distance_km")).alias("f_distance"),
        _number(F.hour("transaction_date")).alias("f_hour"),
        _number(F.col("user_age")).alias("f_age"),
        _number(F.col("credit_score")).alias("f_credit_score"),
        _number(F.col("debt_income_ratio")).alias("f_debt_ratio"),
        _number(F.col("card_txn_count")).alias("f_card_use"),
        bucket_of("transaction_id").alias("bucket"),
    )


def train(rows: DataFrame, trees: int = 10, depth: int = 4, seed: int = 42) -> PipelineModel:
    """Boosted trees on the training buckets; frauds weigh as much in total as the rest."""
    training = rows.where(F.col("bucket") < TRAIN_BELOW)
    counts = training.agg(F.count("*").alias("n"), F.count_if("is_fraud").alias("fraud")).first()
    weight = (counts["n"] - counts["fraud"]) / max(counts["fraud"], 1)
    weighted = training.select(
        *FEATURES,
        F.col("is_fraud").cast("double").alias("label"),
        F.when(F.col("is_fraud"), F.lit(float(weight))).otherwise(F.lit(1.0)).alias("weight"),
    )
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FEATURES), outputCol="features"),
            GBTClassifier(
                featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees,
                maxDepth=depth, seed=seed, cacheNodeIds=False, maxMemoryInMB=512,
            ),
        ]
    ).fit(weighted)


def predict(rows: DataFrame, model: PipelineModel, probability_above: float = 0.5) -> DataFrame:
    """Adds the probability of fraud, the model's flag, and the flag of rules or model."""
    scored = model.transform(rows).withColumn("fraud_probability", vector_to_array("probability")[1])
    return scored.select(
        "transaction_id",
        "bucket",
        "is_fraud",
        "is_suspicious",
        "fraud_probability",
        (F.col("fraud_probability") > probability_above).alias("model_flag"),
        (F.col("is_suspicious") | (F.col("fraud_probability") > probability_above)).alias("either_flag"),
    )


def choose_threshold(predictions: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> float:
    """The threshold with the best F1 of the model on the choosing bucket; the lowest of equals. One pass counts all."""
    rows = predictions.where(part() == "choose").select("is_fraud", "fraud_probability")
    flagged = [F.col("fraud_probability") > t for t in thresholds]
    counts = rows.agg(
        F.count_if("is_fraud").alias("fraud"),
        *[F.count_if(f).alias(f"flagged_{i}") for i, f in enumerate(flagged)],
        *[F.count_if(f & F.col("is_fraud")).alias(f"hit_{i}") for i, f in enumerate(flagged)],
    ).first()
    f1 = [2 * counts[f"hit_{i}"] / max(counts["fraud"] + counts[f"flagged_{i}"], 1) for i in range(len(thresholds))]
    return thresholds[f1.index(max(f1))]


def split_counts(facts: DataFrame) -> DataFrame:
    """Rows, frauds and confusion counts of the rules in each part of the split."""
    fraud, flag = F.col("is_fraud"), F.col("is_suspicious")
    return (
        facts.select(bucket_of("transaction_id").alias("bucket"), "is_fraud", "is_suspicious")
        .groupBy(part().alias("part"))
        .agg(
            F.count("*").alias("total"),
            F.count_if(fraud).alias("fraud"),
            F.count_if(fraud & flag).alias("tp"),
            F.count_if(~fraud & flag).alias("fp"),
            F.count_if(fraud & ~flag).alias("fn"),
            F.count_if(~fraud & ~flag).alias("tn"),
        )
    )


def compare(predictions: DataFrame) -> DataFrame:
    """Confusion counts of rules, model and ensemble on the rows the model has not seen."""
    flags = F.array(
        F.struct(F.lit("rules").alias("method"), F.col("is_suspicious").alias("flag")),
        F.struct(F.lit("model").alias("method"), F.col("model_flag").alias("flag")),
        F.struct(F.lit("rules_or_model").alias("method"), F.col("either_flag").alias("flag")),
    )
    fraud, flag = F.col("is_fraud"), F.col("flag")
    return (
        predictions.where(F.col("bucket") >= TEST_FROM)
        .select("is_fraud", F.inline(flags))
        .groupBy("method")
        .agg(
            F.count_if(fraud & flag).alias("tp"),
            F.count_if(~fraud & flag).alias("fp"),
            F.count_if(fraud & ~flag).alias("fn"),
            F.count_if(~fraud & ~flag).alias("tn"),
        )
    )
