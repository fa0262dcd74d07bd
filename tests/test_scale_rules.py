"""No silent drop, no cap, no machine-local folder on a cluster."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.clean import clean_transactions, rejected_rows
from cardwarden.plans.merchants import top_merchants
from cardwarden.session import shared_dir

AMOUNTS = ["$12345678901.5", "$1e20", "Infinity", "NaN", "$9999999999.99", "$5", "$-1", "x"]


def test_amounts_that_cannot_be_stored_are_rejected_with_a_reason(spark):
    rows = spark.createDataFrame([(a, "2024-01-02 03:04:05") for a in AMOUNTS], "amount string, date string")
    assert sorted(r.amount for r in clean_transactions(rows).collect()) == [5.0, 9999999999.99]
    assert all(r.x is not None for r in clean_transactions(rows).select(F.col("amount").try_cast("decimal(12,2)").alias("x")).collect())
    assert {r.reason: r.rejected for r in rejected_rows(rows).collect()} == {
        "amount_not_storable": 4, "amount_negative": 1, "amount_unreadable": 1,
    }


@pytest.mark.parametrize("n", [1, 50])
def test_top_merchants_gives_as_many_as_asked(spark, n):
    rows = spark.range(60).select(
        F.col("id").cast("string").alias("merchant_id"), F.lit("c").alias("merchant_city"), F.lit("s").alias("merchant_state"),
        F.lit("d").alias("mcc_description"), F.lit(9).alias("total_transactions"), F.lit(1).alias("total_fraud"),
        F.lit(0.1).alias("fraud_rate"), F.col("id").cast("double").alias("amount_at_risk"),
    )
    assert top_merchants(rows, n).count() == n


def test_a_cluster_must_name_its_shared_folder():
    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master, applicationId="a"))

    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077", None))
    assert shared_dir(session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"
