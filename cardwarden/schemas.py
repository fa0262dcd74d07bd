"""Column contracts of the inputs and declared types of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED_COLUMNS = {
    "transactions": ("id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id", "mcc"),
    "users": ("id", "current_age", "gender", "yearly_income", "total_debt", "credit_score"),
    "cards": ("id", "card_brand", "card_type", "has_chip", "credit_limit"),
}
# Read by later steps but absent from some feeds; they become nulls when missing.
OPTIONAL_COLUMNS = {
    "transactions": ("merchant_city", "merchant_state", "errors"),
    "users": ("latitude", "longitude"),
    "cards": ("card_on_dark_web",),
}

USER_COLUMNS = (
    "user_id", "current_age", "gender", "latitude", "longitude",
    "yearly_income", "total_debt", "credit_score",
)
CARD_COLUMNS = (
    "card_id", "card_brand", "card_type", "has_chip", "credit_limit", "card_on_dark_web", "client_id",
)

# Column names, their order and types are the contract with whoever reads the tables.
# The fact table, in load order.
FACT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("transaction_date", T.TimestampNTZType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_city", T.StringType()),
        T.StructField("merchant_state", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("mcc_description", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("errors", T.StringType()),
        T.StructField("user_age", T.IntegerType()),
        T.StructField("user_gender", T.StringType()),
        T.StructField("user_state", T.StringType()),
        T.StructField("yearly_income", T.DecimalType(12, 2)),
        T.StructField("total_debt", T.DecimalType(12, 2)),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("card_brand", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("has_chip", T.BooleanType()),
        T.StructField("card_on_dark_web", T.BooleanType()),
        T.StructField("credit_limit", T.DecimalType(12, 2)),
        T.StructField("debt_income_ratio", T.DecimalType(8, 4)),
        T.StructField("distance_km", T.DecimalType(10, 2)),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("is_suspicious", T.BooleanType()),
        T.StructField("suspicion_reasons", T.StringType()),
        T.StructField("fraud_score", T.IntegerType()),
        T.StructField("card_txn_count", T.LongType()),
    ]
)

# What is stored: the channel flag tells a card-present row from one of unknown channel, which the
# by-state metrics need.
STORED_FACT = T.StructType([*FACT.fields, T.StructField("is_online", T.BooleanType())])

_SEGMENT_MEASURES = [
    T.StructField("total_transactions", T.LongType()),
    T.StructField("total_fraud", T.LongType()),
    T.StructField("fraud_rate", T.DecimalType(8, 4)),
    T.StructField("amount_at_risk", T.DecimalType(16, 2)),
    T.StructField("total_suspicious", T.LongType()),
    T.StructField("amount_suspicious", T.DecimalType(18, 2)),
]

# Counts are bigint: a table of 100 TB passes the range of a 32-bit integer.
METRICS_GLOBAL = T.StructType(
    [
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_fraud", T.LongType()),
        T.StructField("fraud_rate", T.DecimalType(8, 4)),
        T.StructField("total_amount_at_risk", T.DecimalType(16, 2)),
        T.StructField("avg_fraud_amount", T.DecimalType(12, 2)),
        T.StructField("false_positive_rate", T.DecimalType(8, 4)),
        T.StructField("false_negative_rate", T.DecimalType(8, 4)),
        T.StructField("true_positives", T.LongType()),
        T.StructField("true_negatives", T.LongType()),
        T.StructField("false_positives", T.LongType()),
        T.StructField("false_negatives", T.LongType()),
        T.StructField("dataset_start_date", T.DateType()),
        T.StructField("dataset_end_date", T.DateType()),
    ]
)
BY_MCC = T.StructType(
    [
        T.StructField("mcc", T.StringType()),
        T.StructField("mcc_description", T.StringType()),
        *_SEGMENT_MEASURES,
    ]
)
BY_CARD_TYPE = T.StructType(
    [
        T.StructField("card_brand", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("has_chip", T.BooleanType()),
        *_SEGMENT_MEASURES,
    ]
)
BY_STATE = T.StructType(
    [
        T.StructField("state", T.StringType()),
        *_SEGMENT_MEASURES,
    ]
)
BY_MERCHANT = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_city", T.StringType()),
        T.StructField("merchant_state", T.StringType()),
        T.StructField("mcc_description", T.StringType()),
        *_SEGMENT_MEASURES,
    ]
)
USER_PROFILES = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("yearly_income", T.DecimalType(12, 2)),
        T.StructField("total_debt", T.DecimalType(12, 2)),
        T.StructField("debt_income_ratio", T.DecimalType(8, 4)),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("num_cards", T.LongType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_fraud", T.LongType()),
        T.StructField("fraud_rate", T.DecimalType(8, 4)),
        T.StructField("total_spent", T.DecimalType(16, 2)),
        T.StructField("avg_transaction", T.DecimalType(12, 2)),
        T.StructField("amount_at_risk", T.DecimalType(16, 2)),
    ]
)
RUN_LOG = T.StructType(
    [
        T.StructField("run_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("rows_fraud", T.LongType()),
        T.StructField("duration_secs", T.DecimalType(10, 2)),
        T.StructField("notes", T.StringType()),
    ]
)

WAREHOUSE = {
    "transactions_processed": FACT,
    "fraud_metrics_global": METRICS_GLOBAL,
    "fraud_by_mcc": BY_MCC,
    "fraud_by_card_type": BY_CARD_TYPE,
    "fraud_by_state": BY_STATE,
    "fraud_by_merchant": BY_MERCHANT,
    "user_profiles": USER_PROFILES,
}
