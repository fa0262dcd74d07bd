"""Left joins that widen a transaction with its label, card, user and category.

No lookup is broadcast by hint except the 51 state centroids. Spark compares each lookup with
``spark.sql.autoBroadcastJoinThreshold``, first by file statistics and again by measured size, and
broadcasts it only below that. A larger lookup is shuffled on its key; the lookups are plain scans, so
AQE may split the partition of a key that holds a large share of the transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.config import STATE_CENTROIDS, UNKNOWN_CATEGORY
from cardwarden.functions.parsing import mcc_key


def join_labels(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``is_fraud``; a transaction without a label counts as not fraud.

    A negative label and a missing one give the same answer, so only the positive labels (about one
    in a thousand) are shuffled or broadcast. Label ids must be unique, as the reader makes them.
    """
    positives = labels.where("is_fraud").select("transaction_id", "is_fraud")
    joined = transactions.join(positives, "transaction_id", "left")
    return joined.withColumn("is_fraud", F.coalesce("is_fraud", F.lit(False)))


def join_cards(transactions: DataFrame, cards: DataFrame) -> DataFrame:
    """The card's own client id is dropped: the transaction's is the one that counts."""
    return transactions.join(cards.drop("client_id"), "card_id", "left")


def join_users(transactions: DataFrame, users: DataFrame) -> DataFrame:
    joined = transactions.join(users.withColumnRenamed("user_id", "client_id"), "client_id", "left")
    return joined.withColumn("user_id", F.col("client_id"))


def join_mcc(transactions: DataFrame, mcc: DataFrame) -> DataFrame:
    keyed = transactions.withColumn("mcc", mcc_key(F.col("mcc")))
    joined = keyed.join(mcc.withColumn("mcc", mcc_key(F.col("mcc"))), "mcc", "left")
    return joined.withColumn(
        "mcc_description", F.coalesce("mcc_description", F.lit(UNKNOWN_CATEGORY))
    )


def join_centroids(transactions: DataFrame) -> DataFrame:
    """Adds the centre of the merchant's US state; exact, case-sensitive match."""
    rows = ", ".join(f"('{code}', {lat}D, {lon}D)" for code, lat, lon in STATE_CENTROIDS)
    centroids = transactions.sparkSession.sql(
        f"select * from values {rows} as c(merchant_state, merchant_lat, merchant_lon)"
    )
    # 51 constant rows, whatever the size of the data.
    return transactions.join(F.broadcast(centroids), "merchant_state", "left")


def enrich_transactions(
    transactions: DataFrame, labels: DataFrame, cards: DataFrame, users: DataFrame, mcc: DataFrame
) -> DataFrame:
    """All four joins. The label join comes first, while the rows it may shuffle are narrow."""
    labelled = join_labels(transactions, labels)
    return join_mcc(join_users(join_cards(labelled, cards), users), mcc)
