"""Row-level features of a cleaned transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.config import ONLINE_CHANNEL
from cardwarden.functions.geo import haversine_km
from cardwarden.operators.enrich import join_centroids


def add_channel(clean: DataFrame) -> DataFrame:
    """``is_online`` stays null when the channel is unknown; the type is then Swipe."""
    return clean.withColumn(
        "is_online", F.lower(F.trim(F.col("use_chip").cast("string"))) == ONLINE_CHANNEL
    ).withColumn("transaction_type", F.when(F.col("is_online"), "Online").otherwise("Swipe"))


def add_distance(clean: DataFrame) -> DataFrame:
    """Kilometres from the user's home to the centre of the merchant's state."""
    located = join_centroids(clean)
    distance = haversine_km(
        F.col("latitude").try_cast("double"),
        F.col("longitude").try_cast("double"),
        F.col("merchant_lat"),
        F.col("merchant_lon"),
    )
    return located.withColumn("distance_km", distance).drop("merchant_lat", "merchant_lon")


def derive_features(clean: DataFrame) -> DataFrame:
    with_ratio = add_channel(clean).withColumns(
        {
            "debt_income_ratio": F.when(
                F.col("yearly_income") > 0, F.col("total_debt") / F.col("yearly_income")
            ),
            "hour": F.hour("transaction_date"),
        }
    )
    return add_distance(with_ratio)
