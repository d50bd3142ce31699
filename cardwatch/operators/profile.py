"""Derived dimensions and enrichments: card profile, merchant record,
previous transaction, foreign-country feature (A9, J2, J3, P16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.columns import has_location
from cardwatch.operators.joins import DEFAULT_FAN_OUT, DEFAULT_HOT_KEYS, DEFAULT_HOT_ROWS, salted_enrich
from cardwatch.operators.segments import SegmentedScan

PERCENTILE_ACCURACY = 10_000


def _mode(df: DataFrame, key: str, value: str, out: str, where=None) -> DataFrame:
    """Most frequent non-NULL ``value`` per ``key``; ties go to the smallest
    value.  Two hash aggregations (both combine map-side), no window."""
    src = df if where is None else df.filter(where)
    counts = src.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(
        F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(out)
    )


def card_profile(
    df: DataFrame,
    low: float = 0.05,
    high: float = 0.95,
    accuracy: int = PERCENTILE_ACCURACY,
) -> DataFrame:
    """Per card typical spend band, home country and activity span.

    ``percentile_approx`` keeps a bounded sketch per card that merges
    map-side, so a very busy card is never gathered into one buffer; on
    groups smaller than ``accuracy`` it returns the exact order statistic
    (the element at rank ceil(p * n)).
    """
    spend = df.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("n_txn"),
        F.percentile_approx("amount", [low, high], accuracy).alias("_p"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    ).select(
        "card_id", "n_txn",
        F.col("_p")[0].alias("typical_spend_low"),
        F.col("_p")[1].alias("typical_spend_high"),
        "first_seen", "last_seen",
    )
    home = _mode(df, "card_id", "country", "home_country", where=has_location("lat", "lon"))
    return spend.join(home, "card_id", "left")


def merchant_dim(df: DataFrame) -> DataFrame:
    """J2 dimension: merchant -> most frequent category and country."""
    cat = _mode(df, "merchant_id", "merchant_category", "merchant_home_category")
    ctry = _mode(df, "merchant_id", "country", "merchant_home_country")
    return cat.join(ctry, "merchant_id", "full")


def merchant_enrich(df: DataFrame, merchants: DataFrame) -> DataFrame:
    """Left join transactions to the merchant record; AQE broadcasts the
    merchant side if its measured size allows."""
    return df.join(merchants, "merchant_id", "left")


def prev_txn(df: DataFrame, segment_rows: int | None = None) -> DataFrame:
    """Each transaction with the card's previous transaction (time,
    country, location), exact over the whole history."""
    scan = SegmentedScan(df, "card_id", ("event_time", "transaction_id"), segment_rows)
    return scan.last_before(["country", "lat", "lon"]).rows()


def foreign_txn(
    df: DataFrame,
    profile: DataFrame,
    min_hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_hot_keys: int = DEFAULT_HOT_KEYS,
    fan_out: int = DEFAULT_FAN_OUT,
) -> DataFrame:
    """``is_foreign`` = located transaction outside the card's home
    country (NULL home -> False)."""
    prof = profile.select("card_id", "n_txn", "home_country")
    j = salted_enrich(df, prof, "card_id", "n_txn", ["transaction_id", "timestamp"],
                      min_hot_rows=min_hot_rows, max_hot_keys=max_hot_keys, fan_out=fan_out)
    return j.withColumn(
        "is_foreign",
        F.coalesce(has_location("lat", "lon") & (F.col("country") != F.col("home_country")), F.lit(False)),
    ).drop("n_txn")
