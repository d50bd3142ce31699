"""Deterministic view of the ``events`` table as card transactions.

The test tables carry no payment stream, so ``events`` is mapped row by row
onto the transaction record.  The mapping has no randomness: the same rules
are written once here and once as SQL (``plans.oracle``) and both sides see
identical rows.  It is a plain projection: it keeps the scan's column pruning
and filter pushdown and adds no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal the reference for equal results) ------------------
# event_type -> merchant_category
CATEGORY_BY_EVENT = {
    "click": "grocery",
    "view": "restaurant",
    "purchase": "retail",
    "signup": "online",
    "error": "travel",
}
# user_id % 10 -> country
COUNTRY_BY_DIGIT = ["US", "GB", "CA", "DE", "FR", "AU", "SG", "JP", "BR", "MX"]
# country -> first city (lat, lon)
CITY_BY_COUNTRY = {
    "US": (40.71, -74.01),
    "GB": (51.51, -0.13),
    "CA": (43.65, -79.38),
    "DE": (52.52, 13.40),
    "FR": (48.85, 2.35),
    "AU": (-33.87, 151.21),
    "SG": (1.35, 103.82),
    "JP": (35.68, 139.69),
    "BR": (-23.55, -46.63),
    "MX": (19.43, -99.13),
}
MERCHANT_COUNT = 200
SPIKE_LABEL_MIN_VALUE = 200.0
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _padded(prefix: str, n: Column, width: int) -> Column:
    # lpad truncates longer numbers; keep the full digits past the width so
    # that ids stay unique on large data
    digits = n.cast("string")
    return F.concat(
        F.lit(prefix),
        F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits),
    )


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Map an ``events`` DataFrame to the 11-column transaction record."""
    h = F.pmod(F.col("user_id"), F.lit(10))
    etype = F.col("event_type")
    tv = (etype == "error") & (F.pmod(F.col("event_id"), F.lit(5)) == 0)

    cat_map = F.create_map(*[F.lit(x) for kv in CATEGORY_BY_EVENT.items() for x in kv])
    digit_country = F.array(*[F.lit(c) for c in COUNTRY_BY_DIGIT])
    lat_map = F.create_map(*[F.lit(x) for c, (la, _) in CITY_BY_COUNTRY.items() for x in (c, la)])
    lon_map = F.create_map(*[F.lit(x) for c, (_, lo) in CITY_BY_COUNTRY.items() for x in (c, lo)])

    country = (
        F.when(etype == "signup", F.lit("US"))
        .when(tv, F.when(h == 7, F.lit("BR")).otherwise(F.lit("JP")))
        .otherwise(F.element_at(digit_country, (h + 1).cast("int")))
    )
    fraud_type = (
        F.when(tv, F.lit("impossible_travel"))
        .when((etype == "purchase") & (F.col("value") >= SPIKE_LABEL_MIN_VALUE), F.lit("amount_spike"))
        .otherwise(F.lit(None).cast("string"))
    )
    online = etype == "signup"
    return events.select(
        _padded("TXN-", F.col("event_id"), 10).alias("transaction_id"),
        _padded("CARD-", F.col("user_id"), 4).alias("card_id"),
        F.col("value").cast("double").alias("amount"),
        _padded("MERCH-", F.pmod(F.col("event_id"), F.lit(MERCHANT_COUNT)), 4).alias("merchant_id"),
        F.try_element_at(cat_map, etype).alias("merchant_category"),
        F.when(online, F.lit(0.0)).otherwise(F.try_element_at(lat_map, country)).cast("double").alias("lat"),
        F.when(online, F.lit(0.0)).otherwise(F.try_element_at(lon_map, country)).cast("double").alias("lon"),
        F.date_format(F.col("ts"), ISO_FORMAT).alias("timestamp"),
        country.alias("country"),
        fraud_type.isNotNull().alias("is_fraud"),
        fraud_type.alias("fraud_type"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions (bronze layout without ingest times) for a test-data folder."""
    return transactions_from_events(read_events(spark, sf_dir))


def replayed(events: DataFrame) -> DataFrame:
    """Events plus an exact second copy of every tenth event (dedup fixture)."""
    return events.unionByName(events.filter(F.pmod(F.col("event_id"), F.lit(10)) == 0))


def dirtied(txns: DataFrame) -> DataFrame:
    """Transactions with bad amounts and bad timestamps (validation fixture).

    Rows whose numeric id is 0 mod 50 get amount -1, 1 mod 50 get timestamp
    ``junk``.
    """
    n = F.substring(F.col("transaction_id"), 5, 64).cast("long")
    return txns.withColumn(
        "amount", F.when(F.pmod(n, F.lit(50)) == 0, F.lit(-1.0)).otherwise(F.col("amount"))
    ).withColumn(
        "timestamp", F.when(F.pmod(n, F.lit(50)) == 1, F.lit("junk")).otherwise(F.col("timestamp"))
    )
