"""Exploratory batch reports over the layers (A2..A8, A10, K2, S13).

All are partial + final hash aggregations or top-k (TakeOrderedAndProject);
top-k lists carry a unique tie-break so that the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.functions.columns import money_avg, pct, to_ntz, zscore_bucket, zscore_bucket_ord
from cardwatch.operators.cleanse import valid_predicate, with_event_time


#: Measures of the reports by name: (aggregate, digits to round to).  Output names are part of the reports' contract.
MEASURES = {
    "count": (F.count, "*", None), "flagged_events": (F.count, "*", None), "total_events": (F.count, "*", None),
    "fraud_events": (F.count_if, "is_fraud", None), "avg_score": (F.avg, "fraud_score", 3), "peak_score": (F.max, "fraud_score", 3),
    "avg_amount": (money_avg, "amount", 2), "max_amount": (F.max, "amount", 2), "avg_velocity": (F.avg, "velocity_60m", 1),
}


def report(rows: DataFrame, by: tuple[str, ...], measures: tuple[str, ...], rank: str, k: int | None = None) -> DataFrame:
    """Named measures per group, the greatest ``rank`` first and ties by the group (unique, NULL first); the first ``k`` if given,
    as a top-k per task before they meet."""
    def measure(name: str):
        how, of, digits = MEASURES[name]
        return (how(of) if digits is None else F.round(how(of), digits)).alias(name)

    out = rows.groupBy(*by).agg(*map(measure, measures)).orderBy(F.desc(rank), *map(F.asc_nulls_first, by))
    return out if k is None else out.limit(k)


def fraud_by_type(gold: DataFrame) -> DataFrame:
    """A2: per label (NULL is a group): count, mean score, mean / max amount."""
    return report(gold, ("fraud_type",), ("count", "avg_score", "avg_amount", "max_amount"), "count")


def top_risk_cards(gold: DataFrame, k: int = 20, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """A3: alerted (card, label) pairs, top ``k`` by peak score."""
    alerted = gold.filter(F.col("fraud_score") >= threshold)
    return report(alerted, ("card_id", "fraud_type"), ("flagged_events", "peak_score", "max_amount", "avg_velocity"), "peak_score", k)


def zscore_distribution(gold: DataFrame) -> DataFrame:
    """A4: rows per (z bucket, label); ``bucket_ord`` gives numeric order."""
    return (
        gold.select(
            zscore_bucket("amount_zscore").alias("zscore_bucket"),
            zscore_bucket_ord("amount_zscore").alias("bucket_ord"),
            "is_fraud",
        )
        .groupBy("zscore_bucket", "bucket_ord", "is_fraud")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("zscore_bucket", "is_fraud")
    )


def fraud_by_country(gold: DataFrame) -> DataFrame:
    """A5: events, fraud events and fraud rate % per country."""
    return report(gold, ("country",), ("total_events", "fraud_events"), "total_events").withColumn(
        "fraud_rate_pct", pct("fraud_events", "total_events", 2))


def layer_summary(bronze: DataFrame, silver: DataFrame, gold: DataFrame,
                  threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """One row of layer counts; one aggregation pass per layer, the three
    one-row results meet in a union and a final global aggregation."""
    b = bronze.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bronze").alias("layer"), "n")
    s = silver.agg(F.count(F.lit(1)).alias("n")).select(F.lit("silver").alias("layer"), "n")
    g = gold.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("fraud_score") >= threshold).alias("h")
    )
    g = g.select(F.lit("gold").alias("layer"), "n").unionByName(
        g.select(F.lit("high").alias("layer"), F.col("h").alias("n"))
    )
    rows = b.unionByName(s).unionByName(g)

    def pick(name):
        return F.sum(F.when(F.col("layer") == name, F.col("n"))).cast("long")

    return rows.agg(
        F.coalesce(pick("bronze"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(pick("silver"), F.lit(0)).alias("silver_rows"),
        F.coalesce(pick("gold"), F.lit(0)).alias("gold_rows"),
        F.coalesce(pick("high"), F.lit(0)).alias("high_confidence"),
    ).select(
        "*",
        (F.col("bronze_rows") - F.col("silver_rows")).alias("dropped"),
        pct("high_confidence", "gold_rows", 2).alias("high_pct"),
    )


def fraud_rate(txns: DataFrame) -> DataFrame:
    """Labelled fraud share of a batch."""
    return txns.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("is_fraud")).alias("fraud_events"),
        F.round(F.avg(F.col("is_fraud").cast("int")), 6).alias("fraud_rate"),
    )


def silver_drop_rate(bronze: DataFrame, reject_nan: bool = True) -> DataFrame:
    """Bronze -> silver losses split into invalid rows and duplicates.

    Two aggregation levels: distinct (id, time) of the valid rows, then one
    global aggregation; no driver arithmetic.
    """
    b = with_event_time(bronze).withColumn("_valid", valid_predicate(reject_nan))
    per_key = (
        b.groupBy("transaction_id", "event_time", "_valid")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return per_key.agg(
        F.sum("_n").cast("long").alias("bronze_rows"),
        F.coalesce(F.sum(F.when(~F.col("_valid"), F.col("_n"))), F.lit(0)).cast("long").alias("invalid_rows"),
        F.coalesce(F.sum(F.when(F.col("_valid"), F.col("_n") - 1)), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count_if(F.col("_valid")).alias("silver_rows"),
    ).select(
        "*",
        pct(F.col("bronze_rows") - F.col("silver_rows"), "bronze_rows", 2).alias("drop_rate_pct"),
    )


def alert_confusion(gold: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """A10: per label, rows, alerted rows and mean score (labels vs alerts)."""
    return (
        gold.groupBy(F.coalesce(F.col("fraud_type"), F.lit("none")).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("fraud_score") >= threshold).alias("alerted"),
            F.round(F.avg("fraud_score"), 6).alias("avg_score"),
        )
        .withColumn("alert_rate_pct", pct("alerted", "events", 2))
    )


def alert_precision(gold: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """A10: overall confusion counts, precision and recall of the alerts."""
    alert = F.col("fraud_score") >= threshold
    fraud = F.coalesce(F.col("is_fraud"), F.lit(False))
    return gold.agg(
        F.count_if(alert & fraud).alias("true_pos"),
        F.count_if(alert & ~fraud).alias("false_pos"),
        F.count_if(~alert & fraud).alias("false_neg"),
        F.count_if(~alert & ~fraud).alias("true_neg"),
    ).select(
        "*",
        F.round(F.try_divide(F.col("true_pos").cast("double"), F.col("true_pos") + F.col("false_pos")), 6).alias("precision"),
        F.round(F.try_divide(F.col("true_pos").cast("double"), F.col("true_pos") + F.col("false_neg")), 6).alias("recall"),
    )


def top_scores(gold: DataFrame, k: int = 20) -> DataFrame:
    """K2: the ``k`` highest scores; ties broken by transaction id."""
    return (
        gold.select(
            "transaction_id", "card_id", "fraud_type", "amount", "velocity_60m",
            F.round("amount_zscore", 6).alias("amount_zscore"),
            F.round("fraud_score", 6).alias("fraud_score"),
            "country", "timestamp",
        )
        .orderBy(F.col("fraud_score").desc(), F.col("transaction_id"))
        .limit(k)
    )


def recent_fraud(txns: DataFrame, k: int = 20) -> DataFrame:
    """Newest ``k`` labelled fraud rows."""
    return (
        txns.filter(F.col("is_fraud"))
        .select("transaction_id", "card_id", "amount", "fraud_type", "timestamp")
        .orderBy(F.col("timestamp").desc(), F.col("transaction_id"))
        .limit(k)
    )


def recent_silver(silver: DataFrame, k: int = 10) -> DataFrame:
    """Newest ``k`` silver rows."""
    return (
        silver.select(
            "transaction_id", "card_id", "amount", "merchant_id", "country", "fraud_type",
            to_ntz("event_time").alias("event_time"),
        )
        .orderBy(F.col("event_time").desc(), F.col("transaction_id"))
        .limit(k)
    )
