"""Silver layer: event time, validation, quarantine and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.functions.columns import event_time

NOT_FINITE = ("nan_amount", "infinite_amount")


def rules() -> list[tuple[str, Column]]:
    """Ordered rule list: the first failing rule names the reject reason."""
    return [
        ("missing_transaction_id", F.col("transaction_id").isNull()),
        ("missing_card_id", F.col("card_id").isNull()),
        ("missing_amount", F.col("amount").isNull()),
        ("nan_amount", F.isnan(F.col("amount"))),
        ("infinite_amount", F.abs(F.col("amount")) == F.lit(float("inf"))),
        ("non_positive_amount", F.col("amount") <= 0),
        ("bad_event_time", F.col("event_time").isNull()),
    ]


def with_event_time(df: DataFrame, src: str = "timestamp", dst: str = "event_time") -> DataFrame:
    """Parse the ISO text into a timestamp column (NULL when unparseable)."""
    return df.withColumn(dst, event_time(src))


def valid_predicate(reject_nan: bool = True) -> Column:
    """Keep iff no rule of ``rules()`` fails.

    NaN and infinity pass ``amount > 0`` in Spark; they are rejected unless
    ``reject_nan`` is False (reference-compatible).
    """
    ok = F.lit(True)
    for name, failed in rules():
        if reject_nan or name not in NOT_FINITE:
            ok = ok & ~failed
    return ok


def reject_reason(reject_nan: bool = True) -> Column:
    expr = None
    for name, failed in rules():
        if name in NOT_FINITE and not reject_nan:
            continue
        expr = (F.when if expr is None else expr.when)(failed, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def validate(df: DataFrame, reject_nan: bool = True) -> DataFrame:
    """Rows that pass all rules (the filter reaches the scan when it can)."""
    if "event_time" not in df.columns:
        df = with_event_time(df)
    return df.filter(valid_predicate(reject_nan))


def with_reject_reason(df: DataFrame, reject_nan: bool = True) -> DataFrame:
    if "event_time" not in df.columns:
        df = with_event_time(df)
    reason = reject_reason(reject_nan)
    if "raw_value" in df.columns:  # bronze keeps the message: one that is no JSON is told from one without an id
        no_json = reason.isNotNull() & F.col("raw_value").isNotNull() & F.try_parse_json("raw_value").isNull()
        reason = F.when(no_json, F.lit("undecodable_message")).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def rejects(df: DataFrame, reject_nan: bool = True) -> DataFrame:
    """Quarantine branch: failing rows with the first failing rule's name."""
    return with_reject_reason(df, reject_nan).filter(F.col("reject_reason").isNotNull())


def dedup(df: DataFrame, keys: tuple[str, ...] = ("transaction_id", "event_time")) -> DataFrame:
    """Drop repeats of the key.  On a stream with a watermark the state is
    bounded by the watermark; in batch it is one hash aggregation."""
    return df.dropDuplicates(list(keys))


def silver(
    df: DataFrame,
    watermark: str | None = S.WATERMARK_DELAY,
    keys: tuple[str, ...] = ("transaction_id", "event_time"),
    reject_nan: bool = True,
    within_watermark: bool = False,
) -> DataFrame:
    """bronze -> silver: parse, watermark (streams), validate, de-duplicate.

    ``within_watermark=True`` de-duplicates on ``transaction_id`` alone for
    replays that change the timestamp (streams only).
    """
    out = with_event_time(df)
    if watermark and df.isStreaming:
        out = out.withWatermark("event_time", watermark)
    out = out.filter(valid_predicate(reject_nan))
    if within_watermark and df.isStreaming:
        return out.dropDuplicatesWithinWatermark(["transaction_id"])
    return dedup(out, keys)
