"""Bronze layer: message envelopes <-> transaction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S


def to_envelope(
    txns: DataFrame,
    topic: str = "transactions",
    partitions: int = 3,
    time_col: str | None = None,
    offset_col: str | None = None,
) -> DataFrame:
    """Encode transactions as message-log rows (the shape of a Kafka source).

    key = card id (so one card stays in one log partition), value = JSON of
    the 11 fields.  ``time_col`` / ``offset_col`` name columns of ``txns`` to
    use as message time / offset; otherwise the parsed event time and
    NULL are used.
    """
    ts = F.col(time_col) if time_col else F.try_to_timestamp(F.col("timestamp"))
    off = F.col(offset_col).cast("long") if offset_col else F.lit(None).cast("long")
    return txns.select(
        F.col("card_id").cast("binary").alias("key"),
        F.to_json(F.struct(*S.TRANSACTION_COLUMNS)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(F.col("card_id")), F.lit(partitions)).cast("int").alias("partition"),
        off.alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def decode_envelope(env: DataFrame, keep_raw: bool = False) -> DataFrame:
    """``from_json(value)`` into the 11 fields + ingest times.

    PERMISSIVE parsing: malformed JSON gives an all-NULL row, a wrong-typed
    field gives NULL for that field, unknown fields are ignored.  With
    ``keep_raw`` the raw text and log coordinates are kept for quarantine.
    Works on batch and streaming DataFrames alike.
    """
    raw = F.col("value").cast("string")
    extra = []
    if keep_raw:
        extra = [raw.alias("raw_value"), "topic", "partition", "offset"]
    return env.select(
        F.from_json(raw, S.TRANSACTION_SCHEMA).alias("d"),
        F.col("timestamp").alias("kafka_ingest_time"),
        *extra,
    ).select("d.*", "kafka_ingest_time", F.current_timestamp().alias("bronze_ingest_time"),
             *[c if isinstance(c, str) else "raw_value" for c in extra])


def ingest_batch(txns: DataFrame) -> DataFrame:
    """Typed transaction rows -> bronze layout (ingest times NULL)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRANSACTION_SCHEMA.fields]
    return txns.select(
        *cols,
        F.lit(None).cast("timestamp").alias("kafka_ingest_time"),
        F.lit(None).cast("timestamp").alias("bronze_ingest_time"),
    )
