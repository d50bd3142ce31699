"""Record schemas and fixed constants of the fraud pipeline.

Every threshold is also a keyword parameter of the operator that uses it;
the values here are the production defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values (must equal the reference for equal results) ------------------
# transaction record, field order as published
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("card_id", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lon", T.DoubleType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("is_fraud", T.BooleanType(), True),
        T.StructField("fraud_type", T.StringType(), True),
    ]
)
TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]

# message-log envelope (the shape a Kafka source produces)
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

# bronze = transaction + two ingest times (nullable: batch ingest has none)
BRONZE_SCHEMA = T.StructType(
    TRANSACTION_SCHEMA.fields
    + [
        T.StructField("kafka_ingest_time", T.TimestampType(), True),
        T.StructField("bronze_ingest_time", T.TimestampType(), True),
    ]
)

# raw message coordinates kept in bronze by the stream job (quarantine / replay)
RAW_FIELDS = [
    T.StructField("raw_value", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
]
BRONZE_RAW_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + RAW_FIELDS)

# silver = bronze + parsed event time
SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields + [T.StructField("event_time", T.TimestampType(), True)]
)

# scoring constants
VELOCITY_THRESHOLD = 8          # velocity flag: count >= 8
ALERT_THRESHOLD = 0.70          # alert: fraud_score >= 0.70
VELOCITY_WEIGHT = 0.40
ZSCORE_WEIGHT = 0.40
GEO_WEIGHT = 0.20
ZSCORE_CAP = 5.0
IMPOSSIBLE_TRAVEL = "impossible_travel"
UNKNOWN_FRAUD_TYPE = "unknown"

# detector constants
EARTH_RADIUS_KM = 6371.0
TRAVEL_MIN_KM = 2000.0
TRAVEL_MAX_GAP_S = 300          # 5 minutes
BURST_WINDOW_S = 60             # burst: 8+ transactions within 60 s
BURST_MIN_COUNT = 8
SPIKE_MIN_AMOUNT = 500.0
SPIKE_SIGMAS = 3.0
SPIKE_MIN_PRIOR = 2

# streaming constants
WATERMARK_DELAY = "10 minutes"
MAX_OFFSETS_PER_TRIGGER = 10_000
TRIGGERS = {"bronze": "10 seconds", "silver": "15 seconds", "gold": "30 seconds"}

# dashboard thresholds: events/min red < 500 <= yellow < 800 <= green
RATE_PER_MIN_BANDS = (500, 800)
# fraud rate %: green < 3 <= yellow < 10 <= red
FRAUD_RATE_BANDS = (3.0, 10.0)
# events/s: red < 10 <= yellow < 15 <= green < 30 <= yellow < 100 <= red
RATE_PER_SEC_BANDS = (10, 15, 30, 100)

# z-score bucket labels, in threshold order
ZSCORE_BUCKETS = [(-1, "< -1"), (0, "-1 to 0"), (1, "0 to 1"), (2, "1 to 2"), (3, "2 to 3")]
ZSCORE_TOP_BUCKET = "> 3"
