"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query starts from the test tables (``events`` through the adapter) so
its work grows with the data.  Oracle-facing outputs round doubles (6 dp
unless the report itself rounds) and return ``timestamp_ntz``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.columns import to_ntz
from cardwatch.operators import cleanse, explore, score
from cardwatch.session import scratch_path
from cardwatch.sources import envelope
from cardwatch.sources.events_adapter import dirtied, load_transactions, read_events, replayed, transactions_from_events

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# layers over the test tables --------------------------------------------------

def bronze_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.ingest_batch(load_transactions(spark, sf_dir))


#: What scoring reads besides a report's own columns.
SCORED = ("transaction_id", "card_id", "timestamp", "event_time", "amount", "fraud_type")


def silver_of(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Silver rows as a plan.  With ``columns``, as a table of just these
    columns, written once as Parquet into the shared checkpoint folder (as the
    silver job's table would be), for plans that read silver in several branches;
    otherwise each branch would repeat the de-duplication shuffle."""
    s = cleanse.silver(load_transactions(spark, sf_dir))
    if not columns:
        return s
    s = s.select(*columns)
    path = scratch_path(spark, f"silver-{uuid.uuid4().hex}")
    s.write.parquet(path)
    return spark.read.schema(s.schema).parquet(path)


def gold_of(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    silver = silver_of(spark, sf_dir, *dict.fromkeys([*SCORED, *extra]))
    return score.score_batch(silver, processed_at=False)


def dirty_bronze_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed + dirtied transactions (for validation / dedup queries)."""
    return dirtied(transactions_from_events(replayed(read_events(spark, sf_dir))))


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


# minimum slice: score + alerts ------------------------------------------------

def scored_view(gold: DataFrame) -> DataFrame:
    return gold.select(
        "transaction_id", "card_id", to_ntz("event_time").alias("event_time"), "amount",
        "velocity_60m", r6("amount_zscore"), "velocity_flag",
        "geo_anomaly_flag", r6("fraud_score"),
        (F.col("fraud_score") >= 0.70).alias("is_alert"),
    )


@register("fraud_score")
def q_fraud_score(spark, sf_dir):
    return scored_view(gold_of(spark, sf_dir))


@register("alerts")
def q_alerts(spark, sf_dir):
    return score.alert_records(gold_of(spark, sf_dir, "merchant_category", "country"))


@register("alerts_payload")
def q_alerts_payload(spark, sf_dir):
    return score.alert_payload(gold_of(spark, sf_dir, "merchant_category", "country"))


@register("card_stats")
def q_card_stats(spark, sf_dir):
    return score.card_stats_report(silver_of(spark, sf_dir))


@register("card_zscore")
def q_card_zscore(spark, sf_dir):
    return gold_of(spark, sf_dir).select("transaction_id", "card_id", r6("amount_zscore"))


@register("card_stats_join")
def q_card_stats_join(spark, sf_dir):
    """J1 with a low hot-card bound so the salted path runs on test data."""
    g = score.score_batch(silver_of(spark, sf_dir, *SCORED), processed_at=False,
                          min_hot_rows=50, max_hot_keys=8, fan_out=4)
    return g.select("transaction_id", "card_id", "velocity_60m", r6("amount_zscore"))


# bronze / silver ---------------------------------------------------------------

@register("bronze_decode")
def q_bronze_decode(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    env = envelope.to_envelope(transactions_from_events(ev))
    b = envelope.decode_envelope(env)
    return b.drop("bronze_ingest_time").withColumn("kafka_ingest_time", to_ntz("kafka_ingest_time"))


@register("bronze_batch_ingest")
def q_bronze_batch_ingest(spark, sf_dir):
    return bronze_of(spark, sf_dir).drop("kafka_ingest_time", "bronze_ingest_time")


@register("event_time_parse")
def q_event_time_parse(spark, sf_dir):
    b = cleanse.with_event_time(dirty_bronze_of(spark, sf_dir))
    return b.select("transaction_id", "timestamp", to_ntz("event_time").alias("event_time"))


@register("silver_validate")
def q_silver_validate(spark, sf_dir):
    s = cleanse.validate(dirty_bronze_of(spark, sf_dir))
    return s.select("transaction_id", "card_id", "amount", to_ntz("event_time").alias("event_time"))


@register("silver_rejects")
def q_silver_rejects(spark, sf_dir):
    r = cleanse.rejects(dirty_bronze_of(spark, sf_dir))
    return r.select("transaction_id", "amount", "timestamp", "reject_reason")


@register("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    s = cleanse.silver(dirty_bronze_of(spark, sf_dir))
    return s.select("transaction_id", "card_id", "amount", to_ntz("event_time").alias("event_time"))


@register("silver_drop_rate")
def q_silver_drop_rate(spark, sf_dir):
    return explore.silver_drop_rate(dirty_bronze_of(spark, sf_dir))


# exploration -----------------------------------------------------------------

@register("fraud_by_type")
def q_fraud_by_type(spark, sf_dir):
    return explore.fraud_by_type(gold_of(spark, sf_dir))


@register("top_risk_cards")
def q_top_risk_cards(spark, sf_dir):
    return explore.top_risk_cards(gold_of(spark, sf_dir))


@register("zscore_distribution")
def q_zscore_distribution(spark, sf_dir):
    return explore.zscore_distribution(gold_of(spark, sf_dir, "is_fraud"))


@register("fraud_by_country")
def q_fraud_by_country(spark, sf_dir):
    return explore.fraud_by_country(silver_of(spark, sf_dir))


@register("layer_summary")
def q_layer_summary(spark, sf_dir):
    silver = silver_of(spark, sf_dir, *SCORED)
    gold = score.score_batch(silver, processed_at=False)
    return explore.layer_summary(bronze_of(spark, sf_dir), silver, gold)


@register("fraud_rate")
def q_fraud_rate(spark, sf_dir):
    return explore.fraud_rate(load_transactions(spark, sf_dir))


@register("alert_confusion")
def q_alert_confusion(spark, sf_dir):
    return explore.alert_confusion(gold_of(spark, sf_dir, "is_fraud"))


@register("alert_precision")
def q_alert_precision(spark, sf_dir):
    return explore.alert_precision(gold_of(spark, sf_dir, "is_fraud"))


@register("top_scores")
def q_top_scores(spark, sf_dir):
    return explore.top_scores(gold_of(spark, sf_dir, "country"))


@register("recent_fraud")
def q_recent_fraud(spark, sf_dir):
    return explore.recent_fraud(load_transactions(spark, sf_dir))


@register("recent_silver")
def q_recent_silver(spark, sf_dir):
    return explore.recent_silver(silver_of(spark, sf_dir))


# sequence detectors and profiles ----------------------------------------------
# Production thresholds find (almost) nothing on the sparse test events, so
# the production defaults are registered where they give a non-empty result.

from cardwatch.functions.columns import has_location  # noqa: E402
from cardwatch.operators import detect, profile  # noqa: E402


#: What the location and sequence detectors read.
LOCATED = ("transaction_id", "card_id", "event_time", "country", "lat", "lon")
TIMED = ("transaction_id", "card_id", "event_time")
#: Rows of a segment in the queries that cut busy cards also on the test tables.
FEW_SEGMENT_ROWS = 40


def _et(c: str = "event_time"):
    return to_ntz(c).alias(c)


@register("velocity_rolling")
def q_velocity_rolling(spark, sf_dir):
    """W1 with a 24 h window, flag at >= 8."""
    v = detect.velocity(silver_of(spark, sf_dir, *TIMED), window_s=86400, threshold=8)
    return v.select("transaction_id", "card_id", _et(), "velocity", "velocity_flag")


@register("velocity_60s")
def q_velocity_60s(spark, sf_dir):
    """W1 with the production 60 s burst window."""
    v = detect.velocity(silver_of(spark, sf_dir, *TIMED))
    return v.select("transaction_id", "card_id", _et(), "velocity", "velocity_flag")


def _travel_view(t):
    return t.filter("travel_flag").select(
        "transaction_id", "card_id", _et(), "country", "prev_transaction_id", "prev_country",
        F.round("distance_km", 3).alias("distance_km"), "gap_s",
    )


@register("impossible_travel")
def q_impossible_travel(spark, sf_dir):
    """W2 with a 1 h gap bound (test constant), 2000 km."""
    return _travel_view(detect.impossible_travel(silver_of(spark, sf_dir, *LOCATED), max_gap_s=3600))


@register("impossible_travel_5m")
def q_impossible_travel_5m(spark, sf_dir):
    """W2 with the production 5 min / 2000 km rule."""
    return _travel_view(detect.impossible_travel(silver_of(spark, sf_dir, *LOCATED)))


@register("haversine")
def q_haversine(spark, sf_dir):
    """Distance of each located transaction from the card's previous
    located transaction."""
    t = detect.impossible_travel(silver_of(spark, sf_dir, *LOCATED))
    return t.filter(F.col("prev_transaction_id").isNotNull() & has_location("lat", "lon")).select("transaction_id", "prev_transaction_id", F.round("distance_km", 3).alias("distance_km"))


@register("burst_sessions")
def q_burst_sessions(spark, sf_dir):
    """W3 with a 2 h gap and >= 4 transactions (test constants)."""
    s = detect.burst_sessions(silver_of(spark, sf_dir, "transaction_id", "card_id", "event_time", "amount"), gap_s=7200, min_count=4)
    return s.select("card_id", _et("session_start"), _et("session_end"), "n_txn", "total_amount")


@register("amount_spike")
def q_amount_spike(spark, sf_dir):
    """W4 with a 200 floor (test constant), mean + 3 sd of >= 2 prior rows."""
    s = detect.amount_spike(silver_of(spark, sf_dir, "transaction_id", "card_id", "event_time", "amount"), min_amount=200.0)
    return s.filter("spike_flag").select(
        "transaction_id", "card_id", _et(), "amount", "prior_n",
        F.round("prior_mean", 2).alias("prior_mean"), F.round("prior_std", 2).alias("prior_std"),
    )


@register("fraud_score_event_time")
def q_fraud_score_event_time(spark, sf_dir):
    """W5 with production constants (60 min velocity, 5 min / 2000 km travel)."""
    g = detect.score_event_time(silver_of(spark, sf_dir, *LOCATED, "amount"))
    return g.select(
        "transaction_id", "card_id", _et(), "velocity_60m", r6("amount_zscore"), "velocity_flag",
        "geo_anomaly_flag", r6("fraud_score"), (F.col("fraud_score") >= 0.70).alias("is_alert"),
    )


@register("fraud_score_segmented")
def q_fraud_score_segmented(spark, sf_dir):
    """W5 as ``fraud_score_event_time``, with each card's rows cut into segments of about ``FEW_SEGMENT_ROWS``."""
    g = detect.score_event_time(silver_of(spark, sf_dir, *LOCATED, "amount"), segment_rows=FEW_SEGMENT_ROWS)
    return g.select(
        "transaction_id", "card_id", _et(), "velocity_60m", r6("amount_zscore"), "velocity_flag",
        "geo_anomaly_flag", r6("fraud_score"), (F.col("fraud_score") >= 0.70).alias("is_alert"),
    )


@register("card_profile")
def q_card_profile(spark, sf_dir):
    p = profile.card_profile(silver_of(spark, sf_dir, *LOCATED, "amount"))
    return p.select("card_id", "n_txn", "typical_spend_low", "typical_spend_high", "home_country",
                    _et("first_seen"), _et("last_seen"))


@register("merchant_enrich")
def q_merchant_enrich(spark, sf_dir):
    s = silver_of(spark, sf_dir, "transaction_id", "merchant_id", "merchant_category", "country")
    e = profile.merchant_enrich(s, profile.merchant_dim(s))
    return e.select("transaction_id", "merchant_id", "merchant_category", "merchant_home_category",
                    "merchant_home_country")


@register("prev_txn")
def q_prev_txn(spark, sf_dir):
    p = profile.prev_txn(silver_of(spark, sf_dir, *LOCATED))
    return p.select("transaction_id", "card_id", _et(), "prev_transaction_id", _et("prev_event_time"),
                    "prev_country", "prev_lat", "prev_lon")


@register("foreign_txn")
def q_foreign_txn(spark, sf_dir):
    s = silver_of(spark, sf_dir, *LOCATED, "amount", "timestamp")
    f = profile.foreign_txn(s, profile.card_profile(s), min_hot_rows=50, max_hot_keys=8, fan_out=4)
    return f.select("transaction_id", "card_id", "country", "home_country", "is_foreign")


# event-time metrics -------------------------------------------------------------

from cardwatch.operators import metrics  # noqa: E402


@register("events_per_minute")
def q_events_per_minute(spark, sf_dir):
    return metrics.events_per_minute(silver_of(spark, sf_dir))


@register("fraud_rate_rolling")
def q_fraud_rate_rolling(spark, sf_dir):
    m = metrics.fraud_rate_rolling(silver_of(spark, sf_dir))
    return m.withColumn("fraud_rate_pct", F.round("fraud_rate_pct", 6))


@register("events_per_second")
def q_events_per_second(spark, sf_dir):
    return metrics.events_per_second(silver_of(spark, sf_dir))


@register("cumulative_events")
def q_cumulative_events(spark, sf_dir):
    return metrics.cumulative_events(silver_of(spark, sf_dir))


@register("health_status")
def q_health_status(spark, sf_dir):
    m = metrics.health_status(silver_of(spark, sf_dir, "event_time", "is_fraud"))
    return m.withColumn("fraud_rate_pct", F.round("fraud_rate_pct", 6))


@register("per_second_status")
def q_per_second_status(spark, sf_dir):
    return metrics.per_second_status(silver_of(spark, sf_dir))


@register("layer_lag")
def q_layer_lag(spark, sf_dir):
    """T9, both stages, on a decoded envelope of the events.  The arrival times
    are derived from the amount, so that the lags are known."""
    env = envelope.to_envelope(load_transactions(spark, sf_dir))
    cents = F.round(F.col("amount") * 100).cast("long")
    after = lambda c, ms: F.timestamp_micros(F.unix_micros(c) + cents % ms * 1000)
    bronze = envelope.decode_envelope(env).withColumn("bronze_ingest_time", after("kafka_ingest_time", 5000))
    gold = cleanse.with_event_time(bronze).withColumn("gold_processed_at", after("event_time", 30011))
    return metrics.layer_lag(bronze, gold, accuracy=1_000_000)


# streaming jobs ------------------------------------------------------------------

from cardwatch.sources.layers import LayerPaths, read_table  # noqa: E402
from cardwatch.streaming import jobs  # noqa: E402


#: Files that a slice of a replay is written as, and a micro-batch reads.
FILES_PER_SLICE = 4


def run_stream_pipeline(spark: SparkSession, sf_dir: str, n_slices: int = 4) -> jobs.StreamConfig:
    """Replay the events as envelope files through bronze -> silver -> gold
    with ``availableNow``: bronze and silver take one slice per micro-batch
    (watermark advances between batches), gold drains silver in one batch."""
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    src = f"{base}/source"
    files = jobs.write_envelope_files(load_transactions(spark, sf_dir), src, n_slices)
    cfg = jobs.StreamConfig(paths=LayerPaths(base), source_format="parquet", source_path=src,
                            max_files_per_trigger=files, available_now=True)
    for q in [jobs.run_bronze(spark, cfg)]:
        q.awaitTermination()
    for q in jobs.run_silver(spark, cfg):
        q.awaitTermination()
    cfg.max_files_per_trigger = None
    jobs.run_gold(spark, cfg).awaitTermination()
    return cfg


@register("silver_stream")
def q_silver_stream(spark, sf_dir):
    """T1 + S5 on a stream: decode, validate, watermark dedup, append."""
    cfg = run_stream_pipeline(spark, sf_dir)
    s = read_table(spark, cfg.paths.silver)
    return s.select("transaction_id", "card_id", "amount", _et())


@register("gold_stream")
def q_gold_stream(spark, sf_dir):
    """T2 + S6 on a stream (one gold micro-batch)."""
    cfg = run_stream_pipeline(spark, sf_dir)
    return _gold_view(read_table(spark, cfg.paths.gold))


def _gold_view(g):
    return g.select("transaction_id", "card_id", _et(), "velocity_60m", r6("amount_zscore"),
                    "velocity_flag", "geo_anomaly_flag", r6("fraud_score"), "batch_id")


@register("gold_replay_idempotent")
def q_gold_replay_idempotent(spark, sf_dir):
    """The gold batch is processed again with the same batch id (a retry);
    the table must hold each row once."""
    cfg = run_stream_pipeline(spark, sf_dir)
    silver = read_table(spark, cfg.paths.silver)
    jobs.process_gold_batch(silver, 0, cfg)
    return _gold_view(read_table(spark, cfg.paths.gold))


@register("batch_audit")
def q_batch_audit(spark, sf_dir):
    """Per-batch audit rows written by the gold job."""
    cfg = run_stream_pipeline(spark, sf_dir)
    return read_table(spark, cfg.paths.audit).select("batch_id", "rows_in", "alerts", "alert_pct")


@register("alerts_stream")
def q_alerts_stream(spark, sf_dir):
    """S8 from the gold job: JSON alert files keyed by transaction id."""
    cfg = run_stream_pipeline(spark, sf_dir)
    return read_table(spark, cfg.paths.alerts, "json").select("key", "value")


@register("velocity_stateful")
def q_velocity_stateful(spark, sf_dir):
    """Keyed-state trailing count (24 h, as velocity_rolling) over an
    in-order replay of the events in 8 micro-batches."""
    from cardwatch.streaming.stateful import velocity_stateful

    base = scratch_path(spark, f"stateful-{uuid.uuid4().hex[:12]}")
    src = f"{base}/source"
    files = jobs.write_envelope_files(load_transactions(spark, sf_dir), src, 8)
    cfg = jobs.StreamConfig(paths=LayerPaths(base), source_format="parquet", source_path=src,
                            max_files_per_trigger=files, available_now=True)
    silver = cleanse.silver(envelope.decode_envelope(jobs.message_source(spark, cfg)))
    v = velocity_stateful(silver, window_s=86400, watermark=None)
    q = (v.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{base}/checkpoints/velocity")
         .trigger(availableNow=True).start(f"{base}/velocity"))
    q.awaitTermination()
    out = read_table(spark, f"{base}/velocity")
    return out.select("transaction_id", "card_id", _et(), "velocity",
                      (F.col("velocity") >= 8).alias("velocity_flag"), "travel_flag")


# stream forms of the event-time operators ------------------------------------------

def _silver_stream(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The silver rows as a stream over a table written for it."""
    path = scratch_path(spark, f"silver-{uuid.uuid4().hex}")
    silver = cleanse.silver(load_transactions(spark, sf_dir)).select(*columns)
    silver.write.parquet(path)
    return spark.readStream.schema(silver.schema).parquet(path)


def _drained(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """The table that a stream's micro-batches leave: the last of ``complete``
    mode, or all updates with their ``batch_id``."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    out = f"{base}/out"
    spark.createDataFrame([], stream.schema).withColumn("batch_id", F.lit(0).cast("long")).write.parquet(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode(
            "overwrite" if mode == "complete" else "append").parquet(out)

    (stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return read_table(spark, out)


@register("burst_sessions_stream")
def q_burst_sessions_stream(spark, sf_dir):
    """W3 on a stream (session windows), test constants of ``burst_sessions``."""
    s = detect.burst_sessions(_silver_stream(spark, sf_dir, "transaction_id", "card_id", "event_time", "amount"),
                              gap_s=7200, min_count=4)
    return _drained(spark, s, "complete").select("card_id", _et("session_start"), _et("session_end"), "n_txn", "total_amount")


@register("events_per_minute_stream")
def q_events_per_minute_stream(spark, sf_dir):
    """T4 on a stream: the last update of each window and label."""
    w = metrics.windowed_counts_stream(_silver_stream(spark, sf_dir, "event_time", "is_fraud"))
    return _drained(spark, w, "update").groupBy("window_start", "window_end", "is_fraud").agg(
        F.max_by("events", "batch_id").alias("events"))


@register("cumulative_events_stream")
def q_cumulative_events_stream(spark, sf_dir):
    """T7 on a stream: the running totals per label after the last micro-batch."""
    t = metrics.cumulative_events_stream(_silver_stream(spark, sf_dir, "is_fraud"))
    return _drained(spark, t, "complete").select("is_fraud", "cumulative_events")


def _replayed(spark: SparkSession, sf_dir: str, *columns: str, slices: int, within_s: int = 0) -> DataFrame:
    """The silver rows as a stream that reads a slice of time per micro-batch.  With ``within_s``, rows come up to that many
    seconds after their time, so that neighbours change places, also across micro-batches."""
    base = scratch_path(spark, f"replay-{uuid.uuid4().hex}")
    silver = silver_of(spark, sf_dir, *columns)
    lag = F.pmod(F.xxhash64("transaction_id"), F.lit(within_s * 1_000_000)) if within_s else F.lit(0)
    came = silver.withColumn("_came", F.unix_micros("event_time") + lag)
    q = came.agg(F.percentile_approx("_came", [i / slices for i in range(1, slices)], 100_000).alias("q"), F.count(F.lit(1)).alias("n")).first()
    cuts, files = q["q"] or [], jobs.files_of(q["n"], slices)
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        part = came.filter((F.lit(True) if lo is None else F.col("_came") > lo) & (F.lit(True) if hi is None else F.col("_came") <= hi))
        part.drop("_came").repartition(files).write.mode("append").parquet(f"{base}/source")
    return spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/source")


@register("score_event_time_stream")
def q_score_event_time_stream(spark, sf_dir):
    """T3 / W5 on a stream of 6 micro-batches whose rows come up to 8 minutes late, within a watermark of 10: all rows that the
    watermark has passed, scored as by the batch."""
    from cardwatch.streaming.ordered import score_event_time_stream

    stream = _replayed(spark, sf_dir, *LOCATED, "amount", slices=6, within_s=480)
    g = _drained(spark, score_event_time_stream(stream), "append")
    return g.select(
        "transaction_id", "card_id", _et(), "velocity_60m", r6("amount_zscore"), "velocity_flag",
        "geo_anomaly_flag", r6("fraud_score"), (F.col("fraud_score") >= 0.70).alias("is_alert"),
    )


@register("health_status_stream")
def q_health_status_stream(spark, sf_dir):
    """T5 / T8 on a stream of 6 micro-batches with rows up to 8 minutes late: what the watermark has passed."""
    m = metrics.health_status_stream(_replayed(spark, sf_dir, "transaction_id", "event_time", "is_fraud", slices=6, within_s=480))
    return _drained(spark, m, "append").drop("batch_id").withColumn("fraud_rate_pct", F.round("fraud_rate_pct", 6))


@register("events_per_second_stream")
def q_events_per_second_stream(spark, sf_dir):
    """T6 on a stream of 6 micro-batches with rows up to 8 minutes late: what the watermark has passed."""
    m = metrics.events_per_second_stream(_replayed(spark, sf_dir, "transaction_id", "event_time", slices=6, within_s=480))
    return _drained(spark, m, "append").drop("batch_id")


@register("health_runs")
def q_health_runs(spark, sf_dir):
    """T8 by runs, on the events and their first hour once more 176 years later: the gap is one row."""
    s = silver_of(spark, sf_dir, "event_time", "is_fraud")
    first = s.agg(F.min("event_time").alias("t0"))
    far = s.join(F.broadcast(first), F.unix_micros("event_time") < F.unix_micros("t0") + 3_600_000_000).select(
        (F.col("event_time") + F.expr("INTERVAL 176 YEARS")).alias("event_time"), "is_fraud")
    m = metrics.health_runs(s.unionByName(far))
    return m.withColumn("fraud_rate_pct", F.round("fraud_rate_pct", 6))


#: Rows before this time go through the merchant lookup with the first snapshot, later ones with the second.
SNAPSHOT_AT = "2024-01-16 00:00:00"


@register("merchant_enrich_stream")
def q_merchant_enrich_stream(spark, sf_dir):
    """J2 on a stream: the job drains the rows of the first half with merchant records made of them, a new snapshot of all rows is
    published, and the job goes on from its checkpoint with the second half."""
    from cardwatch.sources.layers import publish_snapshot

    base = scratch_path(spark, f"lookup-{uuid.uuid4().hex}")
    silver = silver_of(spark, sf_dir, "transaction_id", "event_time", "merchant_id", "merchant_category", "country")
    early = F.col("event_time") < F.lit(SNAPSHOT_AT).cast("timestamp")
    for part, known in ((early, silver.filter(early)), (~early, silver)):
        publish_snapshot(profile.merchant_dim(known), f"{base}/merchants")
        silver.filter(part).repartition(FILES_PER_SLICE).write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/source")
        jobs.run_merchant_enrich(spark, stream, f"{base}/merchants", f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return read_table(spark, f"{base}/out").select(
        "transaction_id", "merchant_id", "merchant_category", "merchant_home_category", "merchant_home_country")


#: Ends of the first two slices of ``late_drop``, and until when its late rows are taken.
LATE_CUTS, LATE_UNTIL = ("2024-01-11 00:00:00", "2024-01-21 00:00:00"), "2024-01-04 00:00:00"


@register("late_drop")
def q_late_drop(spark, sf_dir):
    """Bronze brings three slices of time, and with the last one a tenth of the first days' rows, long after the
    watermark.  The silver job drops and counts them, and its audit table says so for each batch."""
    base = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    paths = LayerPaths(base)
    at = lambda x: F.lit(x).cast("timestamp")
    rows = envelope.decode_envelope(envelope.to_envelope(load_transactions(spark, sf_dir)), keep_raw=True)
    when = F.try_to_timestamp(F.col("timestamp"))
    late = (when < at(LATE_UNTIL)) & (F.substring("transaction_id", -1, 1) == "3")
    first, second = (at(x) for x in LATE_CUTS)
    for part in ((when < first) & ~late, (when >= first) & (when < second), (when >= second) | late):
        rows.filter(part).repartition(FILES_PER_SLICE).write.mode("append").parquet(paths.bronze)
    cfg = jobs.StreamConfig(paths=paths, max_files_per_trigger=FILES_PER_SLICE, available_now=True)
    query = jobs.run_silver(spark, cfg, quarantine=False)[0]
    query.awaitTermination()
    jobs.late_audit(spark, query).write.mode("append").parquet(paths.silver_audit)
    nothing = F.lit(0).cast("long")
    audit = read_table(spark, paths.silver_audit).withColumn("kept", nothing)
    kept = read_table(spark, paths.silver).agg(F.count(F.lit(1)).alias("kept")).select(
        F.lit(None).cast("long").alias("batch_id"), nothing.alias("rows_in"), nothing.alias("late"), "kept")
    return audit.unionByName(kept).agg(
        F.count("batch_id").alias("batches"), F.sum("rows_in").alias("rows_in"), F.sum("late").alias("late"),
        F.max_by("late", "batch_id").alias("late_in_last"), F.sum("kept").alias("kept"))


@register("silver_within_watermark")
def q_silver_within_watermark(spark, sf_dir):
    """Every tenth message comes again with its time changed by a second; within the watermark the id alone tells a repeat."""
    once = load_transactions(spark, sf_dir)
    later = F.date_format(F.try_to_timestamp(F.col("timestamp")) + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    again = once.filter(F.substring("transaction_id", -1, 1) == "0").withColumn("timestamp", later)
    base = scratch_path(spark, f"within-{uuid.uuid4().hex}")
    files = jobs.write_envelope_files(once.unionByName(again), f"{base}/source", 4)
    cfg = jobs.StreamConfig(paths=LayerPaths(base), source_format="parquet", source_path=f"{base}/source",
                            max_files_per_trigger=files, available_now=True)
    silver = cleanse.silver(envelope.decode_envelope(jobs.message_source(spark, cfg)), within_watermark=True)
    return _drained(spark, silver.select("transaction_id", "card_id", "amount"), "append").drop("batch_id")


@register("card_stats_merged")
def q_card_stats_merged(spark, sf_dir):
    """A1 kept up batch by batch: the moments of each micro-batch of a stream are appended to a table of partial rows, and the
    statistics come from merging these, not from the transactions.  They equal one pass over all rows, bit by bit."""
    from cardwatch.functions import moments

    stream = _replayed(spark, sf_dir, "transaction_id", "card_id", "event_time", "amount", slices=5)
    base = scratch_path(spark, f"moments-{uuid.uuid4().hex}")

    def keep(batch: DataFrame, batch_id: int) -> None:
        moments.by_key(batch, "card_id", "amount").write.mode("overwrite").parquet(f"{base}/parts/batch_id={batch_id}")

    (stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    parts = read_table(spark, f"{base}/parts").drop("batch_id")
    return score.stats_report(score.stats_of(moments.merge(parts, "card_id")))
