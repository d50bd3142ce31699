"""Structured Streaming jobs: message log -> bronze -> silver -> gold.

Thin wrappers over the batch operators; formats, paths and triggers are
parameters (S1, S3, S5, S6, S7, S8, S11, S12, T1, T2, T10).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwatch import schema as S
from cardwatch.operators import cleanse, score
from cardwatch.sources.envelope import decode_envelope
from cardwatch.sources.layers import LayerPaths, read_table_stream, run_id_of, write_batch

log = logging.getLogger(__name__)
SILVER_COLUMNS = [f.name for f in S.SILVER_SCHEMA.fields]


@dataclass
class StreamConfig:
    """Job parameters (replaces environment-variable parsing)."""

    paths: LayerPaths
    table_format: str = "parquet"
    source_format: str = "kafka"
    source_path: str | None = None            # file sources: folder of envelope rows
    source_options: dict[str, str] = field(default_factory=dict)
    # scores are relative to a micro-batch, so a limit changes them: none unless asked for
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    triggers: dict[str, str] = field(default_factory=lambda: dict(S.TRIGGERS))
    available_now: bool = False               # notebooks / tests: drain, then stop
    watermark: str = S.WATERMARK_DELAY
    alert_threshold: float = S.ALERT_THRESHOLD
    alert_format: str | None = "json"         # "kafka" writes to a topic, None: no alerts
    alert_options: dict[str, str] = field(default_factory=dict)
    fail_on_alert_error: bool = True
    run_id: str | None = None                 # part of the key of gold writes; from the checkpoint if None


def _trigger(writer, cfg: StreamConfig, layer: str):
    if cfg.available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=cfg.triggers[layer])


def message_source(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """The message-log stream.  ``kafka`` needs the connector jar; any
    file format with the Kafka column shape stands in for it."""
    if cfg.source_format == "kafka":
        r = (spark.readStream.format("kafka")
             .option("startingOffsets", "earliest"))
        if cfg.max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
        for k, v in cfg.source_options.items():
            r = r.option(k, v)
        return r.load()
    r = spark.readStream.format(cfg.source_format).schema(S.ENVELOPE_SCHEMA)
    if cfg.max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    for k, v in cfg.source_options.items():
        r = r.option(k, v)
    return r.load(cfg.source_path)


def run_bronze(spark: SparkSession, cfg: StreamConfig) -> StreamingQuery:
    """Decode envelopes and append them to bronze, keeping the raw text and
    log coordinates (no shuffle; tasks read log partitions directly)."""
    bronze = decode_envelope(message_source(spark, cfg), keep_raw=True)
    w = (bronze.writeStream.format(cfg.table_format).outputMode("append")
         .option("checkpointLocation", cfg.paths.checkpoint("bronze")))
    return _trigger(w, cfg, "bronze").start(cfg.paths.bronze)


def run_silver(spark: SparkSession, cfg: StreamConfig, quarantine: bool = True) -> list[StreamingQuery]:
    """Validate and de-duplicate under the watermark (state in RocksDB,
    bounded by the watermark); optionally a second, stateless query writes
    rejected rows with their reason and raw text (T10)."""
    bronze = read_table_stream(spark, cfg.paths.bronze, cfg.table_format, S.BRONZE_RAW_SCHEMA,
                               cfg.max_files_per_trigger)
    clean = cleanse.silver(bronze, watermark=cfg.watermark).select(*SILVER_COLUMNS)
    w = (clean.writeStream.format(cfg.table_format).outputMode("append")
         .option("checkpointLocation", cfg.paths.checkpoint("silver")))
    out = [_trigger(w, cfg, "silver").start(cfg.paths.silver)]
    if quarantine:
        rej = cleanse.rejects(bronze)
        wq = (rej.writeStream.format(cfg.table_format).outputMode("append")
              .option("checkpointLocation", cfg.paths.checkpoint("rejects")))
        out.append(_trigger(wq, cfg, "silver").start(cfg.paths.rejects))
    return out


def process_gold_batch(batch: DataFrame, batch_id: int, cfg: StreamConfig) -> None:
    """Score one micro-batch, write gold, then alerts, then the audit
    row.  Every write is keyed by run and batch id, so a retried batch replaces
    its own output instead of duplicating it, and a new checkpoint, whose batch
    ids start again, replaces nothing.  The scored batch is persisted once."""
    run = cfg.run_id or run_id_of(batch.sparkSession, cfg.paths.checkpoint("gold"))
    scored = score.score_batch(batch).withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
    try:
        if scored.isEmpty():
            return
        write_batch(scored, cfg.paths.gold, cfg.table_format, batch_id, run)
        if cfg.alert_format:
            try:
                write_alerts(scored, batch_id, cfg, run)
            except Exception:
                if cfg.fail_on_alert_error:
                    raise
                log.exception("alerts of batch %s of run %s were not written", batch_id, run)
        audit = scored.agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(F.col("fraud_score") >= cfg.alert_threshold).alias("alerts"),
        ).select(
            F.lit(batch_id).cast("long").alias("batch_id"), "rows_in", "alerts",
            F.round(F.try_divide(F.col("alerts") * F.lit(100.0), F.col("rows_in").cast("double")), 2).alias("alert_pct"),
            F.current_timestamp().alias("processed_at"),
        )
        write_batch(audit, cfg.paths.audit, cfg.table_format, batch_id, run)
    finally:
        scored.unpersist()


def write_alerts(scored: DataFrame, batch_id: int, cfg: StreamConfig, run_id: str) -> None:
    """Alert records written by executors (no collect).  ``kafka``
    publishes ``key``/``value`` to a topic (consumers de-duplicate by key);
    file formats write one partition per batch."""
    payload = score.alert_payload(scored, cfg.alert_threshold)
    if cfg.alert_format == "kafka":
        w = payload.write.format("kafka")
        for k, v in cfg.alert_options.items():
            w = w.option(k, v)
        w.save()
        return
    write_batch(payload.withColumn("batch_id", F.lit(batch_id).cast("long")), cfg.paths.alerts,
                cfg.alert_format, batch_id, run_id)


def run_gold(spark: SparkSession, cfg: StreamConfig) -> StreamingQuery:
    silver = read_table_stream(spark, cfg.paths.silver, cfg.table_format, S.SILVER_SCHEMA,
                               cfg.max_files_per_trigger)
    w = (silver.writeStream.foreachBatch(lambda df, bid: process_gold_batch(df, bid, cfg))
         .option("checkpointLocation", cfg.paths.checkpoint("gold")))
    return _trigger(w, cfg, "gold").start()


#: Rows of a file of a replay, and the least number of files of a slice.
ROWS_PER_FILE, LEAST_FILES = 100_000, 4


def files_of(rows: int, n_slices: int) -> int:
    """Files that a slice of ``rows / n_slices`` rows is written as: their number grows with the rows, so that the tasks that
    write a slice, and those that read it as a micro-batch, do too."""
    return max(LEAST_FILES, -(-rows // (n_slices * ROWS_PER_FILE)))


def write_envelope_files(txns: DataFrame, path: str, n_slices: int = 4, ts: str = "timestamp",
                         files_per_slice: int | None = None) -> int:
    """Test/replay helper: write transactions as envelope files in event-time
    order, one append of ``files_per_slice`` files (by default as ``files_of``
    says) per time slice, and return that number, so that a file
    source with ``maxFilesPerTrigger`` of it replays about a slice per
    micro-batch.  A slice is read and written by many tasks.  Slice bounds are
    ``n_slices - 1`` approximate quantiles of the event time (one small row to
    the driver)."""
    from cardwatch.sources.envelope import to_envelope

    us = F.unix_micros(F.try_to_timestamp(F.col(ts)))
    probs = [i / n_slices for i in range(1, n_slices)]
    first = txns.agg(F.percentile_approx(us, probs or [0.5], 100_000).alias("q"), F.count(F.lit(1)).alias("n")).first()
    cuts = (first["q"] or []) if probs else []
    files = files_per_slice or files_of(first["n"], n_slices)
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (us > F.lit(lo))
        if hi is not None:
            cond = cond & (us <= F.lit(hi))
        if lo is None:
            cond = cond | us.isNull()
        to_envelope(txns.filter(cond)).repartition(files).write.mode("append").parquet(path)
    return files


def run_merchant_enrich(spark: SparkSession, silver_stream: DataFrame, dimension_path: str, out_path: str, checkpoint: str,
                        available_now: bool = False, trigger: str = "30 seconds") -> StreamingQuery:
    """J2 on a stream: each micro-batch is joined to the merchant records as they are when it runs, the newest complete
    snapshot under ``dimension_path``.  A file source alone would keep the files that it saw at the start.  Output is
    keyed by run and batch, so a repeated batch replaces its own rows (with the records of its repetition)."""
    from cardwatch.operators.profile import merchant_enrich
    from cardwatch.sources.layers import latest_snapshot

    def enrich(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        rows = merchant_enrich(batch, latest_snapshot(s, dimension_path)).withColumn("batch_id", F.lit(batch_id).cast("long"))
        write_batch(rows, out_path, "parquet", batch_id, run_id_of(s, checkpoint))

    w = silver_stream.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def late_audit(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch_id, rows_in, late) of the batches that brought rows: how many each read, and how many came after the
    watermark had passed them and were dropped.  From the query's progress, which keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates`` batches; a long-running job appends it to ``paths.silver_audit`` as it goes."""
    seen = {}
    for p in query.recentProgress:
        late = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        rows, before = seen.get(p["batchId"], (0, 0))
        seen[p["batchId"]] = (rows + p["numInputRows"], before + late)
    rows = [(b, n, late) for b, (n, late) in sorted(seen.items()) if n]
    return spark.createDataFrame(rows, "batch_id long, rows_in long, late long")
