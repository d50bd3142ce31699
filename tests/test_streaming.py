"""Silver watermark behaviour on a real stream: late rows are dropped and
counted, rows within the delay are kept (FIXTURES.md section 2)."""

import json
import os

from cardwatch import schema as S
from cardwatch.operators import cleanse
from cardwatch.sources.layers import LayerPaths
from cardwatch.streaming import jobs


def _write(spark, path, rows):
    env = spark.createDataFrame(
        [(None, json.dumps(r).encode(), "t", 0, i, None, 0) for i, r in enumerate(rows)], S.ENVELOPE_SCHEMA
    )
    env.coalesce(1).write.mode("append").parquet(path)


def _tx(tid, ts):
    return {"transaction_id": tid, "card_id": "c", "amount": 5.0, "timestamp": ts}


def test_late_row_dropped_within_delay_kept(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    # Spark drops late rows against the watermark of the batch before the
    # previous one (chained stateful operators), so the late row comes third
    _write(spark, src, [_tx("a", "2024-01-01T01:00:00.000000Z")])
    _write(spark, src, [_tx("b", "2024-01-01T01:00:30.000000Z")])
    _write(spark, src, [_tx("late", "2024-01-01T00:30:00.000000Z"), _tx("ok", "2024-01-01T00:55:00.000000Z")])
    cfg = jobs.StreamConfig(paths=LayerPaths(tmp_dir), source_format="parquet", source_path=src,
                            max_files_per_trigger=1, available_now=True)
    jobs.run_bronze(spark, cfg).awaitTermination()
    qs = jobs.run_silver(spark, cfg, quarantine=False)
    for q in qs:
        q.awaitTermination()
    got = {r.transaction_id for r in spark.read.parquet(cfg.paths.silver).collect()}
    assert got == {"a", "b", "ok"}
    dropped = sum(
        sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        for p in (x for x in qs[0].recentProgress)
    )
    assert dropped == 1


def test_batch_and_stream_silver_agree(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    rows = [_tx("a", "2024-01-01T01:00:00.000000Z"), _tx("a", "2024-01-01T01:00:00.000000Z"),
            _tx("b", "junk"), {"transaction_id": "c", "card_id": "c", "amount": -1.0,
                               "timestamp": "2024-01-01T01:00:01.000000Z"}]
    _write(spark, src, rows)
    cfg = jobs.StreamConfig(paths=LayerPaths(tmp_dir), source_format="parquet", source_path=src,
                            available_now=True)
    jobs.run_bronze(spark, cfg).awaitTermination()
    for q in jobs.run_silver(spark, cfg):
        q.awaitTermination()
    assert [r.transaction_id for r in spark.read.parquet(cfg.paths.silver).collect()] == ["a"]
    rej = {r.transaction_id: r.reject_reason for r in spark.read.parquet(cfg.paths.rejects).collect()}
    assert rej == {"b": "bad_event_time", "c": "non_positive_amount"}
    batch = cleanse.silver(spark.read.parquet(cfg.paths.bronze))
    assert batch.count() == 1


def test_stream_metrics_equal_batch(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cardwatch.operators import metrics
    from cardwatch.plans.catalog import silver_of
    from conftest import SF_SMALL

    silver = silver_of(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "silver")
    silver.write.parquet(path)
    stream = spark.readStream.schema(silver.schema).parquet(path)
    q = (metrics.cumulative_events_stream(stream).writeStream.format("memory").queryName("cum_t7")
         .outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.is_fraud: r.cumulative_events for r in spark.table("cum_t7").collect()}
    exp = {r.is_fraud: r.n for r in silver.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == exp
    w = (metrics.windowed_counts_stream(stream).writeStream.format("memory").queryName("win_t4")
         .outputMode("update").trigger(availableNow=True).start())
    w.awaitTermination()
    batch = metrics.sliding_counts(silver, 60, 15, ["is_fraud"]).select("window_start", "is_fraud", "events")
    got = spark.table("win_t4").select("window_start", "is_fraud", "events")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
