"""Event-time throughput and fraud-rate metrics (T4..T9).

Sliding windows are computed from a pre-aggregated step table: rows are
counted per (step bucket, group) with map-side combining, and only that small
table is expanded into the ``size / step`` windows each bucket belongs to.
The windows are the same as ``window(ts, size, step)`` (aligned to the epoch;
a row at t is in every window with start in (t - size, t]).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schema as S
from cardwatch.functions.columns import pct
from cardwatch.operators.sequence import prefix_sums


def _step_counts(df: DataFrame, ts: str, step_s: int, by: Sequence[str]) -> DataFrame:
    step = F.floor(F.unix_micros(F.col(ts)) / F.lit(step_s * 1_000_000)).cast("long")
    return df.groupBy(step.alias("_step"), *by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False))).alias("_f"),
    )


def _ts_of_step(step: Column, step_s: int) -> Column:
    return F.timestamp_micros(step * F.lit(step_s * 1_000_000)).cast("timestamp_ntz")


def sliding_counts(
    df: DataFrame, size_s: int, step_s: int, by: Sequence[str] = (), ts: str = "event_time"
) -> DataFrame:
    """Rows (``events``) and labelled fraud rows (``fraud_events``) per sliding
    window and group; windows without rows are absent, as with ``window``."""
    return _slide(_step_counts(df, ts, step_s, by), size_s, step_s, by)


def _slide(steps: DataFrame, size_s: int, step_s: int, by: Sequence[str]) -> DataFrame:
    if size_s % step_s:
        raise ValueError("size_s must be a multiple of step_s")
    k = size_s // step_s
    expanded = steps.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.col("_step") - F.col("_k")
    return (
        expanded.groupBy(start.alias("_start"), *by)
        .agg(F.sum("_n").cast("long").alias("events"), F.sum("_f").cast("long").alias("fraud_events"))
        .select(
            _ts_of_step(F.col("_start"), step_s).alias("window_start"),
            _ts_of_step(F.col("_start") + k, step_s).alias("window_end"),
            *by, "events", "fraud_events",
        )
    )


def events_per_minute(df: DataFrame, size_s: int = 60, step_s: int = 15) -> DataFrame:
    """T4: events per minute over a sliding window (the dashboard's 1 min rate
    refreshed every scrape): a ``label`` series per fraud label, of which NULL
    is one, and a ``total`` series, both from one pass over the rows."""
    series = F.explode(F.array(
        F.struct(F.lit("label").alias("series"), F.col("is_fraud").alias("label")),
        F.struct(F.lit("total").alias("series"), F.lit(None).cast("boolean").alias("label")),
    )).alias("_s")
    both = _step_counts(df, "event_time", step_s, ["is_fraud"]).select("_step", "_n", "_f", series).select(
        "_step", "_n", "_f", "_s.series", F.col("_s.label").alias("is_fraud"))
    out = _slide(both, size_s, step_s, ["series", "is_fraud"])
    return out.select(
        "window_start", "window_end", "series", "is_fraud", "events",
        (F.col("events") * F.lit(60.0) / F.lit(float(size_s))).alias("events_per_min"),
    )


def fraud_rate_rolling(df: DataFrame, size_s: int = 120, step_s: int = 15) -> DataFrame:
    """T5: fraud events / events * 100 over a sliding window."""
    w = sliding_counts(df, size_s, step_s)
    return w.select(
        "window_start", "window_end", "events", "fraud_events",
        F.try_divide(F.col("fraud_events") * F.lit(100.0), F.col("events").cast("double")).alias("fraud_rate_pct"),
    )


def events_per_second(df: DataFrame, size_s: int = 5, step_s: int = 1) -> DataFrame:
    """Events in the last ``size_s`` seconds / ``size_s``, every ``step_s``."""
    w = sliding_counts(df, size_s, step_s)
    return w.select(
        "window_start", "window_end", "events",
        (F.col("events") / F.lit(float(size_s))).alias("events_per_sec"),
    )


def cumulative_events(df: DataFrame, step_s: int = 60, day_s: int = 86400) -> DataFrame:
    """Running event count per fraud label at the end of each step.

    Counts per (step, label) first; the running sum then uses a per-day
    carry (``prefix_sums``), so no single task holds a whole label's history.
    """
    steps = _step_counts(df, "event_time", step_s, ["is_fraud"]).select(
        "_step", "is_fraud", F.col("_n").alias("events"),
        _ts_of_step(F.col("_step"), step_s).cast("timestamp").alias("_t"),
    )
    p = prefix_sums(steps, "is_fraud", ["_t"], {"n": F.col("events")}, prefix="_prior_", bucket_s=day_s)
    return p.select(
        _ts_of_step(F.col("_step"), step_s).alias("step_start"),
        "is_fraud", "events",
        (F.col("_prior_n") + F.col("events")).cast("long").alias("cumulative_events"),
    )


def _band(value: Column, cuts: Sequence[float], colors: Sequence[str]) -> Column:
    expr = None
    for cut, color in zip(cuts, colors):
        expr = (F.when if expr is None else expr.when)(value < cut, F.lit(color))
    return expr.otherwise(F.lit(colors[len(cuts)]))


def _instants(steps: DataFrame, first: int, last: int, chunk: int = 5760) -> DataFrame:
    """Every instant (step number) from the first step + ``first`` to the last
    step + ``last``, made in chunks by as many tasks as there are chunks."""
    span = steps.agg((F.min("_step") + first).alias("lo"), (F.max("_step") + last).alias("hi")).filter("lo is not null")
    parts = span.select("hi", F.explode(F.sequence("lo", "hi", F.lit(chunk))).alias("a")).repartition("a")
    return parts.select(F.explode(F.sequence("a", F.least("hi", F.col("a") + (chunk - 1)))).alias("_at"))


def health_status(df: DataFrame, step_s: int = 15, rate_s: int = 60, fraud_s: int = 120) -> DataFrame:
    """Dashboard thresholds at every refresh instant (window end) between the
    first and the last event: events / min (1 min window) and fraud rate %
    (2 min window).  Instants without events count 0 and show red, so an outage
    is seen; the fraud rate is NULL there."""
    steps = _step_counts(df, "event_time", step_s, [])
    k_rate, k_fraud = rate_s // step_s, fraud_s // step_s
    seen = steps.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(max(k_rate, k_fraud))))).select(
        (F.col("_step") + F.col("_k")).alias("_at"),
        F.when(F.col("_k") <= k_rate, F.col("_n")).otherwise(0).alias("_r"),
        F.when(F.col("_k") <= k_fraud, F.col("_n")).otherwise(0).alias("_n"),
        F.when(F.col("_k") <= k_fraud, F.col("_f")).otherwise(0).alias("_f"),
    )
    zero = F.lit(0).cast("long")
    every = _instants(steps, 1, max(k_rate, k_fraud)).select("_at", zero.alias("_r"), zero.alias("_n"), zero.alias("_f"))
    j = seen.unionByName(every).groupBy("_at").agg(F.sum("_r").alias("_r"), F.sum("_n").alias("_n"), F.sum("_f").alias("_f"))
    j = j.select(
        _ts_of_step(F.col("_at"), step_s).alias("window_end"),
        (F.col("_r") * F.lit(60.0) / F.lit(float(rate_s))).alias("events_per_min"),
        F.try_divide(F.col("_f") * F.lit(100.0), F.col("_n").cast("double")).alias("fraud_rate_pct"),
    )
    return j.select(
        "window_end", "events_per_min", "fraud_rate_pct",
        _band(F.col("events_per_min"), list(S.RATE_PER_MIN_BANDS), ["red", "yellow", "green"]).alias("rate_status"),
        F.when(F.col("fraud_rate_pct").isNull(), F.lit(None).cast("string"))
        .otherwise(_band(F.col("fraud_rate_pct"), list(S.FRAUD_RATE_BANDS), ["green", "yellow", "red"])).alias("fraud_status"),
    )


def per_second_status(df: DataFrame) -> DataFrame:
    """The events / s gauge colors (red < 10 <= yellow < 15 <= green < 30
    <= yellow < 100 <= red)."""
    eps = events_per_second(df)
    return eps.select(
        "window_end", "events_per_sec",
        _band(F.col("events_per_sec"), list(S.RATE_PER_SEC_BANDS),
              ["red", "yellow", "green", "yellow", "red"]).alias("status"),
    )


def layer_lag(bronze: DataFrame, gold: DataFrame | None = None, accuracy: int = 10_000) -> DataFrame:
    """Processing-lag percentiles (seconds): message log -> bronze, and
    event -> gold when ``gold`` is given.  Sketches merge map-side."""
    def pcts(d: DataFrame, a: str, b: str, name: str) -> DataFrame:
        lag = (F.unix_micros(F.col(b)) - F.unix_micros(F.col(a))).cast("double") / F.lit(1e6)
        return d.select(lag.alias("_lag")).agg(
            F.count("_lag").alias("n"),
            F.percentile_approx("_lag", [0.5, 0.95, 0.99], accuracy).alias("_p"),
        ).select(
            F.lit(name).alias("stage"), "n",
            F.col("_p")[0].alias("p50_s"), F.col("_p")[1].alias("p95_s"), F.col("_p")[2].alias("p99_s"),
        )

    out = pcts(bronze, "kafka_ingest_time", "bronze_ingest_time", "log_to_bronze")
    if gold is not None:
        out = out.unionByName(pcts(gold, "event_time", "gold_processed_at", "event_to_gold"))
    return out


def windowed_counts_stream(
    df: DataFrame,
    size: str = "1 minute",
    step: str = "15 seconds",
    watermark: str = S.WATERMARK_DELAY,
) -> DataFrame:
    """T4/T5 on a stream: ``window(event_time, size, step)`` counts per label
    under a watermark (append mode emits a window once the watermark passes
    its end; update mode emits running values)."""
    src = df.withWatermark("event_time", watermark) if df.isStreaming else df
    return src.groupBy(F.window("event_time", size, step).alias("w"), "is_fraud").agg(
        F.count(F.lit(1)).alias("events")
    ).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "is_fraud", "events",
    )


def cumulative_events_stream(df: DataFrame) -> DataFrame:
    """T7 on a stream: running totals per label (complete or update mode;
    the state is one row per label)."""
    return df.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("cumulative_events"))


def health_status_stream(
    df: DataFrame, step_s: int = 15, rate_s: int = 60, fraud_s: int = 120, watermark: str = S.WATERMARK_DELAY,
) -> DataFrame:
    """T5 / T8 on a stream, append mode: ``health_status`` at the instants with an event in the last ``fraud_s`` seconds, sent when
    the watermark has passed them.  Two windowed aggregations under one watermark: events are counted per step, and the
    few step rows, not the events, are spread over the sliding windows that hold them."""
    src = df.withWatermark("event_time", watermark) if df.isStreaming else df
    steps = src.groupBy(F.window("event_time", f"{step_s} seconds").alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False))).alias("f"))
    slid = steps.select("step", "n", "f", F.window(F.window_time("step"), f"{fraud_s} seconds", f"{step_s} seconds").alias("w"))
    age = F.unix_micros("w.end") - F.unix_micros("step.end")
    rows = slid.withColumn("recent", F.when(age < rate_s * 1_000_000, F.col("n")).otherwise(0)).groupBy("w").agg(
        F.sum("recent").alias("r"), F.sum("n").alias("n"), F.sum("f").alias("f"))
    m = rows.select(
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), (F.col("r") * F.lit(60.0) / F.lit(float(rate_s))).alias("events_per_min"),
        pct("f", "n").alias("fraud_rate_pct"))
    return m.select("*", *_health_bands())


def events_per_second_stream(df: DataFrame, size_s: int = 5, step_s: int = 1, watermark: str = S.WATERMARK_DELAY) -> DataFrame:
    """T6 on a stream, append mode: ``events_per_second`` of the windows that the watermark has passed, chained like
    ``health_status_stream``."""
    src = df.withWatermark("event_time", watermark) if df.isStreaming else df
    steps = src.groupBy(F.window("event_time", f"{step_s} seconds").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    w = steps.groupBy(F.window(F.window_time("step"), f"{size_s} seconds", f"{step_s} seconds").alias("w")).agg(F.sum("n").alias("events"))
    return w.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "events", (F.col("events") / F.lit(float(size_s))).alias("events_per_sec"))


def _health_bands() -> list[Column]:
    rate = _band(F.col("events_per_min"), list(S.RATE_PER_MIN_BANDS), ["red", "yellow", "green"])
    fraud = _band(F.col("fraud_rate_pct"), list(S.FRAUD_RATE_BANDS), ["green", "yellow", "red"])
    return [rate.alias("rate_status"), F.when(F.col("fraud_rate_pct").isNotNull(), fraud).alias("fraud_status")]


def health_runs(df: DataFrame, step_s: int = 15, rate_s: int = 60, fraud_s: int = 120, day_s: int = 86400) -> DataFrame:
    """T8 without a grid: ``health_status`` at every refresh instant, where a run of instants without any event in reach is one
    row: from ``window_end`` to ``last_end``, ``instants`` of them.  The runs come from neighbouring instants with events,
    so their number follows the events, however far apart the first and the last are."""
    from cardwatch.operators.sequence import previous_row

    k_rate, k_fraud = rate_s // step_s, fraud_s // step_s
    most = max(k_rate, k_fraud)
    steps = _step_counts(df, "event_time", step_s, [])
    k = F.col("_k")
    seen = steps.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(most)))).groupBy((F.col("_step") + k).alias("_at")).agg(
        F.sum(F.when(k <= k_rate, F.col("_n")).otherwise(0)).alias("_r"), F.sum(F.when(k <= k_fraud, F.col("_n")).otherwise(0)).alias("_n"),
        F.sum(F.when(k <= k_fraud, F.col("_f")).otherwise(0)).alias("_f"))
    at = seen.withColumn("_t", F.timestamp_micros(F.col("_at") * F.lit(step_s * 1_000_000))).withColumn("_one", F.lit(1))
    at = previous_row(at, "_one", ["_t"], ["_at"], prefix="_prev", bucket_s=day_s)
    zero = F.lit(0).cast("long")
    one = at.select(F.col("_at").alias("_from"), F.col("_at").alias("_to"), "_r", "_n", "_f")
    gaps = at.filter("_at > _prev_at + 1").select((F.col("_prev_at") + 1).alias("_from"), (F.col("_at") - 1).alias("_to"),
                                                 zero.alias("_r"), zero.alias("_n"), zero.alias("_f"))
    m = one.unionByName(gaps).select(
        _ts_of_step(F.col("_from"), step_s).alias("window_end"), _ts_of_step(F.col("_to"), step_s).alias("last_end"),
        (F.col("_to") - F.col("_from") + 1).alias("instants"), (F.col("_r") * F.lit(60.0) / F.lit(float(rate_s))).alias("events_per_min"),
        pct("_f", "_n").alias("fraud_rate_pct"))
    return m.select("*", *_health_bands())
