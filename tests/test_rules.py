"""Rows that the clean test tables do not have: unlabelled, extreme, late and missing ones."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.operators import cleanse, detect, metrics, score, sequence
from cardwatch.session import ensure_checkpoint_dir
from cardwatch.sources.layers import LayerPaths, run_id_of, write_batch
from cardwatch.streaming.stateful import _make_fn

T0 = dt.datetime(2024, 1, 1)


def rows(spark, *data):
    """(card, seconds, amount, is_fraud) as silver rows."""
    return spark.createDataFrame(
        [(f"t{i}", c, T0 + dt.timedelta(seconds=s), a, f) for i, (c, s, a, f) in enumerate(data)],
        "transaction_id string, card_id string, event_time timestamp, amount double, is_fraud boolean")


def test_cumulative_counts_of_unlabelled_rows(spark):
    d = rows(spark, *[("c", 86400 * k, 1.0, None) for k in range(3)])
    got = [r.cumulative_events for r in metrics.cumulative_events(d).orderBy("step_start").collect()]
    assert got == [1, 2, 3]


def test_previous_row_of_a_null_key(spark):
    d = rows(spark, (None, 0, 1.0, None), (None, 90000, 2.0, None))
    p = sequence.previous_row(d, "card_id", ("event_time", "transaction_id"), ["amount"]).orderBy("event_time").collect()
    assert [r.prev_amount for r in p] == [None, 1.0]


def test_rate_series_have_distinct_keys(spark):
    d = rows(spark, ("c", 0, 1.0, None), ("c", 1, 1.0, True), ("c", 2, 1.0, False))
    m = metrics.events_per_minute(d)
    assert m.count() == m.select("window_start", "series", "is_fraud").distinct().count() == 16
    assert {r.events for r in m.filter("series = 'total'").collect()} == {3}


def test_health_shows_an_outage(spark):
    d = rows(spark, ("c", 0, 1.0, True), ("c", 86400, 1.0, False))
    h = metrics.health_status(d)
    assert h.count() == 86400 // 15 + 8
    mid = h.filter(F.col("window_end") == F.lit(T0 + dt.timedelta(hours=12)).cast("timestamp_ntz")).first()
    assert mid.events_per_min == 0 and mid.rate_status == "red" and mid.fraud_rate_pct is None
    assert metrics.health_status(d.filter("false")).count() == 0


def test_extreme_amounts_end_no_job(spark):
    d = rows(spark, *[("c", i, 0.004, None) for i in range(6)], ("c", 10, 1e17, None), ("c", 11, 5.0, None))
    s = {r.transaction_id: r for r in detect.amount_spike(d, min_amount=0.001).collect()}
    assert s["t5"].prior_mean == pytest.approx(0.004) and s["t5"].prior_std == 0.0
    assert s["t6"].spike_flag and s["t7"].prior_mean == pytest.approx(1e17 / 7)
    b = detect.burst_sessions(d, gap_s=60, min_count=2).first()
    assert b.n_txn == 8 and b.total_amount == pytest.approx(1e17)
    assert score.card_stats_report(d).first().avg_amount == pytest.approx(1e17 / 8)
    assert detect.score_event_time(d.withColumn("lat", F.lit(0.0)).withColumn("lon", F.lit(0.0)).withColumn("country", F.lit("x"))).count() == 8


def test_amounts_that_are_no_numbers_are_rejected(spark):
    d = rows(spark, ("c", 0, math.inf, None), ("c", 0, math.nan, None), ("c", 0, -math.inf, None), ("c", 0, 1e300, None)) \
        .withColumn("timestamp", F.lit("2024-01-01T00:00:00Z"))
    reasons = {r.transaction_id: r.reject_reason for r in cleanse.rejects(d).collect()}
    assert reasons == {"t0": "infinite_amount", "t1": "nan_amount", "t2": "infinite_amount"}
    assert [r.transaction_id for r in cleanse.validate(d).collect()] == ["t3"]
    assert cleanse.validate(d, reject_nan=False).count() == 3  # what a plain ``amount > 0`` keeps


def test_two_widths_do_not_meet(spark):
    d = rows(spark, *[("c", 60 * i, 1.0, None) for i in range(1500)])
    a = sequence.rolling_count(d, "card_id", "event_time", 60, "a", 3600)
    b = sequence.rolling_count(a, "card_id", "event_time", 86400, "b", 2 * 86400)
    r = b.agg(F.max("a").alias("a"), F.max("b").alias("b")).first()
    assert (r.a, r.b) == (2, 1441)


class State:
    """Stands in for Spark's group state."""

    def __init__(self):
        self.value, self.wm, self.hasTimedOut = None, 0, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, v):
        self.value = v

    def getCurrentWatermarkMs(self):
        return self.wm

    def setTimeoutTimestamp(self, t):
        self.timeout = t


def batch(*data):
    return pd.DataFrame([(f"t{i}", "c", int(us * 1e6), lat, lon, country) for i, us, lat, lon, country in data],
                        columns=["transaction_id", "card_id", "us", "lat", "lon", "country"])


def run(fn, state, *data):
    out = list(fn(("c",), iter([batch(*data)]), state))
    return {r.transaction_id: r for r in out[0].itertuples()} if out else {}


def test_late_rows_of_the_state_are_counted_in_place():
    h = 3600
    fn, st = _make_fn(60, 2000.0, 300), State()
    run(fn, st, *[(i, h - 300 + i, 0.0, 0.0, "A") for i in range(10)])
    st.wm = (h - 600) * 1000
    run(fn, st, (20, h, 0.0, 0.0, "A"))
    assert run(fn, st, (21, h - 290, 0.0, 0.0, "A"))["t21"].velocity == 11


def test_travel_looks_back_only():
    h = 3600
    fn, st = _make_fn(60, 2000.0, 300), State()
    run(fn, st, (0, h, 48.0, 2.0, "FR"))
    late = run(fn, st, (1, h - 599, 40.0, -74.0, "US"))
    assert not late["t1"].travel_flag
    again = run(fn, st, (2, h + 100, 40.0, -74.0, "US"))
    assert again["t2"].travel_flag  # against the row at h, not the late one
    assert st.timeout >= (h + 100 + 300) * 1000


def test_rows_behind_the_watermark_are_left_out():
    fn, st = _make_fn(60, 2000.0, 300), State()
    st.wm = 1000 * 1000
    assert run(fn, st, (0, 999, np.nan, np.nan, None)) == {}


def test_a_new_run_replaces_nothing(spark, tmp_dir):
    p = LayerPaths(tmp_dir)
    first = run_id_of(spark, p.checkpoint("gold"))
    assert run_id_of(spark, p.checkpoint("gold")) == first
    d = spark.range(8).withColumn("batch_id", F.lit(0).cast("long"))
    write_batch(d, p.gold, batch_id=0, run_id=first)
    write_batch(d.limit(8), p.gold, batch_id=0, run_id=first)  # a retry
    write_batch(d.limit(3), p.gold, batch_id=0, run_id="another")
    assert spark.read.parquet(p.gold).count() == 11


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_a_message_that_is_no_json_says_so(spark):
    from cardwatch import schema as S
    from cardwatch.sources.envelope import decode_envelope

    env = spark.createDataFrame(
        [(None, bytearray(v), "t", 0, i, T0, 0) for i, v in enumerate([b"{bad", b"{}", b'{"transaction_id":"a","amount":"x"}'])],
        S.ENVELOPE_SCHEMA)
    got = {r.offset: r.reject_reason for r in cleanse.rejects(decode_envelope(env, keep_raw=True)).collect()}
    assert got == {0: "undecodable_message", 1: "missing_transaction_id", 2: "missing_card_id"}
