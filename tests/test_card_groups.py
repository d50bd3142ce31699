"""The keyed streams hold their state by group of cards: a call does many cards, and each card is told from the others."""

import os

import pandas as pd
from pyspark.sql import functions as F

from cardwatch.plans.catalog import FEW_SEGMENT_ROWS
from cardwatch.streaming import jobs
from cardwatch.streaming.ordered import _ROW, _make_scan
from cardwatch.streaming.stateful import _make_fn, card_group

S = 1_000_000


class State:
    def __init__(self):
        self.value, self.wm, self.hasTimedOut, self.timeout = None, 0, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, v):
        self.value = v

    def remove(self):
        self.value = None

    def getCurrentWatermarkMs(self):
        return self.wm

    def setTimeoutTimestamp(self, t):
        assert t >= self.wm
        self.timeout = t


def test_velocity_of_many_cards_in_one_call():
    fn, st = _make_fn(60, 2000.0, 300), State()
    columns = ["transaction_id", "card_id", "us", "lat", "lon", "country"]
    first = pd.DataFrame([("a0", "a", 0, 48.0, 2.0, "FR"), ("b0", "b", 10 * S, 40.0, -74.0, "US"), ("n0", None, 12 * S, 0.0, 0.0, None)], columns=columns)
    got = {r.transaction_id: r for r in next(fn((0,), iter([first]), st)).itertuples()}
    assert {k: (r.velocity, r.travel_flag) for k, r in got.items()} == {"a0": (1, False), "b0": (1, False), "n0": (1, False)}
    second = pd.DataFrame([("a1", "a", 20 * S, 40.0, -74.0, "US"), ("b1", "b", 30 * S, 40.0, -74.0, "US"), ("n1", None, 13 * S, 0.0, 0.0, None),
                           ("c0", "c", 30 * S, 48.0, 2.0, "FR")], columns=columns)
    got = {r.transaction_id: r for r in next(fn((0,), iter([second]), st)).itertuples()}
    assert {k: (r.velocity, r.travel_flag) for k, r in got.items()} == {"a1": (2, True), "b1": (2, False), "n1": (2, False), "c0": (1, False)}


def test_ordered_scan_of_many_cards_in_one_call():
    def rows(*data):
        return pd.DataFrame([(c, at * S, f"{c}{at}", units, 0.0, units / 1e8, lat, lon, k) for c, at, units, lat, lon, k in data], columns=list(_ROW))

    fn, st = _make_scan(60), State()
    assert list(fn((0,), iter([rows(("a", 70, 3, 1.0, 1.0, "X"), ("b", 10, 5, None, None, None), ("a", 5, 7, 2.0, 2.0, "Y"))]), st)) == []
    assert st.timeout == 59_999
    st.wm, st.hasTimedOut = 60_000, True  # the first minute has ended
    out = next(fn((0,), iter([]), st))
    assert sorted(zip(out["transaction_id"], out["velocity"], out["_p_n"])) == [("a5", 1, 0), ("b10", 1, 0)] and st.timeout == 119_999
    st.wm, st.hasTimedOut = 120_000, False
    out = next(fn((0,), iter([rows(("b", 119, 9, 0.0, 0.0, "Z"), ("b", 130, 1, 0.0, 0.0, "Z"))]), st))  # one of them late
    assert out[["transaction_id", "velocity", "_p_n", "_p_units", "_p_squares", "prev_transaction_id"]].values.tolist() == [["a70", 1, 1, "7", "49", "a5"]]
    st.wm, st.hasTimedOut = 180_000, True
    out = next(fn((0,), iter([]), st))
    assert out[["transaction_id", "velocity", "_p_n", "_p_units"]].values.tolist() == [["b130", 1, 1, "5"]]
    st.wm = 10_000_000
    assert list(fn((0,), iter([]), st)) == [] and st.value[1] == [] and sorted(st.value[11]) == ["a", "b"]  # only sums are left


def test_cards_are_dealt_to_a_fixed_number_of_groups(spark):
    d = spark.range(2000).select(card_group(F.col("id").cast("string"), 16).alias("g"))
    assert {r.g for r in d.distinct().collect()} == set(range(16))


def test_files_of_a_slice_grow_with_its_rows(spark, tmp_dir, monkeypatch):
    assert (jobs.files_of(0, 4), jobs.files_of(600_000, 4), jobs.files_of(36_000_000, 4)) == (4, 4, 90)
    monkeypatch.setattr(jobs, "ROWS_PER_FILE", 20)
    from cardwatch.plans.catalog import load_transactions
    from conftest import SF_SMALL

    t = load_transactions(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "src")
    n = jobs.write_envelope_files(t, path, 5)
    assert n == 10 and spark.read.parquet(path).count() == t.count() > FEW_SEGMENT_ROWS
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 50
