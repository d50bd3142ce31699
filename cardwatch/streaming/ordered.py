"""The event-time score on a stream, exact for rows in any order within the watermark.

The state is kept by group of cards (a hash of the card; ``applyInPandasWithState``), so a call of Python does the rows of many
cards and not of one.  A group keeps its rows and does nothing with them until the watermark has passed their minute: then all rows up
to there have come.  They are scanned by card in time order, with the card's running count and exact sums of amounts, its last
located row and the times of its trailing window, and sent out once, with the values of the batch scan of the same rows.  The group's
timeout is the end of its first minute that waits, so it is called without new rows too.  A group's state is its rows not older than
the watermark, the times of those that a later window can reach, and one row of sums a card.

Rows later than the watermark are dropped, like in other stateful operators; a minute is sent when the watermark reaches its end, so
the newest ``watermark`` of a stream is held back until time goes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardwatch import schema as S
from cardwatch.functions.columns import composite_score, exact_money, rest_money
from cardwatch.operators import detect
from cardwatch.streaming.stateful import CARD_GROUPS, by_card, card_group, lists_of

MINUTE_US = 60_000_000
_ROW = {"card_id": "string", "us": "long", "transaction_id": "string", "units": "long", "big": "double", "amount": "double",
        "lat": "double", "lon": "double", "country": "string"}
_SEEN = {"card_id": "string", "us": "long"}
#: A card's count and sums so far, and its last located row.
_SUMS = {"card_id": "string", "n": "long", "units": "string", "squares": "string", "big": "double", "bigsq": "double",
         "located": "boolean", "us": "long", "id": "string", "lat": "double", "lon": "double", "country": "string"}
_PARTS = {"row": _ROW, "seen": _SEEN, "sum": _SUMS}
_STATE = ", ".join(f"{part}_{c} array<{t}>" for part, columns in _PARTS.items() for c, t in columns.items())
_OUT = "transaction_id string, card_id string, us long, amount double, lat double, lon double, country string, velocity long, " \
       "_p_n long, _p_units string, _p_squares string, _p_big double, _p_bigsq double, " \
       "prev_us long, prev_transaction_id string, prev_lat double, prev_lon double, prev_country string"
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]
_NO_SUMS = (0, "0", "0", 0.0, 0.0, False, 0, "", 0.0, 0.0, "")


def _parts(state: GroupState) -> list[list[list]]:
    """The lists of each part of a group's state."""
    values = iter(state.get) if state.exists else None
    return [[list(next(values)) if values else [] for _ in columns] for columns in _PARTS.values()]


def _make_scan(window_s: int):
    window_us = window_s * 1_000_000

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wm = max(0, state.getCurrentWatermarkMs() or 0) * 1000
        upto = wm // MINUTE_US * MINUTE_US  # the minutes before this time have ended
        waiting, seen, sums = _parts(state)
        out = None
        if not state.hasTimedOut:
            for pdf in pdfs:
                for old, new in zip(waiting, lists_of(pdf[pdf["us"] >= wm], _ROW), strict=True):
                    old += new
        due = np.asarray(waiting[1], np.int64) < upto
        if due.any():
            rows = [[v for v, d in zip(x, due, strict=True) if d] for x in waiting]
            waiting = [[v for v, d in zip(x, due, strict=True) if not d] for x in waiting]
            known = dict(zip(sums[0], zip(*sums[1:], strict=True), strict=True))
            out, seen = _scan(rows, seen, known, upto, window_us)
            sums = [list(known), *map(list, zip(*known.values(), strict=True))]
        if state.hasTimedOut or not due.any():
            reached = [us >= upto - window_us for us in seen[1]]
            seen = [[v for v, r in zip(x, reached, strict=True) if r] for x in seen]
        if waiting[0] or sums[0]:
            state.update((*waiting, *seen, *sums))
        if waiting[0]:
            state.setTimeoutTimestamp((min(waiting[1]) // MINUTE_US + 1) * MINUTE_US // 1000 - 1)
        elif seen[0]:
            state.setTimeoutTimestamp((max(max(seen[1]), wm) + window_us + MINUTE_US) // 1000)
        if out is not None:
            yield out

    return fn


def _scan(rows: list[list], seen: list[list], known: dict, upto: int, window_us: int) -> tuple[pd.DataFrame, list[list]]:
    """The rows whose minutes have ended with what comes before them, and the times that later windows can reach.  ``known`` (card
    to sums) is brought up to date."""
    order = pd.DataFrame({"us": rows[1], "id": rows[2]}).sort_values(["us", "id"]).index.to_numpy()
    before = dict(by_card(seen[0], np.asarray(seen[1], np.int64)))
    out, cards, reached = [], [], []
    for card, part in by_card([rows[0][i] for i in order], order):
        _, *columns = ([x[i] for i in part] for x in rows)
        us = np.asarray(columns[0], np.int64)
        times = np.concatenate([before[card], us]) if card in before else us  # those sent out before are older
        velocity = np.searchsorted(times, us, "right") - np.searchsorted(times, us - window_us, "left")
        n, units, squares, big, bigsq, *last = known.get(card, _NO_SUMS)
        units, squares = int(units), int(squares)
        for at, tid, unit, rest, amount, lat, lon, country, v in zip(*columns, velocity.tolist(), strict=True):
            prev = last[1:] if last[0] else (None, None, None, None, None)
            out.append((tid, card, at, amount, lat, lon, country, v, n, str(units), str(squares), big, bigsq, *prev))
            n, units, squares, big, bigsq = n + 1, units + unit, squares + unit * unit, big + rest, bigsq + rest * rest
            if lat is not None and lon is not None and not (lat == 0.0 and lon == 0.0):
                last = [True, at, tid, lat, lon, country]
        known[card] = (n, str(units), str(squares), big, bigsq, *last)
        before[card] = times
    for card, times in before.items():
        times = times[np.searchsorted(times, upto - window_us, "left"):]
        cards += [card] * len(times)
        reached += times.tolist()
    return pd.DataFrame(dict(zip(_COLUMNS, map(list, zip(*out, strict=True)), strict=True))).astype({"prev_us": "Int64", "us": "int64"}), [cards, reached]


def score_event_time_stream(
    silver_stream: DataFrame,
    velocity_window_s: int = 3600,
    velocity_threshold: int = S.VELOCITY_THRESHOLD,
    min_km: float = S.TRAVEL_MIN_KM,
    max_gap_s: int = S.TRAVEL_MAX_GAP_S,
    watermark: str | None = S.WATERMARK_DELAY,
    card_groups: int = CARD_GROUPS,
) -> DataFrame:
    """W5 on a stream: the columns of ``detect.score_event_time`` for each row, once the watermark has passed its minute.  Pass
    ``watermark=None`` when the stream carries one.  ``card_groups`` is part of the state: a checkpoint keeps to its number."""
    units = (exact_money("amount") * F.lit(100_000_000).cast("decimal(9,0)")).cast("long")
    src = silver_stream.select("transaction_id", "card_id", "event_time", "amount", "lat", "lon", "country",
                               F.coalesce(units, F.lit(0)).alias("units"), F.coalesce(rest_money("amount"), F.lit(0.0)).alias("big"), F.unix_micros("event_time").alias("us"),
                               card_group("card_id", card_groups).alias("card_group"))
    if watermark:
        src = src.withWatermark("event_time", watermark)
    out = src.groupBy("card_group").applyInPandasWithState(
        _make_scan(velocity_window_s), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    exact = lambda c, scale: F.col(c).cast("decimal(38,0)").cast("double") / F.lit(scale)
    rows = out.withColumns({
        "event_time": F.timestamp_micros("us"), "prev_event_time": F.timestamp_micros("prev_us"),
        "_p_sum": exact("_p_units", 1e8), "_p_sumsq": exact("_p_squares", 1e16)}).drop("us", "prev_us", "_p_units", "_p_squares")
    t = detect.with_travel(detect.with_prior(rows), min_km, max_gap_s)
    return scored(t.withColumnRenamed("velocity", "velocity_60m"), velocity_threshold)


def scored(t: DataFrame, velocity_threshold: int) -> DataFrame:
    z = F.when((F.col("prior_n") >= 2) & (F.col("prior_std") > 0), (F.col("amount") - F.col("prior_mean")) / F.col("prior_std"))
    return t.withColumns({
        "amount_zscore": F.coalesce(z, F.lit(0.0)), "velocity_flag": F.col("velocity_60m") >= velocity_threshold,
        "geo_anomaly_flag": F.coalesce("travel_flag", F.lit(False))}).withColumn(
        "fraud_score", composite_score("velocity_flag", "amount_zscore", "geo_anomaly_flag")).drop("travel_flag")
