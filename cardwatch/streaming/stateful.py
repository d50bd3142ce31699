"""Per-card trailing velocity and impossible travel across micro-batches.

SQL range frames are batch-only, so on a stream the cards' recent event
times and located transactions are kept as keyed state
(``applyInPandasWithState``; RocksDB when the session sets it).  The key is a
group of cards (a hash of the card): a call of Python, of which one takes
milliseconds, does the rows of many cards and not of one.  State is
bounded: times older than the window are evicted and the whole state times
out when the watermark passes the group's last event + window.  Rows older than
the watermark are ignored, like other stateful operators do.

The counts equal the batch ``rolling_count`` (RANGE frame, equal timestamps
counted together) when rows arrive in event-time order across batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardwatch import schema as S

OUTPUT_SCHEMA = "transaction_id string, card_id string, us long, velocity long, travel_flag boolean"
STATE_SCHEMA = (
    "times_card array<string>, times array<long>, loc_card array<string>, loc_us array<long>, loc_id array<string>, "
    "loc_lat array<double>, loc_lon array<double>, loc_country array<string>"
)
#: Groups that the cards are dealt to.  A group's rows of a micro-batch and its state are in memory together.
CARD_GROUPS = 256


def card_group(card: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(card), F.lit(groups)).cast("int")


def lists_of(pdf: pd.DataFrame, columns: dict[str, str]) -> list[list]:
    """The named columns as lists of Python values, missing ones None."""
    out = []
    for c, t in columns.items():
        x = pdf[c].astype("int64") if t == "long" else pdf[c]
        missing = x.isna()
        out.append(x.astype(object).where(~missing, None).tolist() if missing.any() else x.tolist())
    return out


def by_card(cards, values: np.ndarray) -> Iterator[tuple[str | None, np.ndarray]]:
    """Each card with its values, in their order."""
    codes, names = pd.factorize(np.asarray(cards, dtype=object), use_na_sentinel=False)
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(names)))
    for name, part in zip(names, np.split(values[order], ends[:-1]) if len(names) else (), strict=True):
        yield (None if pd.isna(name) else name), part


def _haversine_np(lat1, lon1, lat2, lon2, r=S.EARTH_RADIUS_KM):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    a = np.clip(a, 0.0, 1.0)
    return r * 2 * np.arctan2(np.sqrt(a), np.sqrt(1.0 - a))


def _make_fn(window_s: int, min_km: float, max_gap_s: int):
    w_us, gap_us = window_s * 1_000_000, max_gap_s * 1_000_000
    keep_us = max(w_us, gap_us)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(pdfs), ignore_index=True)
        wm = max(0, state.getCurrentWatermarkMs() or 0) * 1000
        pdf = pdf[pdf["us"] >= wm]
        if not len(pdf):
            return
        pdf = pdf.sort_values(["us", "transaction_id"], ignore_index=True)
        us = pdf["us"].to_numpy(np.int64)
        old = state.get if state.exists else ([], [], [], [], [], [], [], [])
        known = dict(by_card(old[0], np.asarray(old[1], np.int64)))
        velocity = np.zeros(len(pdf), np.int64)
        for card, rows in by_card(pdf["card_id"], np.arange(len(pdf))):
            at = us[rows]
            times = known[card] = np.sort(np.concatenate([known[card], at])) if card in known else at
            velocity[rows] = np.searchsorted(times, at, "right") - np.searchsorted(times, at - w_us, "left")

        lat, lon = pdf["lat"].to_numpy(float), pdf["lon"].to_numpy(float)
        located = ~(np.isnan(lat) | np.isnan(lon) | ((lat == 0.0) & (lon == 0.0)))
        seen = pd.DataFrame({"card": old[2], "us": old[3], "id": old[4], "lat": old[5], "lon": old[6], "country": old[7], "row": -1})
        here = pd.DataFrame({"card": pdf["card_id"], "us": us, "id": pdf["transaction_id"], "lat": lat, "lon": lon,
                             "country": pdf["country"], "row": np.arange(len(pdf))})[located]
        # the located rows in order; each one's predecessor may have come in an earlier batch or be late itself
        loc = pd.concat([seen, here], ignore_index=True) if len(seen) else here
        loc = loc.assign(code=pd.factorize(loc["card"], use_na_sentinel=False)[0]).sort_values(["code", "us", "id"], ignore_index=True)
        travel = np.zeros(len(pdf), dtype=bool)
        if len(loc) > 1:
            prev, cur = loc.iloc[:-1].reset_index(drop=True), loc.iloc[1:].reset_index(drop=True)
            gap = cur["us"].to_numpy(np.int64) - prev["us"].to_numpy(np.int64)
            far = _haversine_np(*(x.to_numpy(float) for x in (prev["lat"], prev["lon"], cur["lat"], cur["lon"]))) >= min_km
            other = (cur["country"] != prev["country"]) & cur["country"].notna() & prev["country"].notna()
            flag = far & other.to_numpy(bool) & (gap <= gap_us) & (cur["code"] == prev["code"]).to_numpy(bool)
            new = cur["row"].to_numpy(int) >= 0
            travel[cur["row"].to_numpy(int)[new]] = flag[new]

        # rows as old as the watermark may still come, and look back by the longer of the two rules
        known = {c: t[np.searchsorted(t, wm - keep_us, "left"):] for c, t in known.items()}
        cards = [c for c, t in known.items() for _ in range(len(t))]
        times = np.concatenate(list(known.values()))
        loc = loc[loc["us"] >= wm - keep_us]
        state.update((cards, times.tolist(), *lists_of(
            loc, {"card": "string", "us": "long", "id": "string", "lat": "double", "lon": "double", "country": "string"})))
        state.setTimeoutTimestamp(int(times.max() + keep_us) // 1000 + 1)
        yield pd.DataFrame({
            "transaction_id": pdf["transaction_id"], "card_id": pdf["card_id"], "us": us,
            "velocity": velocity, "travel_flag": travel,
        })

    return fn


def velocity_stateful(
    silver_stream: DataFrame,
    window_s: int = 3600,
    min_km: float = S.TRAVEL_MIN_KM,
    max_gap_s: int = S.TRAVEL_MAX_GAP_S,
    watermark: str | None = S.WATERMARK_DELAY,
    card_groups: int = CARD_GROUPS,
) -> DataFrame:
    """Stream of (transaction, trailing count, travel flag) per card.

    ``silver_stream`` needs ``card_id``, ``transaction_id``, ``event_time``,
    ``lat``, ``lon`` and ``country``.  A late row (within the watermark) is
    counted and compared in its place; rows sent out before it are not sent
    again.  Times cross into Python as microseconds, so the session's time zone
    has no part in them.  Pass ``watermark=None`` when the
    stream already carries one (e.g. the silver stream).
    ``card_groups`` is part of the state: a checkpoint keeps to its number.
    The per-row Python work is a vectorised count per card.
    """
    src = silver_stream.select("transaction_id", "card_id", "event_time", "lat", "lon", "country",
                               F.unix_micros("event_time").alias("us"), card_group("card_id", card_groups).alias("card_group"))
    if silver_stream.isStreaming and watermark:
        src = src.withWatermark("event_time", watermark)
    out = src.groupBy("card_group").applyInPandasWithState(
        _make_fn(window_s, min_km, max_gap_s),
        OUTPUT_SCHEMA,
        STATE_SCHEMA,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return out.select("transaction_id", "card_id", F.timestamp_micros("us").alias("event_time"), "velocity", "travel_flag")
