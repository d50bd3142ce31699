"""Independent DuckDB SQL for each registered query (the correctness oracle).

Tables are the pre-registered views over the test parquet files.  Doubles are
written ``::DOUBLE`` so that arithmetic is done in doubles as in Spark.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _fix_round(sql: str) -> str:
    """``round(x, d)`` -> HALF_UP rounding of the decimal value (as Spark)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 0, j + len("round(")
        start = k
        comma = None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        arg, digits = sql[start:comma], sql[comma + 1:k].strip()
        out.append(f"round(CAST(({_fix_round(arg)}) AS DECIMAL(38,12)), {digits})::DOUBLE")
        i = k + 1

# --- shared CTEs ---------------------------------------------------------------

def _pad(expr: str, width: int) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"CASE WHEN length({s}) < {width} THEN lpad({s}, {width}, '0') ELSE {s} END"


def tx_cte(src: str = "events", name: str = "tx") -> str:
    """The events -> transactions adapter (same rules as events_adapter)."""
    return f"""
{name}_0 AS (
  SELECT *,
    (event_type = 'error' AND event_id % 5 = 0) AS _tv,
    CASE WHEN event_type = 'signup' THEN 'US'
         WHEN event_type = 'error' AND event_id % 5 = 0 THEN CASE WHEN user_id % 10 = 7 THEN 'BR' ELSE 'JP' END
         ELSE ['US','GB','CA','DE','FR','AU','SG','JP','BR','MX'][CAST(user_id % 10 AS INTEGER) + 1]
    END AS _country,
    CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'impossible_travel'
         WHEN event_type = 'purchase' AND value >= 200.0::DOUBLE THEN 'amount_spike'
    END AS _ftype
  FROM {src}
),
{name} AS (
  SELECT
    'TXN-' || {_pad('event_id', 10)} AS transaction_id,
    'CARD-' || {_pad('user_id', 4)} AS card_id,
    CAST(value AS DOUBLE) AS amount,
    'MERCH-' || {_pad('event_id % 200', 4)} AS merchant_id,
    CASE event_type WHEN 'click' THEN 'grocery' WHEN 'view' THEN 'restaurant' WHEN 'purchase' THEN 'retail'
                    WHEN 'signup' THEN 'online' WHEN 'error' THEN 'travel' END AS merchant_category,
    CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE
      CASE _country WHEN 'US' THEN 40.71 WHEN 'GB' THEN 51.51 WHEN 'CA' THEN 43.65 WHEN 'DE' THEN 52.52
        WHEN 'FR' THEN 48.85 WHEN 'AU' THEN -33.87 WHEN 'SG' THEN 1.35 WHEN 'JP' THEN 35.68
        WHEN 'BR' THEN -23.55 WHEN 'MX' THEN 19.43 END::DOUBLE END AS lat,
    CASE WHEN event_type = 'signup' THEN 0.0::DOUBLE ELSE
      CASE _country WHEN 'US' THEN -74.01 WHEN 'GB' THEN -0.13 WHEN 'CA' THEN -79.38 WHEN 'DE' THEN 13.40
        WHEN 'FR' THEN 2.35 WHEN 'AU' THEN 151.21 WHEN 'SG' THEN 103.82 WHEN 'JP' THEN 139.69
        WHEN 'BR' THEN -46.63 WHEN 'MX' THEN -99.13 END::DOUBLE END AS lon,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
    _country AS country,
    _ftype IS NOT NULL AS is_fraud,
    _ftype AS fraud_type
  FROM {name}_0
)"""


TX = tx_cte()

# replayed (every 10th event twice) and dirtied (bad amount / bad time)
DIRTY = tx_cte("(SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)", "rtx") + """,
dirty AS (
  SELECT transaction_id, card_id,
    CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 50 = 0 THEN -1.0::DOUBLE ELSE amount END AS amount,
    merchant_id, merchant_category, lat, lon,
    CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 50 = 1 THEN 'junk' ELSE timestamp END AS timestamp,
    country, is_fraud, fraud_type
  FROM rtx
),
dirty_t AS (SELECT *, try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM dirty),
dirty_r AS (
  SELECT *, CASE
    WHEN transaction_id IS NULL THEN 'missing_transaction_id'
    WHEN card_id IS NULL THEN 'missing_card_id'
    WHEN amount IS NULL THEN 'missing_amount'
    WHEN isnan(amount) THEN 'nan_amount'
    WHEN amount <= 0 THEN 'non_positive_amount'
    WHEN event_time IS NULL THEN 'bad_event_time'
  END AS reject_reason FROM dirty_t
)"""

SILVER = TX + """,
silver AS (
  SELECT DISTINCT *, try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM tx
  WHERE transaction_id IS NOT NULL AND card_id IS NOT NULL AND amount IS NOT NULL AND amount > 0
    AND NOT isnan(amount) AND try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') IS NOT NULL
)"""

GOLD = SILVER + """,
stats AS (
  SELECT card_id, count(*) AS velocity_60m, avg(amount) AS avg_amount_60m, stddev_samp(amount) AS sd
  FROM silver GROUP BY card_id
),
gold_0 AS (
  SELECT s.*, st.velocity_60m, st.avg_amount_60m,
    CASE WHEN st.sd IS NOT NULL AND st.sd > 0 THEN (s.amount - st.avg_amount_60m) / st.sd ELSE 0.0::DOUBLE END
      AS amount_zscore,
    st.velocity_60m >= 8 AS velocity_flag,
    s.fraud_type = 'impossible_travel' AS geo_anomaly_flag
  FROM silver s LEFT JOIN stats st ON s.card_id = st.card_id
),
gold AS (
  SELECT *,
    (CASE WHEN velocity_flag THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END
     + least(abs(amount_zscore), 5.0::DOUBLE) / 5.0::DOUBLE * 0.4::DOUBLE
     + CASE WHEN geo_anomaly_flag THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END) AS fraud_score
  FROM gold_0
)"""


def q(name: str, sql: str) -> None:
    ORACLE[name] = _fix_round(sql.strip())


# --- minimum slice ---------------------------------------------------------------

q("fraud_score", f"""WITH {GOLD}
SELECT transaction_id, card_id, event_time, amount, velocity_60m, round(amount_zscore, 6) AS amount_zscore,
  velocity_flag, geo_anomaly_flag, round(fraud_score, 6) AS fraud_score,
  fraud_score >= 0.7::DOUBLE AS is_alert
FROM gold""")

q("alerts", f"""WITH {GOLD}
SELECT transaction_id, card_id, coalesce(nullif(fraud_type, ''), 'unknown') AS fraud_type, amount,
  merchant_category, country, timestamp, round(fraud_score, 6) AS confidence_score
FROM gold WHERE fraud_score >= 0.7::DOUBLE""")

q("alerts_payload", f"""WITH {GOLD}
SELECT transaction_id AS key,
  to_json({{'transaction_id': transaction_id, 'card_id': card_id,
    'fraud_type': coalesce(nullif(fraud_type, ''), 'unknown'), 'amount': amount,
    'merchant_category': merchant_category, 'country': country, 'timestamp': timestamp,
    'confidence_score': round(fraud_score, 6)}})::VARCHAR AS value
FROM gold WHERE fraud_score >= 0.7::DOUBLE""")

q("card_stats", f"""WITH {SILVER}
SELECT card_id, count(*) AS velocity_60m,
  round(sum(CAST(amount AS DECIMAL(18,2)))::DOUBLE / count(*), 6) AS avg_amount,
  round(stddev_samp(amount), 6) AS stddev_amount
FROM silver GROUP BY card_id""")

q("card_zscore", f"""WITH {GOLD}
SELECT transaction_id, card_id, round(amount_zscore, 6) AS amount_zscore FROM gold""")

q("card_stats_join", f"""WITH {GOLD}
SELECT transaction_id, card_id, velocity_60m, round(amount_zscore, 6) AS amount_zscore FROM gold""")

# --- bronze / silver -------------------------------------------------------------

q("bronze_decode", f"""WITH {TX}
SELECT tx.*, strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') AS kafka_ingest_time FROM tx""")

q("bronze_batch_ingest", f"""WITH {TX} SELECT * FROM tx""")

q("event_time_parse", f"""WITH {DIRTY}
SELECT transaction_id, timestamp, event_time FROM dirty_t""")

q("silver_validate", f"""WITH {DIRTY}
SELECT transaction_id, card_id, amount, event_time FROM dirty_r WHERE reject_reason IS NULL""")

q("silver_rejects", f"""WITH {DIRTY}
SELECT transaction_id, amount, timestamp, reject_reason FROM dirty_r WHERE reject_reason IS NOT NULL""")

q("silver_dedup", f"""WITH {DIRTY}
SELECT DISTINCT transaction_id, card_id, amount, event_time FROM dirty_r WHERE reject_reason IS NULL""")

q("silver_drop_rate", f"""WITH {DIRTY},
k AS (
  SELECT transaction_id, event_time, reject_reason IS NULL AS valid, count(*) AS n
  FROM dirty_r GROUP BY ALL
),
a AS (
  SELECT sum(n)::BIGINT AS bronze_rows,
    coalesce(sum(CASE WHEN NOT valid THEN n END), 0)::BIGINT AS invalid_rows,
    coalesce(sum(CASE WHEN valid THEN n - 1 END), 0)::BIGINT AS duplicate_rows,
    count(*) FILTER (WHERE valid) AS silver_rows
  FROM k
)
SELECT *, round(CASE WHEN bronze_rows = 0 THEN NULL
  ELSE (bronze_rows - silver_rows)::DOUBLE * 100.0::DOUBLE / bronze_rows::DOUBLE END, 2) AS drop_rate_pct
FROM a""")

# --- exploration -------------------------------------------------------------------

q("fraud_by_type", f"""WITH {GOLD}
SELECT fraud_type, count(*) AS count, round(avg(fraud_score), 3) AS avg_score,
  round(avg(amount), 2) AS avg_amount, round(max(amount), 2) AS max_amount
FROM gold GROUP BY fraud_type""")

q("top_risk_cards", f"""WITH {GOLD},
g AS (
  SELECT card_id, fraud_type, count(*) AS flagged_events, round(max(fraud_score), 3) AS peak_score,
    round(max(amount), 2) AS max_amount, round(avg(velocity_60m), 1) AS avg_velocity
  FROM gold WHERE fraud_score >= 0.7::DOUBLE GROUP BY card_id, fraud_type
)
SELECT * FROM g ORDER BY peak_score DESC, card_id ASC NULLS FIRST, fraud_type ASC NULLS FIRST LIMIT 20""")

ZB = """CASE WHEN amount_zscore < -1 THEN '< -1' WHEN amount_zscore < 0 THEN '-1 to 0'
  WHEN amount_zscore < 1 THEN '0 to 1' WHEN amount_zscore < 2 THEN '1 to 2'
  WHEN amount_zscore < 3 THEN '2 to 3' ELSE '> 3' END"""
ZO = """CASE WHEN amount_zscore < -1 THEN 0 WHEN amount_zscore < 0 THEN 1 WHEN amount_zscore < 1 THEN 2
  WHEN amount_zscore < 2 THEN 3 WHEN amount_zscore < 3 THEN 4 ELSE 5 END"""

q("zscore_distribution", f"""WITH {GOLD}
SELECT {ZB} AS zscore_bucket, {ZO} AS bucket_ord, is_fraud, count(*) AS count
FROM gold GROUP BY ALL""")

q("fraud_by_country", f"""WITH {GOLD}
SELECT country, count(*) AS total_events, count(*) FILTER (WHERE is_fraud) AS fraud_events,
  round(count(*) FILTER (WHERE is_fraud)::DOUBLE / count(*)::DOUBLE * 100, 2) AS fraud_rate_pct
FROM gold GROUP BY country""")

q("layer_summary", f"""WITH {GOLD},
c AS (
  SELECT (SELECT count(*) FROM tx) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
    (SELECT count(*) FROM gold) AS gold_rows,
    (SELECT count(*) FROM gold WHERE fraud_score >= 0.7::DOUBLE) AS high_confidence
)
SELECT *, bronze_rows - silver_rows AS dropped,
  round(CASE WHEN gold_rows = 0 THEN NULL
    ELSE high_confidence::DOUBLE * 100.0::DOUBLE / gold_rows::DOUBLE END, 2) AS high_pct
FROM c""")

q("fraud_rate", f"""WITH {TX}
SELECT count(*) AS total_events, count(*) FILTER (WHERE is_fraud) AS fraud_events,
  round(avg(CAST(is_fraud AS INTEGER)), 6) AS fraud_rate
FROM tx""")

q("alert_confusion", f"""WITH {GOLD}
SELECT coalesce(fraud_type, 'none') AS label, count(*) AS events,
  count(*) FILTER (WHERE fraud_score >= 0.7::DOUBLE) AS alerted, round(avg(fraud_score), 6) AS avg_score,
  round(count(*) FILTER (WHERE fraud_score >= 0.7::DOUBLE)::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE, 2)
    AS alert_rate_pct
FROM gold GROUP BY 1""")

q("alert_precision", f"""WITH {GOLD},
c AS (
  SELECT count(*) FILTER (WHERE fraud_score >= 0.7::DOUBLE AND coalesce(is_fraud, false)) AS true_pos,
    count(*) FILTER (WHERE fraud_score >= 0.7::DOUBLE AND NOT coalesce(is_fraud, false)) AS false_pos,
    count(*) FILTER (WHERE NOT fraud_score >= 0.7::DOUBLE AND coalesce(is_fraud, false)) AS false_neg,
    count(*) FILTER (WHERE NOT fraud_score >= 0.7::DOUBLE AND NOT coalesce(is_fraud, false)) AS true_neg
  FROM gold
)
SELECT *, round(CASE WHEN true_pos + false_pos = 0 THEN NULL ELSE true_pos::DOUBLE / (true_pos + false_pos) END, 6)
    AS precision,
  round(CASE WHEN true_pos + false_neg = 0 THEN NULL ELSE true_pos::DOUBLE / (true_pos + false_neg) END, 6) AS recall
FROM c""")

q("top_scores", f"""WITH {GOLD}
SELECT transaction_id, card_id, fraud_type, amount, velocity_60m, round(amount_zscore, 6) AS amount_zscore,
  round(fraud_score, 6) AS fraud_score, country, timestamp
FROM gold ORDER BY round(fraud_score, 6) DESC, transaction_id LIMIT 20""")

q("recent_fraud", f"""WITH {TX}
SELECT transaction_id, card_id, amount, fraud_type, timestamp FROM tx WHERE is_fraud
ORDER BY timestamp DESC, transaction_id LIMIT 20""")

q("recent_silver", f"""WITH {SILVER}
SELECT transaction_id, card_id, amount, merchant_id, country, fraud_type, event_time FROM silver
ORDER BY event_time DESC, transaction_id LIMIT 10""")

# --- sequence detectors and profiles ------------------------------------------------

LOC = "lat IS NOT NULL AND lon IS NOT NULL AND NOT (lat = 0 AND lon = 0)"


def _travel(max_gap_s: int) -> str:
    return f"""WITH {SILVER},
loc AS (SELECT * FROM silver WHERE {LOC}),
p AS (
  SELECT *, lag(transaction_id) OVER w AS prev_transaction_id, lag(event_time) OVER w AS prev_event_time,
    lag(country) OVER w AS prev_country, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
  FROM loc WINDOW w AS (PARTITION BY card_id ORDER BY event_time, transaction_id)
),
a AS (
  SELECT *, greatest(least(pow(sin(radians(lat - prev_lat) / 2), 2)
      + cos(radians(prev_lat)) * cos(radians(lat)) * pow(sin(radians(lon - prev_lon) / 2), 2), 1.0::DOUBLE), 0.0::DOUBLE) AS hav,
    (epoch_us(event_time) - epoch_us(prev_event_time))::DOUBLE / 1000000.0::DOUBLE AS gap_s
  FROM p
),
d AS (SELECT *, 6371.0::DOUBLE * 2 * atan2(sqrt(hav), sqrt(1.0::DOUBLE - hav)) AS distance_km FROM a)"""


q("impossible_travel", _travel(3600) + """
SELECT transaction_id, card_id, event_time, country, prev_transaction_id, prev_country,
  round(distance_km, 3) AS distance_km, gap_s
FROM d WHERE country <> prev_country AND distance_km >= 2000.0::DOUBLE AND gap_s <= 3600""")

q("impossible_travel_5m", _travel(300) + """
SELECT transaction_id, card_id, event_time, country, prev_transaction_id, prev_country,
  round(distance_km, 3) AS distance_km, gap_s
FROM d WHERE country <> prev_country AND distance_km >= 2000.0::DOUBLE AND gap_s <= 300""")

q("haversine", _travel(300) + """
SELECT transaction_id, prev_transaction_id, round(distance_km, 3) AS distance_km
FROM d WHERE prev_transaction_id IS NOT NULL""")


def _velocity(window_s: int, threshold: int) -> str:
    return f"""WITH {SILVER}
SELECT transaction_id, card_id, event_time,
  count(*) OVER (PARTITION BY card_id ORDER BY event_time
    RANGE BETWEEN INTERVAL '{window_s} seconds' PRECEDING AND CURRENT ROW) AS velocity,
  count(*) OVER (PARTITION BY card_id ORDER BY event_time
    RANGE BETWEEN INTERVAL '{window_s} seconds' PRECEDING AND CURRENT ROW) >= {threshold} AS velocity_flag
FROM silver"""


q("velocity_rolling", _velocity(86400, 8))
q("velocity_60s", _velocity(60, 8))

q("burst_sessions", f"""WITH {SILVER},
s AS (
  SELECT card_id, event_time, amount,
    CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL '7200 seconds'
      THEN 1 ELSE 0 END AS brk
  FROM silver WINDOW w AS (PARTITION BY card_id ORDER BY event_time)
),
g AS (SELECT *, sum(brk) OVER (PARTITION BY card_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT card_id, min(event_time) AS session_start, max(event_time) AS session_end, count(*) AS n_txn,
  sum(CAST(amount AS DECIMAL(28,8)))::DOUBLE AS total_amount
FROM g GROUP BY card_id, sid HAVING count(*) >= 4""")

PRIOR = f"""WITH {SILVER},
p AS (
  SELECT *, count(*) OVER w AS prior_n, sum(CAST(amount AS DECIMAL(28,8))) OVER w AS prior_sum,
    stddev_samp(amount) OVER w AS prior_std
  FROM silver WINDOW w AS (PARTITION BY card_id ORDER BY event_time, transaction_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
pm AS (SELECT *, CASE WHEN prior_n > 0 THEN prior_sum::DOUBLE / prior_n END AS prior_mean FROM p)"""

q("amount_spike", PRIOR + """
SELECT transaction_id, card_id, event_time, amount, prior_n, round(prior_mean, 2) AS prior_mean,
  round(prior_std, 2) AS prior_std
FROM pm WHERE amount >= 200.0::DOUBLE AND prior_n >= 2 AND amount > prior_mean + 3.0::DOUBLE * prior_std""")

q("fraud_score_event_time", PRIOR + f""",
v AS (
  SELECT *, count(*) OVER (PARTITION BY card_id ORDER BY event_time
    RANGE BETWEEN INTERVAL '3600 seconds' PRECEDING AND CURRENT ROW) AS velocity_60m
  FROM pm
),
loc AS (SELECT * FROM silver WHERE {LOC}),
tp AS (
  SELECT transaction_id, event_time, country, lat, lon, lag(event_time) OVER w AS pe, lag(country) OVER w AS pc,
    lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
  FROM loc WINDOW w AS (PARTITION BY card_id ORDER BY event_time, transaction_id)
),
ta AS (
  SELECT *, greatest(least(pow(sin(radians(lat - plat) / 2), 2)
      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2), 1.0::DOUBLE), 0.0::DOUBLE) AS hav
  FROM tp
),
tr AS (
  SELECT transaction_id, event_time,
    coalesce(country <> pc AND 6371.0::DOUBLE * 2 * atan2(sqrt(hav), sqrt(1.0::DOUBLE - hav)) >= 2000.0::DOUBLE
      AND (epoch_us(event_time) - epoch_us(pe))::DOUBLE / 1000000.0::DOUBLE <= 300, false) AS travel
  FROM ta
),
z AS (
  SELECT v.*, coalesce(tr.travel, false) AS geo_anomaly_flag, velocity_60m >= 8 AS velocity_flag,
    CASE WHEN prior_n >= 2 AND prior_std > 0 THEN (amount - prior_mean) / prior_std ELSE 0.0::DOUBLE END
      AS amount_zscore
  FROM v LEFT JOIN tr ON v.transaction_id = tr.transaction_id AND v.event_time = tr.event_time
),
s AS (
  SELECT *, (CASE WHEN velocity_flag THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END
     + least(abs(amount_zscore), 5.0::DOUBLE) / 5.0::DOUBLE * 0.4::DOUBLE
     + CASE WHEN geo_anomaly_flag THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END) AS fraud_score
  FROM z
)
SELECT transaction_id, card_id, event_time, velocity_60m, round(amount_zscore, 6) AS amount_zscore,
  velocity_flag, geo_anomaly_flag, round(fraud_score, 6) AS fraud_score, fraud_score >= 0.7::DOUBLE AS is_alert
FROM s""")

HOME = f"""hc AS (
  SELECT card_id, country, count(*) AS n FROM silver WHERE {LOC} AND country IS NOT NULL GROUP BY ALL
),
home AS (SELECT card_id, first(country ORDER BY n DESC, country ASC) AS home_country FROM hc GROUP BY card_id)"""

q("card_profile", f"""WITH {SILVER},
{HOME},
sp AS (
  SELECT card_id, count(*) AS n_txn, quantile_disc(amount, 0.05) AS typical_spend_low,
    quantile_disc(amount, 0.95) AS typical_spend_high, min(event_time) AS first_seen, max(event_time) AS last_seen
  FROM silver GROUP BY card_id
)
SELECT sp.card_id, n_txn, typical_spend_low, typical_spend_high, home_country, first_seen, last_seen
FROM sp LEFT JOIN home ON sp.card_id = home.card_id""")

ORACLE["fraud_score_segmented"] = ORACLE["fraud_score_event_time"]

q("merchant_enrich", f"""WITH {SILVER},
mc AS (SELECT merchant_id, merchant_category AS v, count(*) AS n FROM silver WHERE merchant_category IS NOT NULL GROUP BY ALL),
mk AS (SELECT merchant_id, country AS v, count(*) AS n FROM silver WHERE country IS NOT NULL GROUP BY ALL),
c AS (SELECT merchant_id, first(v ORDER BY n DESC, v ASC) AS merchant_home_category FROM mc GROUP BY 1),
k AS (SELECT merchant_id, first(v ORDER BY n DESC, v ASC) AS merchant_home_country FROM mk GROUP BY 1)
SELECT s.transaction_id, s.merchant_id, s.merchant_category, c.merchant_home_category, k.merchant_home_country
FROM silver s LEFT JOIN c ON s.merchant_id = c.merchant_id LEFT JOIN k ON s.merchant_id = k.merchant_id""")

q("prev_txn", f"""WITH {SILVER}
SELECT transaction_id, card_id, event_time, lag(transaction_id) OVER w AS prev_transaction_id,
  lag(event_time) OVER w AS prev_event_time, lag(country) OVER w AS prev_country,
  lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
FROM silver WINDOW w AS (PARTITION BY card_id ORDER BY event_time, transaction_id)""")

q("foreign_txn", f"""WITH {SILVER},
{HOME}
SELECT s.transaction_id, s.card_id, s.country, h.home_country,
  coalesce(({LOC.replace('lat', 's.lat').replace('lon', 's.lon')}) AND s.country <> h.home_country, false) AS is_foreign
FROM silver s LEFT JOIN home h ON s.card_id = h.card_id""")

# --- metrics -------------------------------------------------------------------------


def _slide(size_s: int, step_s: int, by_label: bool) -> str:
    k, us = size_s // step_s, step_s * 1_000_000
    grp = "start, is_fraud" if by_label else "start"
    lab = "is_fraud" if by_label else "NULL::BOOLEAN AS is_fraud"
    return f"""(SELECT make_timestamp(start * {us}) AS window_start, make_timestamp((start + {k}) * {us}) AS window_end,
    {lab}, count(*) AS events, count(*) FILTER (WHERE coalesce(is_fraud, false)) AS fraud_events
  FROM (SELECT epoch_us(event_time) // {us} - unnest(generate_series(0, {k - 1})) AS start, is_fraud FROM silver)
  GROUP BY {grp})"""


q("events_per_minute", f"""WITH {SILVER},
u AS (SELECT 'label' AS series, * FROM {_slide(60, 15, True)} UNION ALL SELECT 'total', * FROM {_slide(60, 15, False)})
SELECT window_start, window_end, series, is_fraud, events, events * 60.0::DOUBLE / 60.0::DOUBLE AS events_per_min FROM u""")

q("fraud_rate_rolling", f"""WITH {SILVER}
SELECT window_start, window_end, events, fraud_events,
  round(fraud_events * 100.0::DOUBLE / events::DOUBLE, 6) AS fraud_rate_pct
FROM {_slide(120, 15, False)}""")

q("events_per_second", f"""WITH {SILVER}
SELECT window_start, window_end, events, events / 5.0::DOUBLE AS events_per_sec FROM {_slide(5, 1, False)}""")

q("cumulative_events", f"""WITH {SILVER},
s AS (SELECT epoch_us(event_time) // 60000000 AS step, is_fraud, count(*) AS events FROM silver GROUP BY ALL)
SELECT make_timestamp(step * 60000000) AS step_start, is_fraud, events,
  sum(events) OVER (PARTITION BY is_fraud ORDER BY step ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative_events
FROM s""")

q("health_status", f"""WITH {SILVER},
r AS (SELECT window_end, events * 1.0::DOUBLE AS events_per_min FROM {_slide(60, 15, False)}),
f AS (SELECT window_end, fraud_events * 100.0::DOUBLE / events::DOUBLE AS fraud_rate_pct FROM {_slide(120, 15, False)}),
i AS (SELECT unnest(generate_series(min(window_end), (SELECT max(window_end) FROM f), INTERVAL 15 SECOND)) AS window_end FROM r),
j AS (SELECT i.window_end, coalesce(events_per_min, 0.0::DOUBLE) AS events_per_min, fraud_rate_pct
  FROM i LEFT JOIN r ON r.window_end = i.window_end LEFT JOIN f ON f.window_end = i.window_end)
SELECT window_end, events_per_min, round(fraud_rate_pct, 6) AS fraud_rate_pct,
  CASE WHEN events_per_min < 500 THEN 'red' WHEN events_per_min < 800 THEN 'yellow' ELSE 'green' END AS rate_status,
  CASE WHEN fraud_rate_pct IS NULL THEN NULL WHEN fraud_rate_pct < 3 THEN 'green' WHEN fraud_rate_pct < 10 THEN 'yellow'
    ELSE 'red' END AS fraud_status
FROM j""")

q("layer_lag", f"""WITH {TX},
l AS (SELECT 'log_to_bronze' AS stage, CAST(round(amount * 100, 0) AS BIGINT) % 5000 / 1000.0::DOUBLE AS lag FROM tx
  UNION ALL SELECT 'event_to_gold', CAST(round(amount * 100, 0) AS BIGINT) % 30011 / 1000.0::DOUBLE FROM tx)
SELECT stage, count(lag) AS n, quantile_disc(lag, 0.5) AS p50_s, quantile_disc(lag, 0.95) AS p95_s,
  quantile_disc(lag, 0.99) AS p99_s FROM l GROUP BY stage""")

q("per_second_status", f"""WITH {SILVER},
e AS (SELECT window_end, events / 5.0::DOUBLE AS events_per_sec FROM {_slide(5, 1, False)})
SELECT window_end, events_per_sec,
  CASE WHEN events_per_sec < 10 THEN 'red' WHEN events_per_sec < 15 THEN 'yellow' WHEN events_per_sec < 30 THEN 'green'
    WHEN events_per_sec < 100 THEN 'yellow' ELSE 'red' END AS status
FROM e""")

# --- streaming jobs (results must equal the batch functions) ------------------------

q("silver_stream", f"""WITH {SILVER} SELECT transaction_id, card_id, amount, event_time FROM silver""")

_GOLD_VIEW = f"""WITH {GOLD}
SELECT transaction_id, card_id, event_time, velocity_60m, round(amount_zscore, 6) AS amount_zscore,
  velocity_flag, geo_anomaly_flag, round(fraud_score, 6) AS fraud_score, 0::BIGINT AS batch_id
FROM gold"""
q("gold_stream", _GOLD_VIEW)
q("gold_replay_idempotent", _GOLD_VIEW)

q("batch_audit", f"""WITH {GOLD}
SELECT 0::BIGINT AS batch_id, count(*) AS rows_in, count(*) FILTER (WHERE fraud_score >= 0.7::DOUBLE) AS alerts,
  round(count(*) FILTER (WHERE fraud_score >= 0.7::DOUBLE) * 100.0::DOUBLE / count(*)::DOUBLE, 2) AS alert_pct
FROM gold""")

q("alerts_stream", ORACLE["alerts_payload"])

q("velocity_stateful", f"""WITH {SILVER},
v AS (
  SELECT *, count(*) OVER (PARTITION BY card_id ORDER BY event_time
    RANGE BETWEEN INTERVAL '86400 seconds' PRECEDING AND CURRENT ROW) AS velocity FROM silver
),
tp AS (
  SELECT transaction_id, event_time, country, lat, lon, lag(event_time) OVER w AS pe, lag(country) OVER w AS pc,
    lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
  FROM silver WHERE {LOC} WINDOW w AS (PARTITION BY card_id ORDER BY event_time, transaction_id)
),
tr AS (
  SELECT transaction_id, country <> pc AND epoch_us(event_time) - epoch_us(pe) <= 300000000
    AND 6371.0::DOUBLE * 2 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2)
      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))) >= 2000 AS travel FROM tp
)
SELECT v.transaction_id, card_id, v.event_time, velocity, velocity >= 8 AS velocity_flag,
  coalesce(travel, false) AS travel_flag
FROM v LEFT JOIN tr ON v.transaction_id = tr.transaction_id""")

q("burst_sessions_stream", ORACLE["burst_sessions"])
q("events_per_minute_stream", f"""WITH {SILVER}
SELECT window_start, window_end, is_fraud, events FROM {_slide(60, 15, True)}""")
q("cumulative_events_stream", f"""WITH {SILVER}
SELECT is_fraud, count(*) AS cumulative_events FROM silver GROUP BY is_fraud""")

q("score_event_time_stream", f"""SELECT * FROM ({ORACLE["fraud_score_event_time"]})
WHERE epoch_us(event_time) // 60000000 + 1 <= (SELECT (max(epoch_us(ts)) - 600000000) // 60000000 FROM events)""")

#: What a stream with the default watermark has sent of its windows when its input ends.
_PASSED = "(SELECT max(event_time) - INTERVAL 10 MINUTE FROM silver)"

q("health_status_stream", f"""SELECT h.* FROM ({ORACLE["health_status"]}) h
WHERE fraud_rate_pct IS NOT NULL AND window_end <= (WITH {SILVER} SELECT max(event_time) - INTERVAL 10 MINUTE FROM silver)""")

q("events_per_second_stream", f"""WITH {SILVER}
SELECT window_start, window_end, events, events / 5.0::DOUBLE AS events_per_sec FROM {_slide(5, 1, False)}
WHERE window_end <= {_PASSED}""")

_FAR = [_slide(n, 15, False).replace("FROM silver", "FROM far") for n in (60, 120)]
q("health_runs", f"""WITH {SILVER},
far AS (SELECT event_time, is_fraud FROM silver UNION ALL
  SELECT event_time + INTERVAL 176 YEAR, is_fraud FROM silver
  WHERE epoch_us(event_time) < (SELECT epoch_us(min(event_time)) FROM silver) + 3600000000),
r AS (SELECT window_end, events * 1.0::DOUBLE AS events_per_min FROM {_FAR[0]}),
f AS (SELECT window_end, fraud_events * 100.0::DOUBLE / events::DOUBLE AS fraud_rate_pct FROM {_FAR[1]}),
o AS (SELECT f.window_end, coalesce(events_per_min, 0.0::DOUBLE) AS events_per_min, fraud_rate_pct,
  lag(f.window_end) OVER (ORDER BY f.window_end) AS prev FROM f LEFT JOIN r ON r.window_end = f.window_end),
j AS (SELECT window_end, window_end AS last_end, events_per_min, fraud_rate_pct FROM o UNION ALL
  SELECT prev + INTERVAL 15 SECOND, window_end - INTERVAL 15 SECOND, 0.0::DOUBLE, NULL FROM o WHERE window_end > prev + INTERVAL 15 SECOND)
SELECT window_end, last_end, (epoch_us(last_end) - epoch_us(window_end)) // 15000000 + 1 AS instants, events_per_min,
  round(fraud_rate_pct, 6) AS fraud_rate_pct,
  CASE WHEN events_per_min < 500 THEN 'red' WHEN events_per_min < 800 THEN 'yellow' ELSE 'green' END AS rate_status,
  CASE WHEN fraud_rate_pct IS NULL THEN NULL WHEN fraud_rate_pct < 3 THEN 'green' WHEN fraud_rate_pct < 10 THEN 'yellow'
    ELSE 'red' END AS fraud_status
FROM j""")


def _merchants(src: str, n: str) -> str:
    return f"""m{n} AS (
  SELECT a.merchant_id, c, k FROM
    (SELECT merchant_id, first(v ORDER BY n DESC, v ASC) AS c FROM (SELECT merchant_id, merchant_category AS v, count(*) AS n FROM {src} GROUP BY ALL) GROUP BY 1) a
    JOIN (SELECT merchant_id, first(v ORDER BY n DESC, v ASC) AS k FROM (SELECT merchant_id, country AS v, count(*) AS n FROM {src} GROUP BY ALL) GROUP BY 1) b
    ON a.merchant_id = b.merchant_id)"""


_EARLY = "event_time < TIMESTAMP '2024-01-16 00:00:00'"
q("merchant_enrich_stream", f"""WITH {SILVER}, early AS (SELECT * FROM silver WHERE {_EARLY}),
{_merchants("early", "1")}, {_merchants("silver", "2")}
SELECT transaction_id, s.merchant_id, merchant_category, CASE WHEN {_EARLY} THEN m1.c ELSE m2.c END AS merchant_home_category,
  CASE WHEN {_EARLY} THEN m1.k ELSE m2.k END AS merchant_home_country
FROM silver s LEFT JOIN m1 ON s.merchant_id = m1.merchant_id LEFT JOIN m2 ON s.merchant_id = m2.merchant_id""")

q("late_drop", f"""WITH {TX}, l AS (
  SELECT *, event_time < TIMESTAMP '2024-01-04 00:00:00' AND right(transaction_id, 1) = '3' AS late
  FROM (SELECT transaction_id, timestamp::TIMESTAMP AS event_time FROM tx))
SELECT 3::BIGINT AS batches, count(*)::BIGINT AS rows_in, count(*) FILTER (WHERE late) AS late,
  count(*) FILTER (WHERE late) AS late_in_last, count(*) FILTER (WHERE NOT late) AS kept FROM l""")

q("silver_within_watermark", f"""WITH {SILVER} SELECT DISTINCT transaction_id, card_id, amount FROM silver""")

ORACLE["card_stats_merged"] = ORACLE["card_stats"]
