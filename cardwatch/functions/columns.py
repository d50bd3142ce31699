"""Column expressions (no UDFs): they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwatch import schema as S


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ts: str | Column = "timestamp") -> Column:
    """ISO-8601 text -> timestamp; malformed text gives NULL (ANSI-safe)."""
    return F.try_to_timestamp(col_(ts))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = S.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km; ``1 - a`` is clamped at 0 against rounding."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dphi = F.radians(col_(lat2) - col_(lat1))
    dlmb = F.radians(col_(lon2) - col_(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(radius_km) * 2 * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def has_location(lat="lat", lon="lon") -> Column:
    """(0, 0) and NULL mean "no location" (online merchants)."""
    return col_(lat).isNotNull() & col_(lon).isNotNull() & ~((col_(lat) == 0.0) & (col_(lon) == 0.0))


def zscore(amount, mean, std) -> Column:
    """(amount - mean) / std when std is non-NULL and > 0, else 0.0."""
    s = col_(std)
    return (
        F.when(s.isNotNull() & (s > 0), (col_(amount) - col_(mean)) / s)
        .otherwise(F.lit(0.0))
        .cast("double")
    )


def composite_score(
    velocity_flag,
    z,
    geo_flag,
    w_velocity: float = S.VELOCITY_WEIGHT,
    w_z: float = S.ZSCORE_WEIGHT,
    w_geo: float = S.GEO_WEIGHT,
    z_cap: float = S.ZSCORE_CAP,
) -> Column:
    """velocity 40% + min(|z|, 5)/5 * 40% + geo 20%, summed in this order.

    A NULL flag adds 0 (``when`` falls through to ``otherwise``).
    """
    return (
        F.when(col_(velocity_flag), F.lit(w_velocity)).otherwise(F.lit(0.0))
        + F.least(F.abs(col_(z)), F.lit(z_cap)) / F.lit(z_cap) * F.lit(w_z)
        + F.when(col_(geo_flag), F.lit(w_geo)).otherwise(F.lit(0.0))
    ).cast("double")


def zscore_bucket(z="amount_zscore") -> Column:
    """Bucket label; the last label also takes exactly 3, NULL and NaN."""
    z = col_(z)
    expr = None
    for upper, label in S.ZSCORE_BUCKETS:
        expr = (F.when if expr is None else expr.when)(z < upper, F.lit(label))
    return expr.otherwise(F.lit(S.ZSCORE_TOP_BUCKET))


def zscore_bucket_ord(z="amount_zscore") -> Column:
    """Numeric order of ``zscore_bucket`` (0 = lowest)."""
    z = col_(z)
    expr = None
    for i, (upper, _) in enumerate(S.ZSCORE_BUCKETS):
        expr = (F.when if expr is None else expr.when)(z < upper, F.lit(i))
    return expr.otherwise(F.lit(len(S.ZSCORE_BUCKETS)))


def alert_fraud_type(c="fraud_type") -> Column:
    """NULL or empty fraud type -> ``unknown``."""
    return F.coalesce(F.nullif(col_(c), F.lit("")), F.lit(S.UNKNOWN_FRAUD_TYPE))


def pct(part, whole, digits: int | None = None) -> Column:
    """100 * part / whole; NULL when whole is 0."""
    v = F.try_divide(col_(part).cast("double") * F.lit(100.0), col_(whole).cast("double"))
    return F.round(v, digits) if digits is not None else v


#: Below this, amounts are summed as exact decimals; squares of a hundred million rows still fit.
EXACT_BELOW = 1e7


def exact_money(c) -> Column:
    """The amount as a decimal with 8 places if it is below 10 million, else 0."""
    small = F.abs(col_(c)) < EXACT_BELOW
    return F.when(small, col_(c)).when(col_(c).isNotNull(), 0.0).cast("decimal(15,8)")


def rest_money(c) -> Column:
    """The amount if ``exact_money`` does not hold it, else 0.0."""
    return F.when(F.abs(col_(c)) < EXACT_BELOW, 0.0).otherwise(col_(c))


def money_sum(c) -> Column:
    """Sum of a money column: exact, and so independent of order, for ordinary
    amounts; larger ones are added as doubles and end no job."""
    return F.sum(exact_money(c)).cast("double") + F.sum(rest_money(c))


def money_avg(c) -> Column:
    """Mean of a money column from ``money_sum``."""
    return money_sum(c) / F.count(col_(c))


def to_ntz(ts) -> Column:
    return col_(ts).cast("timestamp_ntz")
