"""Per-key sequence primitives that never put a whole key into one task.

A plain ``Window.partitionBy(card_id)`` sends every row of a card to one
task; one card can hold a third of all rows.  These helpers partition by
``(key, time bucket)`` instead and bring in what a bucket needs from earlier
buckets:

* ``rolling_count`` / ``gap_opens`` - trailing-window counts and session
  openings: each row is also copied into the next bucket when it lies within
  the window of that bucket's start (bucket width >= window, so at most one
  copy).
* ``previous_row``   - exact "previous row" over the whole history of a key:
  inside the bucket a running ``last``, for the first rows of a bucket the
  last row of the key's latest earlier bucket.
* ``prefix_sums``    - sums over all earlier rows of a key: window sums inside
  the bucket plus the sums of all earlier buckets.

The cross-bucket parts run on a per-(key, bucket) summary table whose size is
bounded by the time span / bucket width, not by the row count.  The bucket
column carries its width in its name (``bucket_col``); helpers chained with the
same width on one DataFrame reuse one hash partitioning, and different widths
never meet.  A NULL key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_S = 3600


def bucket_col(bucket_s: int) -> str:
    return f"_b{bucket_s}"


def with_bucket(df: DataFrame, ts: str, bucket_s: int) -> DataFrame:
    """Add the bucket column = floor(ts / bucket_s) unless present."""
    b = bucket_col(bucket_s)
    if b in df.columns:
        return df
    return df.withColumn(b, F.floor(F.unix_micros(F.col(ts)) / F.lit(bucket_s * 1_000_000)).cast("long"))


def with_overlap(df: DataFrame, ts: str, overlap_s: int, bucket_s: int) -> DataFrame:
    """Rows with their bucket plus a copy in the next bucket for rows within
    ``overlap_s`` of its start (``_home`` keeps the row's own bucket, ``_us``
    its time in microseconds).  Needs ``bucket_s >= overlap_s``."""
    if bucket_s < overlap_s:
        raise ValueError("bucket_s must be >= the window / gap")
    o_us, b_us, b = overlap_s * 1_000_000, bucket_s * 1_000_000, bucket_col(bucket_s)
    d = with_bucket(df, ts, bucket_s).withColumnRenamed(b, "_home")
    us = F.unix_micros(F.col(ts))
    next_start = (F.col("_home") + 1) * F.lit(b_us)
    return d.withColumn(
        b,
        F.explode(
            F.when(us >= next_start - F.lit(o_us), F.array(F.col("_home"), F.col("_home") + 1))
            .otherwise(F.array(F.col("_home")))
        ),
    ).withColumn("_us", us)


def rolling_count(
    df: DataFrame,
    key: str,
    ts: str,
    window_s: int,
    out: str = "rolling_count",
    bucket_s: int = DEFAULT_BUCKET_S,
) -> DataFrame:
    """Rows of the same ``key`` with ``ts`` in ``[t - window_s, t]`` (peers with
    equal ``ts`` included, like a SQL RANGE frame).  ``bucket_s`` must be >=
    ``window_s``."""
    d, b = with_overlap(df, ts, window_s, bucket_s), bucket_col(bucket_s)
    w = Window.partitionBy(key, b).orderBy("_us").rangeBetween(-window_s * 1_000_000, 0)
    return (
        d.withColumn(out, F.count(F.lit(1)).over(w))
        .filter(F.col(b) == F.col("_home"))
        .drop("_home", "_us")
    )


def gap_opens(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    gap_s: int,
    out: str = "_open",
    bucket_s: int = DEFAULT_BUCKET_S,
) -> DataFrame:
    """``out`` = 1 when the row's gap to the key's previous row is more than
    ``gap_s`` (or it has none), else 0.  Only the previous ``gap_s`` seconds
    matter, so one overlap copy replaces a cross-bucket carry."""
    b_s = max(bucket_s, gap_s)
    d, b = with_overlap(df, order[0], gap_s, b_s), bucket_col(b_s)
    w = Window.partitionBy(key, b).orderBy("_us", *order[1:])
    prev = F.lag("_us").over(w)
    return (
        d.withColumn(out, (prev.isNull() | (F.col("_us") - prev > F.lit(gap_s * 1_000_000))).cast("long"))
        .filter(F.col(b) == F.col("_home"))
        .drop("_home", "_us")
    )


def previous_row(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    bucket_s: int = DEFAULT_BUCKET_S,
    where: Column | None = None,
) -> DataFrame:
    """Add ``prefix + c`` for the order columns and ``cols``: the values of the
    key's previous row in ``order`` among rows satisfying ``where`` (all rows
    when None); NULL when there is none.  Every row gets the columns."""
    carried = list(dict.fromkeys([*order, *cols]))
    rec = F.struct(*[F.col(c).alias(c) for c in carried])
    ordering = F.struct(*[F.col(c) for c in order])
    if where is not None:
        rec = F.when(where, rec)
        ordering = F.when(where, ordering)
    b = bucket_col(bucket_s)
    d = with_bucket(df, order[0], bucket_s).withColumn("_rec", rec).withColumn("_ord", ordering)
    w_in = Window.partitionBy(key, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_prev", F.last("_rec", ignorenulls=True).over(w_in))
    last = d.groupBy(key, b).agg(F.max_by("_rec", "_ord").alias("_last"))
    w_c = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(key, b, F.last("_last", ignorenulls=True).over(w_c).alias("_carry"))
    out = _carry_join(d, carry, key, b).withColumn("_prev", F.coalesce("_prev", "_carry"))
    keep = [c for c in d.columns if c not in ("_rec", "_ord", "_prev")]
    return out.select(*keep, *[F.col("_prev")[c].alias(prefix + c) for c in carried])


def _carry_join(d: DataFrame, carry: DataFrame, key: str, b: str) -> DataFrame:
    """``d`` with the carried columns of its (key, bucket); NULL keys meet."""
    c = carry.withColumnsRenamed({key: "_ck", b: "_cb"})
    return d.join(c, d[key].eqNullSafe(c["_ck"]) & (d[b] == c["_cb"]), "left").drop("_ck", "_cb")


def prefix_sums(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    values: dict[str, Column],
    prefix: str = "prior_",
    bucket_s: int = DEFAULT_BUCKET_S,
) -> DataFrame:
    """Add ``prefix + name`` = sum of ``values[name]`` over all rows of the key
    that come strictly before this row in ``order`` (0 when none)."""
    b = bucket_col(bucket_s)
    d = with_bucket(df, order[0], bucket_s)
    keep = list(d.columns)
    for name, e in values.items():
        d = d.withColumn("_v_" + name, e)
    w_in = Window.partitionBy(key, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for name in values:
        d = d.withColumn("_in_" + name, F.sum("_v_" + name).over(w_in))
    tot = d.groupBy(key, b).agg(*[F.sum("_v_" + n).alias("_t_" + n) for n in values])
    w_c = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(key, b, *[F.sum("_t_" + n).over(w_c).alias("_c_" + n) for n in values])
    out = _carry_join(d, carry, key, b)
    sums = []
    for name in values:
        zero = F.lit(0).cast(out.schema["_v_" + name].dataType)
        sums.append(
            (F.coalesce(F.col("_c_" + name), zero) + F.coalesce(F.col("_in_" + name), zero)).alias(prefix + name)
        )
    return out.select(*keep, *sums)
