"""Join helpers that stay safe when one key holds a large share of the rows.

* Dimensions are joined as they are: AQE broadcasts a side whose measured size
  is small, and splits skewed partitions.
* ``salted_enrich`` joins a fact table to a one-row-per-key table whose
  hottest keys are spread over ``fan_out`` tasks: the fact rows of a hot key
  get a deterministic salt from their own columns (so a re-run after a lost
  executor gives the same rows), the dimension row of a hot key is repeated
  once per salt.  Only the top ``max_hot_keys`` keys are salted, so the hot
  key list that enters the plan as a literal set has a proven size bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = None
DEFAULT_HOT_KEYS = 256
DEFAULT_FAN_OUT = 64


def hot_keys(
    dim: DataFrame,
    key: str,
    weight: str,
    min_rows: int,
    max_keys: int = DEFAULT_HOT_KEYS,
) -> DataFrame:
    """At most ``max_keys`` keys whose ``weight`` (row count) is >= ``min_rows``."""
    return (
        dim.filter(F.col(weight) >= min_rows)
        .orderBy(F.col(weight).desc(), F.col(key))
        .limit(max_keys)
        .select(key)
    )


def salted_enrich(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    weight: str,
    salt_cols: Sequence[str],
    how: str = "left",
    min_hot_rows: int | None = DEFAULT_HOT_ROWS,
    max_hot_keys: int = DEFAULT_HOT_KEYS,
    fan_out: int = DEFAULT_FAN_OUT,
    hot: Sequence | None = None,
) -> DataFrame:
    """``fact.join(dim, key, how)`` with hot keys split over ``fan_out`` tasks.

    ``dim`` must have one row per ``key`` and a ``weight`` column that counts
    the key's fact rows.  By default AQE's skew join splits large partitions at
    run time, and no job runs while the plan is made.  Keys given as ``hot``, or
    found by a top-k job where ``min_hot_rows`` is given (at most
    ``max_hot_keys``), are salted: they enter the plan as a literal set.  The result has ``key`` first, then the fact columns, then the
    dimension columns (the shape of a USING join).
    """
    if hot is None and min_hot_rows is None:
        hot = []
    elif hot is None:
        hot = [r[0] for r in hot_keys(dim, key, weight, min_hot_rows, max_hot_keys).collect()]
    fact_cols = [c for c in fact.columns if c != key]
    dim_cols = [c for c in dim.columns if c != key]
    if not hot:
        return fact.join(dim, key, how).select(key, *fact_cols, *dim_cols)
    is_hot = F.col(key).isin(list(hot))
    f = fact.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*salt_cols), F.lit(fan_out))).otherwise(F.lit(0)).cast("int")
    )
    d = dim.withColumn(
        "_salt",
        F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(fan_out - 1))).otherwise(F.array(F.lit(0)))),
    )
    return f.join(d, [key, "_salt"], how).select(key, *fact_cols, *dim_cols)
