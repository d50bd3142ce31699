"""Exact, mergeable moments of a money column.

Count, sum and sum of squares are decimals with 8 places (16 for squares), so any partitioning, order or merging of partial
results gives the same bits; amounts of 10 million or more are added as doubles beside them.  The least and greatest values make
the spread of equal values exactly 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.columns import col_, exact_money, rest_money

FIELDS = ("m_n", "m_sum", "m_sq", "m_big", "m_bigsq", "m_lo", "m_hi")


def partial(c: str | Column) -> list[Column]:
    """Aggregates of ``c``: the columns of ``FIELDS``."""
    x, big = exact_money(c), rest_money(c)
    how = (F.count(col_(c)), F.sum(x), F.sum(x * x), F.sum(big), F.sum(big * big), F.min(col_(c)), F.max(col_(c)))
    return [a.alias(f) for a, f in zip(how, FIELDS, strict=True)]


def merged() -> list[Column]:
    """Aggregates that merge rows of ``FIELDS``."""
    how = {"m_lo": F.min, "m_hi": F.max}
    kind = {"m_n": "long", "m_sum": "decimal(38,8)", "m_sq": "decimal(38,16)"}
    return [(how.get(f, F.sum)(f).cast(kind[f]) if f in kind else how.get(f, F.sum)(f)).alias(f) for f in FIELDS]


def mean() -> Column:
    whole = (F.col("m_sum").cast("double") + F.col("m_big")) / F.col("m_n")
    return F.when(F.col("m_lo") == F.col("m_hi"), F.col("m_lo")).when(F.col("m_n") > 0, whole)


def deviation() -> Column:
    """Sample standard deviation; null below two values."""
    s = F.col("m_sum").cast("double") + F.col("m_big")
    var = (F.col("m_sq").cast("double") + F.col("m_bigsq") - s * s / F.col("m_n")) / (F.col("m_n") - 1)
    return F.when(F.col("m_n") > 1, F.when(F.col("m_lo") == F.col("m_hi"), 0.0).otherwise(F.sqrt(F.greatest(var, F.lit(0.0)))))


def by_key(df: DataFrame, key: str, c: str) -> DataFrame:
    """(key, rows, moments of ``c``): rows counts those without a value too."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *partial(c))


def merge(parts: DataFrame, key: str) -> DataFrame:
    """One row a key from the partial rows of ``by_key``."""
    return parts.groupBy(key).agg(F.sum("rows").alias("rows"), *merged())
