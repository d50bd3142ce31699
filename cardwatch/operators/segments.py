"""Ordered scans per key in segments of about equal numbers of rows.

A window over a key puts all its rows into one task, and a time bucket still all of one busy hour.  Here a key with more
than ``segment_rows`` rows is cut at quantiles of its times, so that its rows are sorted over many tasks; what a segment
needs from the earlier ones is one carry row per segment:

* ``sums_before`` / ``last_before``: sums over, or the last of, all earlier rows of the key.  Inside a segment a running
  window, plus the carry of the segments before.
* ``count_within``: rows of the trailing window.  A window that begins inside the row's own segment is a plain range
  count.  One that begins in an earlier segment asks that segment how many of its rows lie before the window (a mark
  among its rows, sorted with them), and the counts of whole segments fill the rest, so that no row is copied into other
  segments however many the window covers.

The cuts are literals of the plan: keys over the limit are counted (one map-side combined aggregation) and only for these
are quantile sketches made.  There are at most rows / segment_rows such keys and twice as many segments.  Rows with equal times
stay in one segment.  Without such a key nothing is cut or joined, and all scans share one shuffle and sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a segment has at least when no number is asked for.
LEAST_SEGMENT_ROWS = 50_000
#: Segments for each shuffle partition, if one key held all rows.  Segments are dealt by hash: with so many, a partition that gets
#: twice as many as others is rare.
SEGMENTS_A_TASK = 16
_PART, _US, _HOT, _TIE = "_part", "_us", "_hot", "_tie"


def cuts(df: DataFrame, key: str, ts: str, segment_rows: int | None = None) -> list[tuple]:
    """[(key, sorted times in microseconds)] at which the keys with many rows are cut."""
    spark = df.sparkSession
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if segment_rows is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        top = counts.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
        segment_rows = max(LEAST_SEGMENT_ROWS, (top["all"] or 0) // (SEGMENTS_A_TASK * tasks))
        if (top["most"] or 0) <= segment_rows:
            return []
    hot = counts.filter(F.col("n") > segment_rows).collect()
    if not hot:
        return []
    pieces = max(-(-r["n"] // segment_rows) for r in hot)
    keys = spark.createDataFrame([(r[key],) for r in hot], f"_k {df.schema[key].dataType.simpleString()}")
    us = F.unix_micros(F.col(ts))
    probs = [i / pieces for i in range(1, pieces)]
    found = df.join(F.broadcast(keys), df[key].eqNullSafe(keys["_k"]), "left_semi").groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(us, probs, 100 * pieces).alias("q")).collect()
    out = []
    for r in found:  # a smaller key takes every so many-th of the quantiles
        step = max(1, pieces // -(-r["n"] // segment_rows))
        out.append((r[key], sorted(set((r["q"] or [])[step - 1::step]))))
    return out


class SegmentedScan:
    """Scans over the rows of each key in time order; see the module's text.  ``rows()`` has the input's columns and those added."""

    def __init__(self, df: DataFrame, key: str, order: Sequence[str], segment_rows: int | None = None):
        self.key, self.order, self.columns = key, tuple(order), list(df.columns)
        self.cuts = cuts(df, key, order[0], segment_rows)
        d = df.withColumn(_US, F.unix_micros(F.col(order[0])))
        self.parts: list[DataFrame] = [d]
        if self.cuts:
            d = self._placed(d)
            cold = d.filter(F.col(_PART).isNull()).withColumn(_PART, F.lit(-1))
            self.parts = [cold.drop(_PART), d.filter(F.col(_PART).isNotNull())]

    # placing ------------------------------------------------------------------------------------------------------------

    def _placed(self, d: DataFrame, at: str = _US) -> DataFrame:
        """With the number of the segment that the time falls into; null for keys that are not cut.  Two steps of about the root of
        the number of cuts find it."""
        step = max(1, int(max(len(c) for _, c in self.cuts) ** 0.5))
        spark = d.sparkSession
        kind = d.schema[self.key].dataType.simpleString()
        table = spark.createDataFrame([(k, c, c[::step]) for k, c in self.cuts], f"_ck {kind}, _cuts array<long>, _coarse array<long>")
        both = d.join(F.broadcast(table), d[self.key].eqNullSafe(table["_ck"]), "left")
        group = F.size(F.filter("_coarse", lambda x: x <= F.col(at))) - 1
        inside = F.size(F.filter(F.slice("_cuts", F.greatest(group, F.lit(0)) * step + 1, F.lit(step)), lambda x: x <= F.col(at)))
        part = F.when(F.col("_cuts").isNotNull(), F.when(group < 0, 0).otherwise(group * step + inside))
        return both.withColumn(_PART, part).drop("_ck", "_cuts", "_coarse")

    def _window(self, hot: bool, *order: str):
        return Window.partitionBy(self.key, _PART).orderBy(*order) if hot else Window.partitionBy(self.key).orderBy(*order)

    def _each(self, fn) -> SegmentedScan:
        self.parts = [fn(d, bool(self.cuts) and i == 1) for i, d in enumerate(self.parts)]
        return self

    def _carried(self, d: DataFrame, carry: DataFrame) -> DataFrame:
        """``d`` with the carry of its segment: at most a row per segment, whose number the cuts bound."""
        c = carry.withColumnsRenamed({self.key: "_ck", _PART: "_cp"})
        return d.join(F.broadcast(c), d[self.key].eqNullSafe(c["_ck"]) & (d[_PART] == c["_cp"]), "left").drop("_ck", "_cp")

    @property
    def _before(self):
        return Window.partitionBy(self.key).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)

    # scans --------------------------------------------------------------------------------------------------------------

    def sums_before(self, values: dict[str, Column], prefix: str = "prior_") -> SegmentedScan:
        """Add ``prefix + name``: the sum of the value over all earlier rows of the key, 0 if none."""
        names = list(values)

        def one(d: DataFrame, hot: bool) -> DataFrame:
            d = d.withColumns({f"_v_{n}": e for n, e in values.items()})
            w = self._window(hot, _US, *self.order[1:]).rowsBetween(Window.unboundedPreceding, -1)
            out = d.withColumns({f"_in_{n}": F.sum(f"_v_{n}").over(w) for n in names})
            zero = {n: F.lit(0).cast(out.schema[f"_v_{n}"].dataType) for n in names}
            if hot:
                total = d.groupBy(self.key, _PART).agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names))
                out = self._carried(out, total.select(self.key, _PART, *(F.sum(f"_t_{n}").over(self._before).alias(f"_c_{n}") for n in names)))
            sums = {n: F.coalesce(F.col(f"_in_{n}"), zero[n]) for n in names}
            if hot:
                sums = {n: (v + F.coalesce(F.col(f"_c_{n}"), zero[n])).cast(out.schema[f"_in_{n}"].dataType) for n, v in sums.items()}
            return out.withColumns({prefix + n: v for n, v in sums.items()}).drop(
                *(p + n for n in names for p in ("_v_", "_in_", "_c_")))

        self.columns += [prefix + n for n in names]
        return self._each(one)

    def last_before(self, cols: Sequence[str], prefix: str = "prev_", where: Column | None = None) -> SegmentedScan:
        """Add ``prefix + c`` for the order columns and ``cols`` of the key's previous row (among those ``where`` holds)."""
        carried = list(dict.fromkeys([*self.order, *cols]))

        def one(d: DataFrame, hot: bool) -> DataFrame:
            rec, at = F.struct(*(F.col(c).alias(c) for c in carried)), F.struct(_US, *self.order[1:])
            if where is not None:
                rec, at = F.when(where, rec), F.when(where, at)
            d = d.withColumn("_rec", rec)
            w = self._window(hot, _US, *self.order[1:]).rowsBetween(Window.unboundedPreceding, -1)
            out = d.withColumn("_prev", F.last("_rec", ignorenulls=True).over(w))
            if hot:
                last = d.groupBy(self.key, _PART).agg(F.max_by("_rec", at).alias("_last"))
                carry = last.select(self.key, _PART, F.last("_last", ignorenulls=True).over(self._before).alias("_carry"))
                out = self._carried(out, carry).withColumn("_prev", F.coalesce("_prev", "_carry")).drop("_carry")
            return out.withColumns({prefix + c: F.col("_prev")[c] for c in carried}).drop("_rec", "_prev")

        self.columns += [prefix + c for c in carried]
        return self._each(one)

    def count_within(self, window_s: int, out: str) -> SegmentedScan:
        """Add ``out``: the key's rows with a time in [t - window_s, t], rows of equal time included."""
        back = window_s * 1_000_000

        def one(d: DataFrame, hot: bool) -> DataFrame:
            own = d.withColumn(out, F.count(F.lit(1)).over(self._window(hot, _US).rangeBetween(-back, 0)))
            if not hot:
                return own
            sizes = d.groupBy(self.key, _PART).agg(F.count(F.lit(1)).alias("_n"), F.min(_US).alias("_start"))
            sizes = sizes.select(self.key, _PART, "_start", F.coalesce(F.sum("_n").over(self._before), F.lit(0)).alias("_earlier"))
            own = self._carried(own, sizes)
            # where a row's window begins before its segment, the segment that holds the beginning is asked
            asks = own.filter(F.col(_US) - back < F.col("_start")).select(
                self.key, F.col(_US).alias("_of"), (F.col(_US) - back).alias("_at")).distinct()
            asks = self._placed(asks, "_at").select(self.key, _PART, "_at", "_of", F.lit(0).alias("_row"))
            marks = asks.unionByName(d.select(self.key, _PART, F.col(_US).alias("_at"), F.lit(None).cast("long").alias("_of"), F.lit(1).alias("_row")))
            w = Window.partitionBy(self.key, _PART).orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
            told = self._carried(marks.withColumn("_less", F.sum("_row").over(w)).filter("_row = 0"), sizes.drop("_start"))
            told = told.select(F.col(self.key).alias("_ak"), F.col("_of").alias("_au"), (F.col("_less") + F.coalesce("_earlier", F.lit(0))).alias("_less"))
            both = own.join(told, own[self.key].eqNullSafe(told["_ak"]) & (own[_US] == told["_au"]), "left")
            return both.withColumn(out, F.col(out) + F.coalesce(F.col("_earlier") - F.col("_less"), F.lit(0))).drop(
                "_ak", "_au", "_less", "_earlier", "_start")

        self.columns.append(out)
        return self._each(one)

    def rows(self) -> DataFrame:
        out = [d.select(*self.columns) for d in self.parts]
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])
