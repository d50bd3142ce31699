"""Segmented scans against plain windows, on generated rows of which one card holds a third."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.operators.segments import SEGMENTS_A_TASK, SegmentedScan

ORDER = ("event_time", "transaction_id")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    n = 6000
    cards = [None if x < 0.05 else "HOT" if x < 0.4 else f"c{int(x * 400)}" for x in rng.random(n)]
    secs = 1_704_067_200 + rng.integers(0, 20_000, n)
    secs[:200] = secs[0]  # many rows of one time
    data = [(f"t{i:05d}", cards[i], int(secs[i]), int(rng.integers(0, 900)), bool(rng.random() < 0.3)) for i in range(n)]
    df = spark.createDataFrame(data, "transaction_id string, card_id string, s long, v long, ok boolean")
    return df.withColumn("event_time", F.timestamp_seconds("s")).drop("s").repartition(4).cache()


@pytest.mark.parametrize("segment_rows,window_s", [(None, 600), (100, 30), (100, 5_000), (37, 100_000)])
def test_scans_match_plain_windows(rows, segment_rows, window_s):
    scan = SegmentedScan(rows, "card_id", ORDER, segment_rows)
    assert bool(scan.cuts) == (segment_rows is not None)
    got = scan.sums_before({"v": F.col("v"), "n": F.lit(1).cast("long")}).last_before(["v"], where=F.col("ok")) \
        .count_within(window_s, "near").rows()
    w = Window.partitionBy("card_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    near = Window.partitionBy("card_id").orderBy(F.unix_micros("event_time")).rangeBetween(-window_s * 1_000_000, 0)
    want = rows.withColumns({
        "prior_v": F.coalesce(F.sum("v").over(w), F.lit(0)), "prior_n": F.count("v").over(w),
        "prev_transaction_id": F.last(F.when(F.col("ok"), F.col("transaction_id")), ignorenulls=True).over(w),
        "prev_v": F.last(F.when(F.col("ok"), F.col("v")), ignorenulls=True).over(w),
        "near": F.count(F.lit(1)).over(near)})
    cols = ["transaction_id", "card_id", "prior_v", "prior_n", "prev_transaction_id", "prev_v", "near"]
    assert got.count() == rows.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_no_task_reads_much_more_than_the_others(rows):
    """With one card of a third of all rows, tasks read at most twice the median."""
    scan = SegmentedScan(rows.filter("transaction_id >= 't00200'"), "card_id", ORDER, 6000 // (SEGMENTS_A_TASK * 8))
    placed = [d.withColumn("_part", F.lit(-1)) if "_part" not in d.columns else d for d in scan.parts]
    tasks = placed[0].select("card_id", F.expr("pmod(hash(card_id), 8)").alias("t")).unionByName(
        placed[1].select("card_id", F.expr("pmod(hash(card_id, _part), 8)").alias("t")))
    n = sorted(r["count"] for r in tasks.groupBy("t").count().collect())
    assert len(n) == 8 and n[-1] <= 2 * n[4], n
    one = placed[1].groupBy("card_id", "_part").count().agg(F.max("count")).first()[0]
    assert one <= 1.5 * 6000 // (SEGMENTS_A_TASK * 8)


def test_empty(rows):
    scan = SegmentedScan(rows.filter("false"), "card_id", ORDER, 5).sums_before({"v": F.col("v")}).count_within(60, "n")
    assert scan.rows().collect() == []
