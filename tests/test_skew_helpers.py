"""Bucketed / salted helpers against brute force on small generated rows
(including one card that holds most of the rows)."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.operators.joins import salted_enrich
from cardwatch.operators.sequence import bucket_col, previous_row, prefix_sums, rolling_count


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    n = 3000
    cards = np.where(rng.random(n) < 0.4, "HOT", np.char.add("c", rng.integers(0, 30, n).astype(str)))
    t0 = 1_704_067_200
    secs = t0 + rng.integers(0, 6 * 3600, n)
    secs[:50] = secs[50]  # equal timestamps
    amounts = np.round(rng.gamma(2.0, 30.0, n), 2)
    data = [(f"t{i:05d}", str(cards[i]), int(secs[i]), float(amounts[i]), float(rng.random() > 0.3))
            for i in range(n)]
    df = spark.createDataFrame(data, "transaction_id string, card_id string, s long, amount double, loc double")
    return df.withColumn("event_time", F.timestamp_seconds("s")).drop("s")


def test_rolling_count_matches_range_window(rows):
    got = rolling_count(rows, "card_id", "event_time", 600, "n", bucket_s=900).drop(bucket_col(900))
    w = Window.partitionBy("card_id").orderBy(F.unix_micros("event_time")).rangeBetween(-600_000_000, 0)
    exp = rows.withColumn("n", F.count(F.lit(1)).over(w))
    assert got.select("transaction_id", "n").exceptAll(exp.select("transaction_id", "n")).count() == 0
    assert got.count() == rows.count()


def test_previous_row_matches_lag(rows):
    order = ("event_time", "transaction_id")
    got = previous_row(rows, "card_id", order, ["amount"], bucket_s=600).drop(bucket_col(600))
    w = Window.partitionBy("card_id").orderBy(*order)
    exp = rows.withColumn("prev_transaction_id", F.lag("transaction_id").over(w)) \
              .withColumn("prev_amount", F.lag("amount").over(w))
    cols = ["transaction_id", "prev_transaction_id", "prev_amount"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0


def test_previous_row_with_condition(rows):
    order = ("event_time", "transaction_id")
    got = previous_row(rows, "card_id", order, [], bucket_s=600, where=F.col("loc") > 0).drop(bucket_col(600))
    w = Window.partitionBy("card_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    exp = rows.withColumn(
        "prev_transaction_id",
        F.last(F.when(F.col("loc") > 0, F.col("transaction_id")), ignorenulls=True).over(w),
    )
    cols = ["transaction_id", "prev_transaction_id"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0


def test_prefix_sums_match_window(rows):
    order = ("event_time", "transaction_id")
    amt = F.col("amount").cast("decimal(18,2)")
    got = prefix_sums(rows, "card_id", order, {"n": F.lit(1).cast("long"), "s": amt}, bucket_s=600).drop(bucket_col(600))
    w = Window.partitionBy("card_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    exp = rows.withColumn("prior_n", F.coalesce(F.count(F.lit(1)).over(w), F.lit(0))) \
              .withColumn("prior_s", F.coalesce(F.sum(amt).over(w), F.lit(0)))
    cols = ["transaction_id", "prior_n", "prior_s"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0


def test_salted_enrich_equals_join(rows):
    stats = rows.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"), F.avg("amount").alias("m"))
    got = salted_enrich(rows, stats, "card_id", "n", ["transaction_id"], min_hot_rows=100, max_hot_keys=2, fan_out=8)
    exp = rows.join(stats, "card_id", "left")
    assert got.columns == exp.columns
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_salted_plan_splits_hot_key(rows):
    stats = rows.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"))
    got = salted_enrich(rows, stats, "card_id", "n", ["transaction_id"], min_hot_rows=100, max_hot_keys=2, fan_out=8)
    per_salt = got.join(
        rows.select("transaction_id", F.pmod(F.xxhash64("transaction_id"), F.lit(8)).alias("salt")), "transaction_id"
    ).filter("card_id = 'HOT'").groupBy("salt").count()
    assert per_salt.count() == 8


def test_bucketed_sessions_match_session_window(rows):
    from cardwatch.operators.detect import burst_sessions

    got = burst_sessions(rows, gap_s=120, min_count=1, bucket_s=600)
    sw = F.session_window("event_time", "120 seconds")
    exp = rows.groupBy("card_id", sw).agg(
        F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"),
        F.count(F.lit(1)).alias("n_txn"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amount"),
    ).drop("session_window")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.select(got.columns).collect()))
