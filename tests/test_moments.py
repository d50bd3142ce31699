"""Exact moments: equal bits under any order, partitioning and merging."""

import numpy as np
from pyspark.sql import functions as F

from cardwatch.functions import moments
from cardwatch.operators import score


def test_equal_bits_in_any_order(spark):
    rng = np.random.default_rng(3)
    data = [(f"c{int(k)}", float(a)) for k, a in zip(rng.integers(0, 4, 4000), np.round(rng.gamma(0.3, 900.0, 4000), 2), strict=True)]
    data += [("big", 2.5e9), ("big", 1e7), ("big", None), ("one", 0.1), ("same", 0.1), ("same", 0.1), ("same", 0.1), ("none", None)]
    df = spark.createDataFrame(data, "card_id string, amount double")
    want = sorted(map(tuple, score.card_stats(df.coalesce(1)).collect()))
    for n in (2, 7):
        assert sorted(map(tuple, score.card_stats(df.orderBy(F.rand(n)).repartition(n)).collect())) == want
    parts = [moments.by_key(df.filter(F.pmod(F.hash("amount"), F.lit(3)) == i), "card_id", "amount") for i in range(3)]
    merged = moments.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), "card_id")
    assert sorted(map(tuple, score.stats_of(merged).collect())) == want
    got = {r[0]: r[1:] for r in want}
    assert got["same"] == (3, 0.1, 0.0) and got["one"] == (1, 0.1, None) and got["none"] == (1, None, None)
    plain = {r.card_id: r for r in df.groupBy("card_id").agg(F.avg("amount").alias("m"), F.stddev_samp("amount").alias("s")).collect()}
    for c in ("c0", "c1", "c2", "c3"):
        assert abs(got[c][1] - plain[c].m) < 1e-9 and abs(got[c][2] - plain[c].s) < 1e-6
