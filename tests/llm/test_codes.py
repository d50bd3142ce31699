import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import codes as C


def brute(rows, rounds=6):
    """(vec_id, code, error, label_error) and the digest, every part compared with every entry in each round."""
    rows = [(i, lab, [int(np.floor(4096 * float(np.float32(x)))) for x in v]) for i, v, lab in rows]
    w = len(rows[0][2]) // 8
    ints = [[v[p * w:p * w + w] for p in range(8)] for _, _, v in rows]
    first = sorted(range(len(rows)), key=lambda k: rows[k][0])[:16]
    book = [[ints[k][p] for k in first] for p in range(8)]

    def near(x, p):
        d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        at = [[near(x[p], p)[0] for p in range(8)] for x in ints]
        for p in range(8):
            for k in range(len(book[p])):
                mine = [x[p] for x, a in zip(ints, at, strict=True) if a[p] == k]
                if mine:
                    book[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    end = [[near(x[p], p) for p in range(8)] for x in ints]
    error = [sum(d for _, d in e) for e in end]
    labels = defaultdict(int)
    for (_, lab, _), e in zip(rows, error, strict=True):
        labels[lab] += e
    digest = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for k, _ in e), x, labels[lab], digest)
            for (i, lab, _), e, x in zip(rows, end, error, strict=True)]


def some(seed, n, width=3, kinds=5, span=1.0):
    """Few distinct parts, so that distances tie and entries settle at different rounds."""
    rng = random.Random(seed)
    pool = [[[rng.uniform(-span, span) if rng.random() < 0.8 else 0.0 for _ in range(width)] for _ in range(kinds * 5)] for _ in range(8)]
    return [(i, [float(x) for p in range(8) for x in rng.choice(pool[p])], rng.choice([None, 0, 1, 1])) for i in rng.sample(range(10 * n), n)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("seed,n,width,span", [(1, 200, 3, 1.0), (2, 150, 8, 0.01), (3, 9, 2, 1.0), (4, 120, 2, 30_000.0)])
def test_codes_match_brute_force(spark, seed, n, width, span):
    rows = some(seed, n, width, span=span)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("Code", F.lit("clash")).withColumn("v", F.lit(1)).repartition(5)
    got = sorted(map(tuple, C.compress(df).collect()))
    assert got == sorted(brute(rows))


def test_active_rule_equals_a_full_scan():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x = rng.integers(-3, 4, (40, 2))
        old = rng.integers(-3, 4, (16, 2))
        new = np.where(rng.random(16)[:, None] < rng.random(), rng.integers(-3, 4, (16, 2)), old)
        at, dist = C.assign_all(x, old)
        got = C.assign_active(x, new, (new != old).any(1), at, dist)
        want = C.assign_all(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_distances_beyond_doubles():
    x = np.array([[C.bound(64), -C.bound(64)] * 4, [1] * 8])
    d = C.distances(x, -x)
    assert [[int(v) for v in r] for r in d] == [[sum((int(a) + int(b)) ** 2 for a, b in zip(p, q, strict=True)) for q in x] for p in x]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    one = [0.5] * 16
    rows = [(5, one, 1), (5, one, None), (None, one, None), (1, None, 1), (2, [], 1), (3, [nan, *one[1:]], 1),
            (4, [*one[1:], -inf], 1), (6, [None, *one[1:]], 1), (7, one[:8], 2), (8, one[:7], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = C.compress(df).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got if r.vec_id) == [(5, "00" * 8, 0, 0)] * 2
    assert len(got) == 3
    empty = C.compress(df.filter("vec_id = 1"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    huge = spark.createDataFrame([(i, [3e38 * (-1) ** (i + j) for j in range(64)], 0) for i in range(40)], SCHEMA)
    assert {r.error for r in C.compress(huge).collect()} == {0}


def test_decoded(spark):
    df = spark.createDataFrame(some(6, 60), SCHEMA)
    coded, book = C.encode(df)
    for r in C.decoded(coded, book).collect():
        want = [x / 4096 for p in range(8) for x in book[p, int(r.code[2 * p:2 * p + 2], 16)]]
        assert r.approximation == want
