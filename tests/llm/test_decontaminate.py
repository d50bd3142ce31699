import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import decontaminate as D
from llm.test_setjoin import words


def bag(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute(docs, items):
    """{(doc, item): best similarity} over every window of the item's size."""
    out = {}
    for d, t in docs:
        w = words(t)
        for i, text in items:
            v = words(text)
            if not v or not w or (len(v) < 5 and len(w) < len(v)):
                continue
            size, b = min(len(v), len(w)), bag(v)
            if len(v) >= 5 and size < 5:
                continue
            sims = [D.similarity(bag(w[p:p + size]), b) for p in range(len(w) - size + 1)]
            if max(sims) >= 0.75:
                out[d, i] = (max(sims), sims.index(max(sims)))
    return out


def planted(seed):
    rng = random.Random(seed)
    v = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(v) for _ in range(rng.choice([5, 8, 15, 30, 30, 50])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "two words"), (53, items[3][1]), (54, "solo")]
    docs = [(0, None), (1, ""), (2, "short"), (3, "x two WORDS y"), (4, " ".join(items[5][1].split()[:-1]))]
    for d in range(5, 60):
        w = [rng.choice(v) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.choice([0, 1, 2])):
            p = words(rng.choice(items[:12])[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = "zz"
            if rng.random() < 0.2:
                p.insert(len(p) // 2, "ins")
            at = rng.randint(0, len(w))
            w[at:at] = p
        docs.append((d, " ".join(w)))
    return docs, items


@pytest.mark.parametrize("seed,most", [(1, 1 << 21), (2, 40)])
def test_matches_brute_force(spark, seed, most):
    docs, items = planted(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in D.find_matches(df, b, most=most).collect()}
    want = brute(docs, items)
    assert {k: pytest.approx(v) for k, v in want.items() if v[0] >= 0.85} == {k: v for k, v in got.items() if v[0] >= 0.85}
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want)


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 30, 200)], np.uint64)
    windows = items[rng.integers(0, 50, 200)] ^ flips
    w, i = D.MultiIndex(items, 20).near(windows)
    want = {(a, b) for a in range(200) for b in range(50) if bin(int(windows[a] ^ items[b])).count("1") <= 20}
    assert set(zip(w.tolist(), i.tolist())) == want


def test_prints_slide():
    s = np.random.default_rng(1).integers(0, 1 << 63, 40, dtype=np.uint64)
    got = D.window_prints(s, 7)
    assert all(got[i] == D.pack(D.votes(s[i:i + 7]).sum(axis=0)[None, :])[0] for i in range(34))


def test_empty_tables_and_null_ids(spark):
    d = spark.createDataFrame([(None, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "b c d e f"), (7, "b c d e f")], "item_id long, text string")
    assert D.find_matches(d.filter("false"), b).collect() == [] and D.find_matches(d, b.filter("false")).collect() == []
    got = D.find_matches(d, b).collect()
    assert len(got) == 6 and {tuple(r)[2:] for r in got} == {(1.0, 1, 5)}


def test_query(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    sets = [(d, t, {x for x in bag(words(t))}) for d, t in docs]
    want = {}
    for i, t in items:  # only documents that share a shingle can match
        own = set(bag(words(t)))
        want |= brute([(d, x) for d, x, s in sets if s & own], [(i, t)])
    got = {(r.doc_id, r.item_id) for r in E.queries()["op3_decontamination"](spark, SF_SMALL).collect()}
    assert got == set(want) and got
