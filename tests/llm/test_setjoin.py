import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import setjoin as S
from cardwatch.llm.components import components


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x20\x09-\x0D]+", low)


def shingle_set(t):
    w = words(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(docs):
    """{row: (n_shingles, component)} by comparing every two texts."""
    sets = [shingle_set(t) for _, t in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(len(sets[i]), least.get(find(i))) for i in range(len(docs))]


def families(rng, n, size, vocabulary):
    """Texts and copies of them with some words changed, around the threshold; a passage that many share."""
    out, passage = [], " ".join(rng.choice(vocabulary) for _ in range(9))
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w = w[rng.randint(0, 2):]
            if rng.random() < 0.3:
                w += passage.split()
            out.append(" ".join(w).upper() if rng.random() < 0.1 else "\n".join(w))
    return out


@pytest.mark.parametrize("seed,sizes", [
    (1, {}), (2, {"long_list": 3, "hot_sets": 4, "block_shingles": 200}), (3, {"long_list": 2, "hot_sets": 1 << 30, "block_shingles": 60}),
    (4, {"long_list": 1 << 30, "hot_sets": 2})])
def test_components_match_brute_force(spark, docs_of, seed, sizes):
    rng = random.Random(seed)
    texts = [None, "", " \t", "one", "ONE", "one two three four", "one two three four five", "é ü ñ", *families(
        rng, 25, 8, [f"w{i}" for i in range(400)])]
    docs = [*enumerate(texts), (None, texts[-1]), (3, "one"), (None, "alone in the world now")]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("id", F.lit("clash"))
    got = S.join_components(df, **sizes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    want = sorted([(d, *x) for (d, _), x in zip(docs, brute(docs), strict=True)], key=key)
    assert sorted([tuple(r)[:3] for r in got], key=key) == want


def test_one_large_group_of_near_copies(spark):
    """Hundreds of copies that share most shingles go the way of long lists and stay one component, row for row."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    docs = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2])):
            w[rng.randrange(80)] = f"x{rng.randrange(10 ** 6)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in S.join_components(df, hot_sets=20, long_list=16, block_shingles=3000).collect()}
    assert got == {d: x for (d, _), x in zip(docs, brute(docs), strict=True)}


def test_empty_table(spark, docs_of):
    assert S.join_components(docs_of("x").filter("false")).collect() == []


def test_sets_are_whole(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    got = list(S.sets(pa.array([text, None, "a b", text])))
    assert [len(s) for s in got] == [299_996, 0, 1, 299_996] and (got[0] == got[3]).all()


def test_spanning_links_skip_but_keep_components():
    rng = np.random.default_rng(0)
    base = np.sort(rng.integers(0, 1 << 60, 60, dtype=np.uint64))
    members = [np.unique(np.concatenate([rng.choice(base, 54, replace=False), rng.integers(0, 1 << 60, 4, dtype=np.uint64)]))
               for _ in range(40)]
    ids = np.arange(40)
    all_ = np.ones(40, bool)
    got = S.spanning_links(ids, members, all_, all_)
    links = {(i, j) for i in range(40) for j in range(i)
             if S.linked(len(np.intersect1d(members[i], members[j])), len(members[i]), len(members[j]))}

    def closed(edges):
        g = list(range(40))
        for a, b in edges:
            g = [g[a] if x == g[b] else x for x in g]
        return [g.index(x) for x in g]
    assert closed(got) == closed(links) and len(got) < 40
    assert all((max(a, b), min(a, b)) in links for a, b in got)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}}


def test_query(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {d: x for (d, _), x in zip(docs, brute(docs), strict=True)}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in E.queries()["op2_ngram_jaccard"](spark, SF_SMALL).collect()}
    assert got == want
