import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import sharding as S


def brute(docs, shards=8):
    """{text: shard}: each group, from the heaviest, to the least-loaded shard."""
    groups = {}
    for d, t in docs:
        t = t or ""
        w, first = groups.get(t, (0, None))
        groups[t] = (w + len(t.encode()) + 1, d if first is None or d is None else min(first, d))
    heap = [(0, i) for i in range(shards)]
    out = {}
    for t in sorted(groups, key=lambda t: (-groups[t][0], groups[t][1])):
        load, i = heapq.heappop(heap)
        out[t] = i
        heapq.heappush(heap, (load + groups[t][0], i))
    return out


@pytest.mark.parametrize("seed", range(5))
def test_runs_equal_the_heap(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n = rng.randint(1, 9)
        loads = [rng.randint(0, rng.choice([5, 60])) for _ in range(n)]
        weight, count = rng.randint(1, 9), rng.randint(1, 40)
        heap = [(x, i) for i, x in enumerate(loads)]
        heapq.heapify(heap)
        want = []
        for _ in range(count):
            x, i = heapq.heappop(heap)
            want.append(i)
            heapq.heappush(heap, (x + weight, i))
        stretches = S.schedule_run(loads, weight, count)
        got = []
        for r in range(count):
            start, cycle = [x for x in stretches if x[0] <= r][-1]
            got.append(cycle[(r - start) % len(cycle)])
        assert got == want and [x for x, _ in sorted(heap, key=lambda x: x[1])] == loads
        assert len(stretches) <= n


@pytest.mark.parametrize("limit", [None, 0])
def test_shards_match_brute_force(spark, monkeypatch, limit):
    from cardwatch.llm import common

    if limit is not None:
        monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    rng = random.Random(3)
    base = ["", "é" * 9, "a hot text " * 4] + ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 30))) for _ in range(120)]
    docs = [(i, rng.choice(base) if i % 3 else base[2]) for i in range(400)] + [(401, None), (402, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "H1": F.lit(0)}).repartition(5)
    got = S.shard(df).collect()
    want = brute(docs)
    assert sorted((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == [
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes", want[t or ""], None) for d, t in docs]
    for s in range(8):
        own = sorted((r.slot, r.doc_id) for r in got if r.shard == s)
        assert [x[0] for x in own] == list(range(len(own))) and [x[1] for x in own] == sorted(x[1] for x in own)


def test_edges(spark, docs_of):
    assert S.shard(docs_of("x").filter("false")).collect() == []
    got = S.shard(docs_of((None, None, "en", "s", 0), (None, "", "en", "s", 0), (1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "x" * 300_000, "en", "s", 1))).collect()
    assert sorted((r["size"], r.shard, r.slot) for r in got) == [(1, 2, 0), (1, 2, 1), (2, 1, 0), (2, 1, 1), (300_001, 0, 0)]


def test_written_shards(spark, docs_of, tmp_path):
    docs = docs_of(*(f"text {i % 7} " * (i % 5) for i in range(60)), None).withColumn("Shard", F.lit("own"))
    S.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 61 and back.columns == [*docs.columns, "shard_"]
    want = {r.doc_id: r.shard for r in S.shard(docs).collect()}
    assert {r.doc_id: r.shard_ for r in back.collect()} == want
