import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    members, whole = defaultdict(set), {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].add(c)
    children = defaultdict(set)
    for seq in members:
        if seq:
            children[seq[:-1]].add(seq)
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq, m in members.items():
        value = (len(m) - 1) * len(re.findall("[^\x20\x09-\x0D]+", seq[-1][1])) if seq else 0
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += seq not in children
            saved[seq[:d]] += value
    out = []
    for seq, m in members.items():
        ended = ",".join(str(c) for c in sorted(m) if whole[c] == seq)
        out.append((min(m), len(seq), min(members[seq[:-1]]) if seq else None, len(m), len(children[seq]), leaves[seq],
                    saved[seq], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def some(seed, n=150, longest=6, texts=3):
    rng = random.Random(seed)
    said = [" ".join(rng.choice(["a", "bé", "c c", "\td"]) for _ in range(rng.randint(0, 5))) for _ in range(texts)] + [None, ""]
    rows = []
    for c in rng.sample(range(-60, 500), n):
        numbers = [None, *range(longest)] if rng.random() < 0.2 else range(rng.randint(1, longest))
        for t in numbers:
            rows.append((c, t, rng.choice(["user", "user", None]), rng.choice(said)))
            if rng.random() < 0.1:
                rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(said)))
    return rows + [(None, 0, "user", "nobody's")]


def found(df):
    out = T.prefix_nodes(df)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("seed,stretch,rows", [(1, 64, 4096), (2, 2, 7), (3, 3, 4096)])
def test_nodes_match_brute_force(spark, monkeypatch, seed, stretch, rows):
    monkeypatch.setattr(T, "STRETCH", stretch)
    data = some(seed)
    df = spark.createDataFrame(data, SCHEMA).withColumns({"depth": F.lit("clash"), "N": F.lit(1)}).repartition(5)
    monkeypatch.setattr(T, "SHARD_ROWS", rows)
    assert found(df) == brute(data)


def test_common_conversation_and_turn(spark):
    """Copies of one conversation, one first turn of all, and a conversation of many turns."""
    data = [(c, t, "user", f"w{t} same") for c in range(0, 3000, 20) for t in range(3)]
    data += [(c, t, "user", "hello there" if not t else f"own {c * t % 40}") for c in range(7, 600, 20) for t in range(5)]
    data += [(60_000 + 20 * k, t, "user", "over and over" if t < 190 else f"end {k}") for k in range(3) for t in range(200)]
    assert found(spark.createDataFrame(data, SCHEMA)) == brute(data)


def test_edges(spark):
    df = spark.createDataFrame(some(9, 5), SCHEMA)
    assert found(df.filter("false")) == []
    assert found(df.filter("conv_id is null")) == []
    turnless = next(c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4 == 3)
    data = [(turnless, 0, "user", "never seen")]
    assert found(spark.createDataFrame(data, SCHEMA)) == brute(data)
    data = [(20, 0, "user", "x " * 200_000), (20, 0, "user", "x " * 200_000), (40, 0, None, None)]
    assert found(spark.createDataFrame(data, SCHEMA)) == brute(data)


def test_double_array():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, places = int(rng.integers(1, 60)), int(rng.integers(1, 7))
        symbols = rng.integers(0, rng.integers(1, 30), (n, places))
        length = rng.integers(0, places + 1, n)
        array = T.DoubleArray(symbols, length)
        slots = {}
        for row, size in zip(symbols, length, strict=True):
            at = np.zeros(1, np.int64)
            for d in range(size):
                at = array.child(at, row[d:d + 1])
                assert at[0] > 0 and slots.setdefault(int(at[0]), tuple(row[:d + 1])) == tuple(row[:d + 1])
        assert len(slots) == len({tuple(r[:d + 1]) for r, k in zip(symbols, length, strict=True) for d in range(k)})
        unseen = array.child(np.zeros(1, np.int64), np.array([999]))
        assert unseen[0] == -1
