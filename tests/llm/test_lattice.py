import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import lattice as L

MODEL = P.path("piece_bpe_32k.model")
TEXTS = [None, "", "  \n", "The cat sat on the mat", "the the THE cat", "Übermut tut selten gut, das Füßchen", "日本 x",
         "a" * 300 + " b", "unseen words here zqxj", "the cat again", "mat mat mat", "one more text of the cat"]


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x20\x09-\x0D]+", low)


def brute_base(docs):
    train = [t for i, t in docs if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    c = Counter(w for t in train for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in docs:
        toks = [*words(t), None]
        out.append((i, len(toks), sum(c[w] > 0 for w in toks), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks)))
    return out


def brute_lattice(model, word):
    """Sum over every segmentation, one by one."""
    def total(i):
        if i == len(word):
            return 1.0
        s = 0.0
        if (b := model.byte_piece[word[i]]) >= 0:
            s += math.exp(model.logw[b]) * total(i + 1)
        for j in range(i + 1, len(word) + 1):
            if (p := model.by_text.get(word[i:j])) is not None:
                s += math.exp(model.logw[p]) * total(j)
        return s
    return total(0)


@pytest.fixture(scope="module")
def model():
    pieces, prior, byte_piece = L.vocabulary(MODEL)
    return L.Lattice(pieces, prior, byte_piece)


@pytest.mark.parametrize("w", [" the", " x", " token", " über", " 日", " zqx9"])
def test_forward_sums_all_segmentations(model, w):
    raw = w.encode()
    got = model.log_prob(np.frombuffer(raw, np.uint8)[None, :])[0]
    assert got == pytest.approx(math.log(brute_lattice(model, raw)))
    assert model.long_word(raw) == pytest.approx(got)


def test_expected_counts_cover_the_word(model):
    raw = np.frombuffer(b" tokens", np.uint8)[None, :]
    used = np.zeros(len(model.logw))
    model.expected(raw, np.array([3.0]), used)
    size = {i: len(p) for p, i in model.by_text.items()}
    assert sum(u * size.get(i, 1) for i, u in enumerate(used) if u) == pytest.approx(3 * 7)


@pytest.mark.parametrize("hot", [2, 1 << 18])
def test_base_scores(spark, docs_of, hot):
    docs = docs_of(*TEXTS, (None, "The null id", None, None, None), (5, "same id", "en", "s", 7)).repartition(3) \
        .withColumn("h", F.lit("clash")).withColumn("rest", F.lit(1))
    got = L.score(docs, MODEL, hot=hot).collect()
    want = brute_base([(r.doc_id, r.text) for r in docs.collect()])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    mine = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    for a, b in zip(mine, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-9)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_score_does_not_depend_on_hot_or_partitions(spark, docs_of):
    docs = docs_of(*TEXTS)
    a = {r.doc_id: r.score for r in L.score(docs.repartition(1), MODEL, hot=1).collect()}
    b = {r.doc_id: r.score for r in L.score(docs.repartition(4), MODEL).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-7) for k in a)


def test_empty_table(spark, docs_of):
    assert L.score(docs_of("x").filter("false"), MODEL).collect() == []


def test_query(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {x[0]: x[1:] for x in brute_base(docs)}
    got = E.queries()["op5_lattice_lm"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)


def test_learning_helps_held_out_texts(spark):
    from conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plain, learned = ({r.doc_id: r.score for r in L.score(docs, MODEL, rounds=n).filter("held_out").collect()} for n in (0, 1))
    assert plain and np.mean([learned[k] > plain[k] for k in plain]) > 0.9
