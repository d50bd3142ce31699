import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwatch.llm import byte_bpe, stages
from llm import test_decontaminate, test_linededup, test_setjoin
from llm.conftest import DOC_SCHEMA


def brute(docs, items):
    """The stages after language ID, one by one, on (id, text) rows."""
    dup = {(d, i) for d, _, i in test_linededup.brute([(d, t, 0) for d, t in docs])}
    cut = []
    for d, t in docs:
        if d is not None and t is not None and any((d, i) in dup for i in range(t.count("\n") + 1)):
            t = "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in dup)
            if not test_setjoin.words(t):
                continue
        cut.append((d, t))
    group = test_setjoin.brute(cut)
    one = [(d, t) for (d, t), (_, c) in zip(cut, group, strict=True) if d is None or d == c]
    hits = {d for d, _ in test_decontaminate.brute(one, items)}
    enc = byte_bpe.encoder(P.path(stages.RANKS), P.PATTERN)
    return [(d, t, np.asarray(enc.encode_ordinary(t or ""), "<u4").tobytes()) for d, t in one if d not in hits]


def corpus(seed):
    rng = random.Random(seed)
    docs, items = test_decontaminate.planted(seed)
    items = [x for x in items if x[0] not in (52, 54)]
    texts = [t for _, t in docs if t] + test_setjoin.families(rng, 6, 4, [f"v{i}" for i in range(90)])
    shared = "a line that many of the documents share"
    rows = []
    for i, t in enumerate(texts):
        w = t.split()
        lines = [" ".join(w[k:k + 13]) for k in range(0, len(w), 13)]
        if rng.random() < 0.3:
            lines.insert(rng.randint(0, len(lines)), shared + rng.choice(["", "", "!", "."]))
        rows.append((i, "\n".join(lines)))
    return rows, items


@pytest.mark.parametrize("seed", [1])
def test_pipeline_matches_brute_force(spark, tmp_path, seed):
    rows, items = corpus(seed)
    junk = [(1000, None), (1001, "12 34"), (1002, "")]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in [*rows, *junk]], DOC_SCHEMA)
    df = df.withColumn("cut", F.lit("clash")).withColumn("lang_pred", F.lit("clash")).repartition(3)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*df.columns, "ids", "n_tokens"]
    got = sorted((r.doc_id, r.text, bytes(r.ids)) for r in out.collect())
    assert got == sorted(brute(rows, items)) and got
    assert all(r.n_tokens * 4 == len(r.ids) and r.n_chars == len(r.text) for r in out.collect())


def test_stages_take_nulls_and_empty_tables(spark, tmp_path):
    odd = [(None, "some words without an id", None, None, None), (1, "equal rows of one document", "en", "s", 1),
           (1, "equal rows of one document", "en", "s", 1), (2, None, None, None, None)]
    df = spark.createDataFrame(odd, DOC_SCHEMA)
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.filter("false"), str(tmp_path)).collect() == []
        got = stage(spark, df, str(tmp_path))
        n = {"language_id": 3, "line_dedup": 4, "ngram_jaccard": 3, "decontamination": 4, "byte_bpe": 4}[name]
        assert len(got.collect()) == n, name
        if name != "byte_bpe":
            assert got.columns == df.columns


def test_near_copies_of_one_id_on_two_texts(spark, docs_of):
    """A text that no other row holds stays, whatever its id's other row is a copy of."""
    from cardwatch.llm import stages

    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = docs_of((1, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (9, b, "en", "s", 1), (9, b, "en", "s", 1), (None, a, "en", "s", 1))
    got = sorted(((r.doc_id, r.text) for r in stages.near_copy_stage(spark, docs, "").collect()), key=str)
    assert len(got) == 3 and {x for x in got if x[0]} in ({(1, a), (9, b)}, {(1, a), (5, b)}) and (None, a) in got
