import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import oracle
from cardwatch.llm import quality as Q

W20 = " ".join(f"w{i}" for i in range(25))
TEXTS = [None, "", " \n\t ", "one", W20, W20 + "\n" + W20, "a b c d e f g h " * 40, "# | < $ word\n# | < $ word\n\n \n# | < $ word",
         "\x0b x\x0cy\x1cz \r\n é ü 日本", W20 + " " + "| " * 30, "\n".join(["same line here"] * 20 + [W20]), "long " + "x" * 50000,
         " ".join(str(i % 11) for i in range(4000))]


def brute(t):
    t = t or ""
    words = re.findall("[^\x20\x09-\x0D]+", t)
    win = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    c = Counter(win)
    rep = {k for i, g in enumerate(win) if c[g] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
            len(words) < 20 or 100 * len(rep) > 30 * len(words))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_match_brute_force(spark, docs_of):
    docs = docs_of(*TEXTS, (None, W20, None, None, None), (4, W20, "en", None, 1)).withColumn("words", F.lit("clash"))
    got = Q.judge(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        if r.doc_id is not None:
            assert tuple(r[n] for n in NAMES) == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        assert not (r.kept and r.base_failed)


def test_empty(spark, docs_of):
    assert Q.judge(docs_of("x").filter("false")).collect() == []


def test_outliers_go_ordinary_texts_stay(spark, docs_of):
    base = [(i, " ".join(f"word{(i * 7 + k) % 97}" for k in range(60)), "en", f"s{i % 2}", 1) for i in range(300)]
    odd = (1000, W20 + " " + "| " * 40 + " end of it", "en", "s0", 1)
    got = {r.doc_id: r.kept for r in Q.judge(docs_of(*base, odd)).collect()}
    assert not got.pop(1000) and all(got.values())


def test_sketch_quantiles_within_growth(spark):
    xs = [((i * 7919) % 5003) for i in range(4000)]
    df = spark.createDataFrame([("en", "s", "f", x) for x in xs], "lang string, source string, feature string, x long")
    sk = df.groupBy("lang", "source", "feature", Q.bucket(F.col("x")).alias("i")).agg(F.count("*").alias("n"))
    r = Q.quantiles(sk, ("lang",)).first()
    for q, got in ((50, r.q50), (90, r.q90)):
        exact = sorted(xs)[-(-len(xs) * q // 100) - 1]
        assert exact <= got + 1e-6 and got + 1 <= (exact + 1) * Q.GROWTH + 1e-6


@pytest.mark.parametrize("with_odd_rows", [False, True])
def test_query_equals_sql(spark, docs_of, with_odd_rows):
    from conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    if with_odd_rows:
        docs = docs.union(docs_of(*[(5000 + i, t, None, None, 1) for i, t in enumerate(TEXTS)]))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = sorted(con.execute(oracle.QUALITY).fetchall(), key=str)
    assert sorted(map(tuple, Q.judge(docs).collect()), key=str) == want
