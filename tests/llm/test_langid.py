import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import langid as L

EN = "the quick brown fox jumps over the lazy dog and then they went with the others to that house"
DE = "der schnelle braune Fuchs springt über den faulen Hund und dann gehen sie zusammen nach Hause"
ES = "el rápido zorro marrón salta sobre el perro perezoso y después van juntos hacia aquella casa"


def brute_grams(raw: bytes):
    low = bytes(b + 32 if 65 <= b <= 90 else 32 if b in (9, 10, 11, 12, 13) else b for b in raw)
    return {low[i:i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}


def decoded(codes):
    out = set()
    for c in map(int, codes):
        if c >= L._THREE:
            out.add((c - L._THREE).to_bytes(3, "big"))
        elif c >= L._TWO:
            out.add((c - L._TWO).to_bytes(2, "big"))
        else:
            out.add(bytes([c]))
    return out


@pytest.mark.parametrize("t", ["", "a", "ab", "Ab\tc abc", "ñandú über", "aaaa", EN * 3])
def test_grams(t):
    got = L.grams(np.frombuffer(t.encode(), np.uint8))
    assert len(got) == len(set(got.tolist())) and decoded(got) == brute_grams(t.encode())


def labelled(docs_of):
    rows, i = [], 0
    for r in range(30):
        for lang, base in (("en", EN), ("de", DE), ("es", ES)):
            w = base.split()
            rows.append((i, " ".join(w[(r * 3 + k * 5) % len(w)] for k in range(12)), lang, "s", 1))
            i += 1
    return docs_of(*rows)


def test_scores_equal_plain_kernel_ridge(spark, docs_of):
    """The folded product against kernels computed set by set."""
    docs = labelled(docs_of)
    m = L.fit(docs, per_lang=8, landmarks=3)
    chosen = L.sample(docs, 8).toPandas().sort_values(["lang", "rank"])
    sets = [brute_grams(t.encode()) for t in chosen.text]
    k = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    marks = [s for s, r in zip(sets, chosen.groupby("lang").cumcount(), strict=True) if r < 3]
    kmm = np.array([[k(a, b) for b in marks] for a in marks])
    knm = np.array([[k(a, b) for b in marks] for a in sets])
    # ridge in the Nystroem space solved in its dual form: alpha over landmarks
    share = 1 / 8
    y = np.where(chosen.lang.to_numpy()[:, None] == np.array(m.langs)[None, :], 1.0, -1.0)
    a = np.block([[share * knm.T @ knm + L.RIDGE * kmm, share * knm.T.sum(1, keepdims=True)],
                  [share * knm.sum(0, keepdims=True), np.array([[share * len(sets)]])]])
    sol = np.linalg.lstsq(a, np.vstack([share * knm.T @ y, share * y.sum(0, keepdims=True)]), rcond=None)[0]
    for r in L.classify(docs, m).collect():
        s = brute_grams(r.text.encode())
        f = np.array([k(s, b) for b in marks]) @ sol[:-1] + sol[-1]
        p = np.exp(L.SHARPNESS * (f - f.max()))
        assert r.lang_pred == m.langs[int(p.argmax())]
        assert r.score == pytest.approx(p.max() / p.sum(), abs=1e-3)


def test_defined_results(spark, docs_of):
    m = L.fit(labelled(docs_of), per_lang=10, landmarks=5)
    docs = docs_of(None, "", " 12 … 3", "日本", EN, DE.upper(), (4, ES * 5000, None, None, None), (None, EN, "en", "s", 1)) \
        .withColumn("score", F.lit("clash")).withColumn("grams", F.lit(1))
    got = L.classify(docs, m).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and got[0].score == 0
    assert got[3].lang_pred in m.langs
    assert [r.lang_pred for r in got[4:]] == ["en", "de", "es", "en"] and all(0 < r.score <= 1 for r in got[4:])


def test_nothing_learned_and_empty(spark, docs_of):
    docs = docs_of((1, EN, None, "s", 1), (2, DE, None, "s", 1))
    m = L.fit(docs)
    assert [r.lang_pred for r in L.classify(docs, m).collect()] == ["und", "und"]
    assert L.classify(docs.filter("false"), m).collect() == []


def test_held_out_accuracy(spark):
    import __spark_entry__ as E
    from conftest import SF_MED

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MED}/documents.parquet").collect()}
    got = E.queries()["op10_language_id"](spark, SF_MED).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_blocks_do_not_matter(docs_of, spark):
    m = L.fit(labelled(docs_of), per_lang=10, landmarks=5)
    texts = [np.frombuffer(t.encode(), np.uint8) for t in (EN, DE, "", ES * 50, "zzz", EN[:7])]
    one = L.Scorer(m, cells=1).scores(texts)
    assert np.allclose(one, L.Scorer(m).scores(texts)) and len(L.Scorer(m, cells=1).present) == 1


def test_two_step_sample_takes_the_lowest_hashes(spark):
    rows = spark.range(5000).selectExpr("id doc_id", "concat('some text ', id) text",
                                        "if(id % 50 = 0, 'de', 'en') lang")
    got = L.sample(rows, 20).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"en": 20, "de": 20}
