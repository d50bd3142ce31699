import re

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import licences as L

PROSE = [f"word{i} stands here with that and the other{i % 7} of them in a line" for i in range(80)]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PROSE)], "doc_id long, text string")
    return L.train(docs)


def test_every_notice_has_a_stem_and_is_found(spark, model):
    rows = [(f, t) for f in L.FAMILIES for t in L.NOTICES[f]]
    assert all(any(s in t.lower() for s in L.STEMS) or "spdx" in t.lower() for _, t in rows)
    docs = spark.createDataFrame([(i, f"{PROSE[0]}\n{t}\n{PROSE[1]}") for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.find_licences(docs, model).collect()}
    assert {i: r.family for i, r in got.items()} == {i: f for i, (f, _) in enumerate(rows)}
    assert {r.paragraph for r in got.values()} == {1}


def test_variants_and_lookalikes(spark, model, docs_of):
    docs = docs_of("This file is LICENSED under the apache license version 2.0", "she has a driving licence and a dog of her own",
                   "the poet took great licence with the facts", None, "", PROSE[3], " ".join(PROSE[:9]) + ". Released under the MIT License. " + PROSE[4],
                   (None, "All rights reserved.", None, None, 1), (7, "All rights reserved.", "en", "s", 1), (7, "All rights reserved.", "en", "s", 1)) \
        .withColumn("w", F.lit("clash")).withColumn("family", F.lit("clash"))
    got = sorted((str(r.doc_id), r.family) for r in L.find_licences(docs, model).collect())
    assert got == [("0", "apache"), ("6", "mit"), ("7", "all_rights_reserved"), ("7", "all_rights_reserved"), ("None", "all_rights_reserved")]


def test_empty(spark, docs_of):
    assert L.find_licences(docs_of("x").filter("false")).collect() == []


def test_query_finds_the_planted_lines(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL

    kinds = {"Licensed under CC BY-NC 4.0.": "cc_by_nc", "Licensed under the Apache License, Version 2.0.": "apache",
             "This work is licensed under the GNU General Public License, version 3.": "gpl",
             "Released under the MIT License.": "mit", "All rights reserved.": "all_rights_reserved"}
    want = set()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        want |= {(r.doc_id, i, kinds[x]) for i, x in enumerate((r.text or "").split("\n")) if x in kinds}
    got = {(r.doc_id, r.paragraph, r.family) for r in E.queries()["op6_licences"](spark, SF_SMALL).collect()}
    assert want and want <= got
    others = {d for d, _, _ in got - want}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert all(re.search("(?i)licen|reserved|copyright", texts[d]) for d in others)
