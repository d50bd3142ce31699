"""Paragraphs without a licence word stem are scored too, and such lines in the corpus do not teach that they are none."""

from pyspark.sql import functions as F

from cardwatch.llm import licences as L

PROSE = [f"word{i} stands here with that and the other{i % 7} of them in a line" for i in range(80)]
LINES = ["This project is released under Apache 2.0", "This project is released under the Apache 2.0"]


def test_a_notice_without_a_stem_is_found(spark):
    assert not any(s in t.lower() for t in LINES for s in L.STEMS)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*LINES, "of the\nsource code\nthe work", *PROSE])], "doc_id long, text string")
    got = {(r.doc_id, r.family) for r in L.find_licences(docs).collect()}
    assert got == {(0, "apache"), (1, "apache")}


def test_every_paragraph_of_the_unknown_class_is_learned(spark):
    """No paragraph is left out of the training or the calibration: a lookalike sets the limit, wherever its hash puts it."""
    lookalike = "under cc by nc {} others here"
    tries = spark.range(3000).select(F.format_string(lookalike.replace("{}", "%d"), "id").alias("t")) \
        .withColumn("h", F.xxhash64("t")).filter("pmod(h, 2) = 1").orderBy(F.col("h").desc())
    last = tries.first().t  # kept out of the training, its hash comes after nearly all others
    prose = [f"word{i} stands here with that and the other{i % 7} of them in a line" for i in range(2500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*prose, prose[0], last])], "doc_id long, text string")
    rows = L.featured(docs)
    of_last = rows.filter(F.col("h") == F.xxhash64(F.lit(last))).select("features").first().features
    got = L.unknown_rows(rows).collect()
    assert sum(r.n for r in got) == 2501 and [r.half for r in got if r.features == of_last] == [1]
    model = L.train(docs)
    p = model.probabilities(rows.filter(F.col("h") == F.xxhash64(F.lit(last)))).first().probability
    assert model.limit == p > L.LEAST_PROBABILITY
