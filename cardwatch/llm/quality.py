"""Quality rules with adaptive thresholds (operator 8), DataFrame functions only.

Counts per text are array and string functions, with no shuffle.  Thresholds
come from mergeable quantile sketches: relative-error histograms (bucket i holds
values in (g^(i-1), g^i]), whose merge is a sum of counts.  They are built per
language and source, merged upwards into languages and the whole corpus, and a
group with too few texts takes its parent's threshold.  The partial sums are
taken before the shuffle, so a source with a third of all rows reaches the
reducers as a few hundred rows.

Verdict: a text is dropped if a base rule fails, or if a feature is above the
group's fence ``q90 + 3 * max(q90 - q50, least)``.  ``least`` is the smallest
spread that counts as one, per feature, so that a group of near-constant texts
does not drop its ordinary ones: a line said twice in a text of three, or a
sentence said twice in a short one.

Defined results: null text counts as empty (0 words, base_failed); null language
or source is a group of its own; each row gives one row, also for repeated or
null ids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import stored, text_or_empty

MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 20, 30, 8
#: Growth of the histogram's buckets: quantiles within 2 %.
GROWTH = 1.02
#: Texts below which a group takes the threshold of the next larger one.
LEAST_TEXTS = 100
#: feature (per thousand words, lines or in hundredths of a character): the smallest spread.
LEAST_SPREAD = {"symbols": 50, "dup_lines": 150, "repeats": 100, "word_len": 100}
FENCE = 3
GAP = r"[\x20\x09-\x0D]+"


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of each row."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                    F.col("source").cast("string").alias("source"), text_or_empty().alias("t"))
    t = t.select(
        "doc_id", "lang", "source",
        F.array_remove(F.split("t", GAP), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.size(F.split("t", "[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"))
    n = F.size("words")
    t = t.select(
        "doc_id", "lang", "source", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).alias("h"))
    return t.withColumn("twice", F.size(F.array_distinct("h")) < F.size("h")).withColumn(
        "p", F.when(F.col("twice"), _repeated_starts(F.col("h")))).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(_covered(F.col("p")), F.lit(0)).cast("long").alias("n_repeat_words"))


def _repeated_starts(h: Column) -> Column:
    """Places, in order, of the windows whose hash occurs at another place too: sort by hash, compare neighbours."""
    by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    same = F.zip_with(F.slice(by_hash, 1, F.size(h) - 1), F.slice(by_hash, 2, F.size(h) - 1),
                      lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])))
    return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))


def _covered(starts: Column) -> Column:
    """Words under windows that start at the given places."""
    return F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, x: F.struct(x.alias("last"), (s["n"] + F.least(F.lit(WINDOW), x - s["last"])).alias("n")),
        lambda s: s["n"])


def features() -> dict[str, Column]:
    """Whole numbers, null where a text has nothing to measure."""
    c = F.col
    per = lambda a, b: F.when(c(b) > 0, F.floor(c(a) * 1000 / c(b)))
    return {"symbols": per("n_symbols", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"),
            "repeats": per("n_repeat_words", "n_words"),
            "word_len": F.when(c("n_words") > 0, F.floor(c("word_chars") * 100 / c("n_words")))}


def bucket(x: Column) -> Column:
    return F.ceil(F.log(x + 1) / math.log(GROWTH)).cast("int")


def bucket_top(i: Column) -> Column:
    return F.pow(F.lit(GROWTH), i) - 1


#: Groups from small to large; ``corpus`` is a constant.
LEVELS = (("lang", "source"), ("lang",), ("corpus",))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, feature, i, n): the histogram of each group's texts that pass the base rules."""
    f = features()
    long = measured.filter(~F.col("base_failed")).select(
        "lang", "source", F.explode(F.map_from_arrays(F.array(*map(F.lit, f)), F.array(*f.values()))).alias("feature", "x"))
    return long.filter("x is not null").groupBy("lang", "source", "feature", bucket(F.col("x")).alias("i")).agg(
        F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, feature, texts, q50, q90) of the sketches merged by ``keys``."""
    merged = sketch.groupBy(*keys, "feature", "i").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "feature")
    run = merged.withColumn("below", F.sum("n").over(group.orderBy("i"))).withColumn("texts", F.sum("n").over(group))
    at = lambda pct: F.min(F.when(F.col("below") * 100 >= F.col("texts") * pct, F.col("i")))
    return run.groupBy(*keys, "feature").agg(
        F.max("texts").alias("texts"), bucket_top(at(50)).alias("q50"), bucket_top(at(90)).alias("q90"))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, one column per feature): each group's fence, from the smallest level with enough texts."""
    out = []
    for keys in LEVELS:
        q = quantiles(sketch.withColumn("corpus", F.lit(0)), keys)
        least = F.element_at(F.create_map(*(F.lit(x) for kv in LEAST_SPREAD.items() for x in kv)), F.col("feature"))
        fence = F.col("q90") + FENCE * F.greatest(F.col("q90") - F.col("q50"), least)
        if keys != LEVELS[-1]:
            fence = F.when(F.col("texts") >= LEAST_TEXTS, fence)
        out.append(q.groupBy(*keys).pivot("feature", list(LEAST_SPREAD)).agg(F.first(fence)))
    own, lang, every = out
    last = every.first()  # one row of four numbers, or none
    join = own.alias("o").join(lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")), "left")
    return join.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), *(
        F.coalesce(F.col(f"o.{k}"), F.col(f"l.{k}"), F.lit(last[k] if last else None).cast("double")).alias(f"max_{k}")
        for k in LEAST_SPREAD))


def judge(docs: DataFrame) -> DataFrame:
    """The counts of each row, ``base_failed``, ``kept``, and the group's fences."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    measured = stored(counts(docs).withColumn("base_failed", failed), "quality-counts")
    limits = fences(stored(sketches(measured), "quality-sketches"))
    odd = [F.coalesce(v > F.col(f"max_{k}"), F.lit(False)) for k, v in features().items()]
    kept = ~F.col("base_failed")
    for o in odd:
        kept = kept & ~o
    m = measured.alias("m").join(
        limits.alias("t"), F.col("m.lang").eqNullSafe(F.col("t.lang")) & F.col("m.source").eqNullSafe(F.col("t.source")), "left")
    return m.withColumn("kept", kept).select(
        *(f"m.{c}" for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                             "base_failed")), "kept")
