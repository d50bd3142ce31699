"""Personal data (operator 4), DataFrame functions only.

Base spans come from four patterns.  They are the seeds of a bootstrapped
contextual extraction:

1. every identifier-like token (a word with a digit or an ``@``) is an
   *occurrence* of an instance (its value) in a lexical pattern (the two words
   before it); a token that a base span touches is a seed of that kind;
2. patterns and instances form a graph.  In each round a pattern's confidence for
   a kind is the mean score of its distinct instances, and an instance's score
   is 1 for a seed, else the mean confidence of its patterns;
3. patterns with enough distinct seeds and a high confidence extract the other
   instances that they precede, where the token has a seed's shape (runs of
   letters and digits, and the signs between) and enough digits.

Edges are counted per (pattern, instance) before they are joined, with the
partial counts taken in each task; scores are joined by key and never collected.

Defined results: null or empty text has no spans; each row gives one row, also
for repeated or null ids; positions are code points, whatever the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: Distinct seed values that a pattern needs, its confidence, an instance's score, and digits of a token.
MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE, MIN_DIGITS = 5, 0.8, 0.8, 6
#: Characters before a token in which its two context words are looked for.
CONTEXT_CHARS = 80

# The contract's patterns with possessive repeats and anchored starts, so that a long run is read once.
# Such a start is the only one in a run where the contract's pattern can match first.
_LOCAL = "A-Za-z0-9._%+-"
PATTERN = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without this have no match.
MAY = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Sum over the digits from the last: every second one doubled, less 9 above 9."""
    d = F.reverse(_digits(x))
    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), lambda i: F.when(
            i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
            F.substring(d, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(d, i, F.lit(1)).cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def passes(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return _luhn(x)
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    return F.lit(True)


def _spans(t: Column, regex: str, may: Column, keep) -> Column:
    """(start, end, value, gap before) of the matches that ``keep`` takes: the text is split at the matches, and the
    lengths of gaps and matches are summed up."""
    empty = F.array().cast("array<struct<a:int,b:int,v:string,gap:string>>")
    found = F.arrays_zip(F.split(t, regex, -1).alias("gap"), F.regexp_extract_all(t, F.lit(regex), F.lit(0)).alias("v"))
    step = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["v"]), F.lit(0))).alias("at"),
            F.when(F.coalesce(x["v"].isNotNull() & keep(x["v"]), F.lit(False)), F.concat(s["out"], F.array(F.struct(
                (s["at"] + F.length(x["gap"])).alias("a"), (s["at"] + F.length(x["gap"]) + F.length(x["v"])).alias("b"),
                x["v"].alias("v"), F.right(x["gap"], F.lit(CONTEXT_CHARS)).alias("gap"))))).otherwise(s["out"]).alias("out")),
        lambda s: s["out"])
    return F.when(may, step).otherwise(empty)


def scanned(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, one array of base spans per kind, tokens): only texts with a digit or ``@`` are looked into."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")) \
        .withColumn("any", F.col("t").rlike("[0-9@]"))
    return d.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id",
        *(F.transform(_spans(F.col("t"), PATTERN[k], F.col("any") & F.col("t").rlike(MAY[k]), lambda v, k=k: passes(k, v)),
                      lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))).alias(k) for k in KINDS),
        _spans(F.col("t"), TOKEN, F.col("any"), lambda v: F.lit(True)).alias("tokens"))


def shape(v: Column) -> Column:
    """Runs of digits as 9, of letters as a; other signs as they are."""
    return F.regexp_replace(F.regexp_replace(v, "[0-9]+", "9"), r"\p{L}+", "a")


def occurrences(scan: DataFrame) -> DataFrame:
    """(uid, a, b, inst, shape, digits, left, kind): identifier-like tokens in context; kind of the base span they touch."""
    o = scan.select("uid", F.explode("tokens").alias("x"), *KINDS)
    touched = F.coalesce(*(F.when(F.exists(k, lambda s: (s["a"] < F.col("x.b")) & (F.col("x.a") < s["b"])), F.lit(k))
                           for k in KINDS))
    core = F.regexp_replace("x.v", r"^[\p{Punct}&&[^+(]]++|\p{Punct}++$", "")
    lead = F.length("x.v") - F.length(F.regexp_replace("x.v", r"^[\p{Punct}&&[^+(]]++", ""))
    words = F.filter(F.split(F.lower("x.gap"), r"[^\p{L}]+"), lambda w: w != "")
    left = F.when(F.size(words) >= 2, F.array_join(F.slice(words, -2, 2), " "))
    return o.select("uid", (F.col("x.a") + lead).alias("a"), (F.col("x.a") + lead + F.length(core)).alias("b"),
                    core.alias("inst"), shape(core).alias("shape"), F.length(_digits(core)).alias("digits"),
                    left.alias("left"), touched.alias("kind")).filter(F.length("inst") > 0)


def bootstrap(occ: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(kind, left, confidence, seeds) of patterns and (kind, inst, score) of instances after the rounds."""
    edges = stored(occ.filter("left is not null").groupBy("left", "inst").agg(
        F.max("kind").alias("seed"), F.max("shape").alias("shape")), "pii-edges")
    # a kind is scored only for patterns that hold one of its seeds
    kinds = edges.filter("seed is not null").groupBy("left", F.col("seed").alias("kind")).agg(F.count("*").alias("seeds"))
    graph = stored(edges.join(kinds, "left"), "pii-graph")
    own = F.col("seed").eqNullSafe(F.col("kind"))
    score = graph.groupBy("kind", "inst").agg(F.max(own.cast("double")).alias("score"))
    pattern = None
    for r in range(rounds):
        pattern = graph.join(score, ["kind", "inst"]).groupBy("kind", "left").agg(
            F.avg("score").alias("confidence"), F.max("seeds").alias("seeds"))
        score = graph.join(pattern.select("kind", "left", "confidence"), ["kind", "left"]).groupBy("kind", "inst").agg(
            F.when(F.max(own), 1.0).otherwise(F.avg("confidence")).alias("score"))
        if r < rounds - 1:
            score = stored(score, f"pii-score-{r}")
    return pattern, score


def discovered(occ: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(uid, a, b, kind): tokens outside base spans that confident patterns extract."""
    pattern, score = bootstrap(occ, rounds)
    good = pattern.filter((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("seeds") >= MIN_SEEDS)).select("kind", "left")
    shapes = occ.filter("kind is not null").select("kind", "shape").distinct()
    new = occ.filter(F.col("kind").isNull() & (F.col("digits") >= MIN_DIGITS) & F.col("left").isNotNull()).drop("kind")
    return new.join(good, "left").join(shapes, ["kind", "shape"]).join(
        score.filter(F.col("score") >= MIN_SCORE).select("kind", "inst"), ["kind", "inst"]).select("uid", "a", "b", "kind")


def _named(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("k"), s["a"].alias("a"), s["b"].alias("b")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["k"], s["a"], s["b"])), ",")


def find_pii(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """A row for each row of ``docs``: counts per kind, digest of the base spans, and all spans; a discovered span's
    kind is ``ctx_`` and the kind whose contexts it shares."""
    scan = stored(scanned(docs), "pii-scan")
    occ = stored(occurrences(scan.filter(F.size("tokens") > 0)), "pii-occurrences")
    more = discovered(occ, rounds).distinct().groupBy("uid").agg(F.sort_array(F.collect_list(
        F.struct(F.concat(F.lit("ctx_"), "kind").alias("k"), "a", "b"))).alias("more"))
    none = F.array().cast("array<struct<k:string,a:int,b:int>>")
    base = F.concat(*(_named(k) for k in KINDS))
    return scan.join(more, "uid", "left").select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, F.coalesce("more", none))).alias("spans"),
        F.size(F.coalesce("more", none)).cast("long").alias("n_ctx"))
