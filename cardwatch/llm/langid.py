"""Language ID by a string kernel (operator 10).

Kernel: two texts share k(x, z) = |G(x) & G(z)| / sqrt(|G(x)| |G(z)|), where G is
the set of byte n-grams of lengths 1 to 3 (blended spectrum, presence) of the
lower-cased text, blanks alike.  Nystroem landmarks (some texts per language)
give features K_mm^-1/2 k(x, landmarks), on which one-versus-rest kernel ridge
regression is solved.  Texts are scored by batched matrix products: the presence
matrix (text x n-gram) of a block of texts times the weights (n-gram x language),
which are the landmark matrix times the solved coefficients.

Bounds: the fit uses at most ``PER_LANG`` labelled texts of each language,
``LANDMARKS`` of them as landmarks, chosen by a hash of the id.  All texts are
read whole and all rows are predicted.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and
where nothing was learned; a null id belongs to the learning rows unless the
crc32 of the empty string says otherwise; every input row gives one row, so
repeated ids do too; ties go to the language that sorts first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.words import LOWER, SPACE, utf8

PER_LANG = 1000
LANDMARKS = 48
#: Cells of the presence matrix of one block of texts (16 MB of doubles).
BLOCK_CELLS = 1 << 21
RIDGE = 1e-3
SHARPNESS = 4.0
UNKNOWN = "und"

_FOLD = LOWER.copy()
_FOLD[SPACE] = 0x20
_TWO, _THREE = 256, 256 + (1 << 16)
CODES = _THREE + (1 << 24)
_LETTER = re.compile(r"[^\W\d_]")


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))] if len(x) else x


def grams(text: np.ndarray) -> np.ndarray:
    """Codes of the distinct n-grams of a text's bytes."""
    b = _FOLD[text].astype(np.uint32)
    three = _distinct(b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else b[:0]
    two = _distinct(np.concatenate([three >> 8, b[-2:-1] << 8 | b[-1:]])) if len(b) > 1 else b[:0]
    one = _distinct(np.concatenate([two >> 8, b[-1:]]))
    return np.concatenate([one, two + _TWO, three + _THREE])


@dataclass
class Model:
    langs: list[str]
    codes: np.ndarray       # n-grams of the landmarks, sorted
    weights: np.ndarray     # (n-gram, language): landmark matrix times the solved coefficients
    bias: np.ndarray

    def table(self) -> np.ndarray:
        at = np.zeros(CODES, np.int32)
        at[self.codes] = np.arange(1, len(self.codes) + 1)
        return at


class Scorer:
    """Kernel scores of many texts: rows of a presence matrix, multiplied block by block."""

    def __init__(self, m: Model, cells: int = BLOCK_CELLS):
        self.m, self.table = m, m.table()
        self.present = np.zeros((max(1, cells // max(1, len(m.codes))), len(m.codes)))

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """(text, language) of the texts' bytes."""
        out = np.zeros((len(texts), len(self.m.langs)))
        for start in range(0, len(texts), len(self.present)):
            block = texts[start:start + len(self.present)]
            sizes, columns = np.empty(len(block)), []
            for r, t in enumerate(block):
                own = grams(t)
                sizes[r] = max(1, len(own))
                at = self.table[own]
                columns.append(at[at > 0] - 1)
                self.present[r, columns[-1]] = 1.0
            out[start:start + len(block)] = \
                self.present[:len(block)] @ self.m.weights / np.sqrt(sizes)[:, None] + self.m.bias
            for r, c in enumerate(columns):
                self.present[r, c] = 0.0
        return out


def learning_expr():
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4) != 2


def sample(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """(text, lang, rank): at most ``per_lang`` labelled learning rows of each language.

    Picked in two steps: a count of each language gives a bound on the id's hash that about
    ``2 * per_lang`` of its rows meet, then those are ranked, so that a task ranks no more of a
    language than that.  A language with up to ``4 * per_lang`` rows is ranked whole."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(learning_expr() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    many = rows.groupBy("lang").agg(F.count("*").alias("many"))
    low = (F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))) * F.col("many") < 2.0 * per_lang
    # a row for each language, of which the model holds a column on the driver anyway; without the hint all rows are
    # dealt by language before the filter
    few = rows.select("doc_id", "lang").join(F.broadcast(many), "lang").filter((F.col("many") <= 4 * per_lang) | low) \
        .select("doc_id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned(F.xxhash64("doc_id"), 11), "doc_id")
    chosen = few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_lang)
    return rows.join(F.broadcast(chosen), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])


def fit(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    chosen = sample(docs, per_lang)

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            sets = [grams(data[off[i]:off[i + 1]]).astype("<u4").tobytes() for i in range(len(b))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sets, pa.binary())],
                                             ["lang", "rank", "grams"])

    got = chosen.select("lang", "text", "rank").mapInArrow(run, "lang string, rank int, grams binary") \
        .toPandas().sort_values(["lang", "rank"])
    sets = [np.frombuffer(x, "<u4") for x in got.grams]
    langs = sorted(set(got.lang))
    if not langs:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0))
    place = got.groupby("lang").cumcount().to_numpy()
    marks = [s for s, p in zip(sets, place, strict=True) if p < landmarks]
    codes = _distinct(np.concatenate(marks)).astype(np.int64)
    z = np.zeros((len(codes), len(marks)), np.float32)
    for j, s in enumerate(marks):
        z[np.searchsorted(codes, s), j] = 1 / np.sqrt(max(1, len(s)))

    def against(s):
        at = np.searchsorted(codes, s)
        at = at[(at < len(codes)) & (codes[np.minimum(at, len(codes) - 1)] == s)]
        return z[at].sum(axis=0) / np.sqrt(max(1, len(s)))

    k_mm = np.stack([against(s) for s in marks])
    value, vector = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = value > 1e-6 * value[-1]
    whiten = vector[:, keep] / np.sqrt(value[keep])
    x = np.stack([against(s) for s in sets]) @ whiten
    y = np.where(got.lang.to_numpy()[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    share = got.lang.map(1 / got.lang.value_counts()).to_numpy()  # each language counts alike
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [0.0])
    solved = np.linalg.lstsq(x1.T @ (x1 * share[:, None]) + penalty, x1.T @ (y * share[:, None]), rcond=None)[0]
    return Model(langs, codes, z.astype(float) @ (whiten @ solved[:-1]), solved[-1])


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    have = {c.lower() for c in docs.columns}
    while name.lower() in have:
        name += "_"
    return name


def classify(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` plus the predicted language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in (pred, score)]
    names = [f.name for f in kept]

    def run(batches):
        scorer = Scorer(shared.value)
        langs = scorer.m.langs
        for b in batches:
            column = b.column(text)
            data, off = utf8(column)
            has = pc.match_substring_regex(column.fill_null(""), "[A-Za-z]").to_numpy(zero_copy_only=False)
            told = [i for i in range(len(b)) if langs and (has[i] or _LETTER.search(column[i].as_py() or ""))]
            best, top = [UNKNOWN] * len(b), np.zeros(len(b))
            if told:
                f = scorer.scores([data[off[i]:off[i + 1]] for i in told])
                p = np.exp(SHARPNESS * (f - f.max(axis=1, keepdims=True)))
                j = p.argmax(axis=1)
                top[told] = p[np.arange(len(told)), j] / p.sum(axis=1)
                for i, k in zip(told, j, strict=True):
                    best[i] = langs[k]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(best, pa.string()), pa.array(top)],
                                             [*names, pred, score])

    return docs.mapInArrow(run, T.StructType(
        [*kept, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]))
