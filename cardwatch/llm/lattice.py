"""Subword lattice likelihood (operator 5).

A word's probability is the sum over all its segmentations into pieces of an
existing vocabulary, found by a forward recursion in log space.  No piece of
that vocabulary spans two words, so a text's marginal probability is the
product over its words, and each distinct word needs one recursion.

* Prior weights come from the vocabulary file's scores.  It holds merge ranks
  (score = -rank) rather than log probabilities, so a piece's prior is
  Zipf's law on its rank; byte pieces, which have no rank, stand after all.
* Weights are then re-estimated on the training words by expected counts
  (forward-backward), smoothed by the prior.
* Each word is followed by a stop-or-go choice, with the stop's rate learned
  from the training texts.

The word table (hash, counts, log probability) is as large as the corpus's
vocabulary and stays distributed.  Only the ``hot`` most frequent words (a fixed
number) are broadcast; occurrences of all others are joined by key.  None of
those is frequent, so no key is hot.

Defined results: a null or empty text holds just the end token; a null doc_id
counts as the empty string for the held-out rule (crc32 = 0, held out); rows
with the same id are scored row by row; ``n_known`` counts tokens, repeats
included.  Words are compared by 64-bit hash.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import stored
from cardwatch.llm.words import LOWER, Words, chunks, mix, signed, utf8, _powers, _TABLE

#: Words broadcast with their counts, the most frequent first: 6 MB.
HOT_WORDS = 1 << 18
#: Distinct words held by a task before it hands its counts on.
FLUSH = 1 << 20
#: Rounds of expected counts.
ROUNDS = 1
#: Weight of the prior, in pieces.
PRIOR = 1000.0
#: Word length in bytes up to which words are worked on side by side.
SHORT = 48
_BLANK = 0x20


@functools.lru_cache(maxsize=2)
def vocabulary(model_file: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Pieces as bytes (word start as a blank), their prior weights, and the piece of each single byte."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, ranks, byte_piece = [], [], np.full(256, -1)
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            byte_piece[int(sp.id_to_piece(i)[1:-1], 16)] = len(pieces)
            pieces.append(b"")
            ranks.append(float(sp.get_piece_size()))
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            raw = sp.id_to_piece(i).replace("▁", " ").encode()
            if raw.find(b" ", 1) < 0:
                pieces.append(raw)
                ranks.append(min(-sp.get_score(i), float(sp.get_piece_size())))
    weight = 1.0 / (2.0 + np.array(ranks))
    return pieces, weight / weight.sum(), byte_piece


class Lattice:
    """Forward and backward sums over the segmentations of words (a blank, then the word's bytes)."""

    def __init__(self, pieces: list[bytes], weight: np.ndarray, byte_piece: np.ndarray):
        with np.errstate(divide="ignore"):
            self.logw = np.log(weight)
        self.byte_piece = byte_piece
        self.by_text = {p: i for i, p in enumerate(pieces) if p}
        self.longest = max(map(len, self.by_text), default=1)
        _powers(self.longest + SHORT + 1)
        self.tables = {}
        for size in range(1, self.longest + 1):
            own = [(p, i) for p, i in self.by_text.items() if len(p) == size]
            if own:
                keys = self._keys(np.frombuffer(b"".join(p for p, _ in own), np.uint8).reshape(-1, size), size)[:, 0]
                order = np.argsort(keys)
                self.tables[size] = keys[order], np.array([i for _, i in own])[order]

    @staticmethod
    def _keys(rows: np.ndarray, size: int) -> np.ndarray:
        """Hash of each substring of the given size in each row."""
        power, inverse = _powers(rows.shape[1] + 1)
        total = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
        np.cumsum(_TABLE[rows] * power[:rows.shape[1]], axis=1, out=total[:, 1:])
        return mix((total[:, size:] - total[:, :-size]) * inverse[:rows.shape[1] - size + 1])

    def edges(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(size, piece of each substring of that size or -1), then (0, piece of each single byte)."""
        out = []
        for size, (keys, ids) in self.tables.items():
            if size <= rows.shape[1]:
                found = self._keys(rows, size)
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                out.append((size, np.where(keys[at] == found, ids[at], -1)))
        return [*out, (0, self.byte_piece[rows])]

    def forward(self, rows: np.ndarray) -> tuple[np.ndarray, list]:
        n = rows.shape[1]
        edges = [(s, ids, np.where(ids >= 0, self.logw[ids], -np.inf)) for s, ids in self.edges(rows)]
        a = np.full((n + 1, len(rows)), -np.inf)
        a[0] = 0.0
        for j in range(1, n + 1):
            a[j] = _logsum([a[j - (s or 1)] + w[:, j - (s or 1)] for s, _, w in edges if (s or 1) <= j])
        return a, edges

    def log_prob(self, rows: np.ndarray) -> np.ndarray:
        return self.forward(rows)[0][-1]

    def expected(self, rows: np.ndarray, count: np.ndarray, into: np.ndarray) -> None:
        """Add each piece's expected number of uses in the words, which occur ``count`` times."""
        a, edges = self.forward(rows)
        n = rows.shape[1]
        b = np.full((n + 1, len(rows)), -np.inf)
        b[n] = 0.0
        for i in range(n - 1, -1, -1):
            b[i] = _logsum([b[i + (s or 1)] + w[:, i] for s, _, w in edges if i + (s or 1) <= n])
        for s, ids, w in edges:
            step = s or 1
            use = np.exp(a[:n - step + 1].T + w + b[step:].T - a[n][:, None]) * count[:, None]
            hit = ids >= 0
            into += np.bincount(ids[hit], use[hit], len(into))

    def long_word(self, word: bytes) -> float:
        """The forward recursion for one long word; linear in its length."""
        logw, n = self.logw.tolist(), len(word)
        byte = [logw[i] if i >= 0 else -math.inf for i in self.byte_piece.tolist()]
        a = [0.0] + [-math.inf] * n
        for j in range(1, n + 1):
            terms = [a[j - 1] + byte[word[j - 1]]]
            for i in range(max(0, j - self.longest), j):
                if (p := self.by_text.get(word[i:j])) is not None:
                    terms.append(a[i] + logw[p])
            top = max(terms)
            a[j] = top + math.log(sum(math.exp(t - top) for t in terms)) if top > -math.inf else top
        return a[n]


def _logsum(terms: list[np.ndarray]) -> np.ndarray:
    if len(terms) == 1:
        return terms[0]
    x = np.stack(terms)
    top = x.max(axis=0)
    base = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return base + np.log(np.exp(x - base).sum(axis=0))


def by_length(words: pa.Array):
    """(indexes, byte rows with the leading blank) of words of one length, some thousand at a time; long words alone."""
    data, off = utf8(words)
    size = np.diff(off)
    for n in np.unique(size[size < SHORT]):
        which = np.flatnonzero(size == n)
        for i in range(0, len(which), 4096):
            part = which[i:i + 4096]
            rows = np.full((len(part), n + 1), _BLANK, np.uint8)
            rows[:, 1:] = data[off[part][:, None] + np.arange(n)]
            yield part, rows
    for i in np.flatnonzero(size >= SHORT):
        yield np.array([i]), np.concatenate([[np.uint8(_BLANK)], data[off[i]:off[i + 1]]])[None, :]


def held_out_expr():
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10) == 0


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, word, c, c_all): occurrences of each distinct word in training texts and in all."""
    def run(batches):
        held: list[tuple] = []
        n = 0

        def merged():
            h = np.concatenate([x[0] for x in held])
            u, first, inv = np.unique(h, return_index=True, return_inverse=True)
            word = pa.concat_arrays([x[1] for x in held]).take(pa.array(first))
            c = np.bincount(inv, np.concatenate([x[2] for x in held]), len(u)).astype(np.int64)
            c_all = np.bincount(inv, np.concatenate([x[3] for x in held]), len(u)).astype(np.int64)
            return u, word, c, c_all

        def rows(x):
            for i in range(0, len(x[0]), 1 << 16):
                s = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(x[0][s])), x[1][s].cast(pa.string()), pa.array(x[2][s]), pa.array(x[3][s])],
                    ["h", "word", "c", "c_all"])

        for b in batches:
            train = ~b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, off in chunks(*utf8(b.column(1))):
                w = Words(data, off)
                if len(w):
                    in_train = np.repeat(train[i:j], np.diff(w.first))
                    h = w.hashes()
                    u, first, inv = np.unique(h, return_index=True, return_inverse=True)
                    held.append((u, w.text(first), np.bincount(inv, in_train, len(u)).astype(np.int64),
                                 np.bincount(inv, minlength=len(u))))
                    n += len(u)
                    if n > FLUSH:
                        held = [merged()]
                        n = len(held[0][0])
                        if n > FLUSH:
                            yield from rows(held[0])
                            held, n = [], 0
        if held:
            yield from rows(merged())

    parts = docs.select(held_out_expr().alias("held"), F.col("text").cast("string")).mapInArrow(
        run, "h long, word string, c long, c_all long")
    return parts.groupBy("word").agg(F.min("h").alias("h"), F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def learned_weights(words: DataFrame, model_file: str, rounds: int = ROUNDS) -> np.ndarray:
    """Piece weights after ``rounds`` of expected counts over the training words; as long as the vocabulary file."""
    pieces, prior, byte_piece = vocabulary(model_file)
    weight = prior
    for _ in range(rounds):
        def run(batches, weight=weight):
            own = vocabulary(model_file)
            model, total = Lattice(own[0], weight, own[2]), np.zeros(len(own[0]))
            for b in batches:
                count = b.column(1).to_numpy().astype(float)
                for which, rows in by_length(b.column(0)):
                    if rows.shape[1] > SHORT:
                        # a long word is counted stretch by stretch; its score is exact (long_word)
                        for k in range(0, rows.shape[1], SHORT):
                            model.expected(rows[:, k:k + SHORT], count[which], total)
                    else:
                        model.expected(rows, count[which], total)
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["piece", "used"])

        used = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, used double") \
            .groupBy("piece").agg(F.sum("used").alias("used")).toPandas()
        total = np.zeros(len(pieces))
        total[used.piece.to_numpy(int)] = used.used.to_numpy(float)
        weight = (total + PRIOR * prior) / (total.sum() + PRIOR)
    return weight


def with_log_prob(words: DataFrame, model_file: str, weight: np.ndarray) -> DataFrame:
    """(h, c, c_all, lp): each word's marginal log10 probability."""
    def run(batches):
        pieces, _, byte_piece = vocabulary(model_file)
        model = Lattice(pieces, weight, byte_piece)
        for b in batches:
            lp = np.zeros(len(b))
            for which, rows in by_length(b.column(1)):
                lp[which] = model.log_prob(rows) if rows.shape[1] <= SHORT else model.long_word(rows.tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(lp / math.log(10))], ["h", "c", "c_all", "lp"])

    return words.select("h", "word", "c", "c_all").mapInArrow(run, "h long, c long, c_all long, lp double")


TERMS = "doc_id long, held_out boolean, n_words long, known long, log_c double, lat double, rest array<long>"


def score(docs: DataFrame, model_file: str, rounds: int = ROUNDS, hot: int = HOT_WORDS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = stored(word_counts(docs), "lm-words")
    weight = learned_weights(counted, model_file, rounds)
    words = stored(with_log_prob(counted, model_file, weight), "lm-scored")
    tot = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = docs.select(held_out_expr().alias("held")).agg(F.count_if(~F.col("held")).alias("train"),
                                                          F.count("*").alias("all")).first()
    n_train = (tot.n or 0) + ends.train
    v = (tot.v or 0) + (ends.train > 0)
    below = math.log10(n_train + 0.1 * (v + 1))
    stop = (ends.train + 0.1) / (n_train + 0.2)
    go = math.log10(1 - stop)

    top = words.orderBy(F.desc("c_all"), "h").limit(hot).select("h", "c", "lp").toPandas().sort_values("h")
    shared = spark.sparkContext.broadcast(
        (top.h.to_numpy(np.int64), top.c.to_numpy(np.int64), top.lp.to_numpy(float)))

    def run(batches):
        h, c, lp = shared.value
        log_c = np.append(np.log10(c + 0.1), 0.0)
        c, lp = np.append(c, 0), np.append(lp, 0.0)
        for b in batches:
            out = []
            for i, j, data, off in chunks(*utf8(b.column(2))):
                w = Words(data, off)
                key = signed(w.hashes())
                at = np.searchsorted(h, key)
                if len(h):
                    hit = h[np.minimum(at, len(h) - 1)] == key
                    at = np.where(hit, at, len(h))
                else:
                    hit = np.zeros(len(key), bool)
                rest = np.concatenate([[0], np.cumsum(~hit)])[w.first]
                out.append((np.diff(w.first), _sums(c[at] > 0, w.first), _sums(log_c[at], w.first),
                            _sums(lp[at], w.first), np.diff(rest), key[~hit]))
            cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 6
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cols[4])]), pa.int32()),
                                             pa.array(cols[5], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1]).cast(pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()), lists], [f.split()[0] for f in TERMS.split(", ")])

    terms = stored(docs.select("doc_id", held_out_expr().alias("held_out"), "text").mapInArrow(run, TERMS)
                   .withColumn("uid", F.monotonically_increasing_id()), "lm-terms")
    rare = terms.select("uid", F.explode("rest").alias("h")).join(words.select("h", "c", "lp"), "h") \
        .groupBy("uid").agg(F.count_if(F.col("c") > 0).alias("known2"), F.sum(F.log10(F.col("c") + 0.1)).alias("log_c2"),
                            F.sum("lp").alias("lat2"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return terms.drop("rest").join(rare, "uid", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + z("known2") + F.lit(int(ends.train > 0))).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("log_c") + z("log_c2") + F.lit(math.log10(ends.train + 0.1)) - F.lit(below) * (F.col("n_words") + 1)
         ).alias("base_score"),
        (F.col("lat") + z("lat2") + F.lit(go) * F.col("n_words") + F.lit(math.log10(stop))).alias("score"))


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of x over first[i]:first[i + 1]."""
    out, full = np.zeros(len(first) - 1), first[1:] > first[:-1]
    if full.any():
        out[full] = np.add.reduceat(x.astype(float), first[:-1][full])
    return out
