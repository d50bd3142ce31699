"""Benchmark decontamination (operator 3).

A document matches a benchmark item if a window of the item's size (in words) has
a weighted 5-word-shingle similarity of 0.75 or more with it (sum of the lesser
counts over sum of the greater ones).

* SimHash: each item and each window has a 64-bit fingerprint, the sign of the
  sum over its shingles (repeats count) of +1 / -1 per bit.  Windows slide, so
  their sums are differences of running sums.
* Multi-index: fingerprints are cut into ``RADIUS + 1`` blocks.  Two that differ in
  at most ``RADIUS`` bits agree in a block, so looking a window up in each block's
  table finds every item within the radius.  Similarity 0.75 lies at 11 bits
  (standard deviation 3), and equal passages at 0.
* The items so found are verified with their counted shingles.

A window that holds no shingle of any item cannot match one, so only windows
around such shingles are fingerprinted; all positions of all texts are tested for them.
The items are taken in blocks of ``BLOCK_SHINGLES`` shingles, whatever their
number: each block is broadcast and run against all documents.

Defined results: a row per matching (document row, item) with its best window
(first of equals); null or empty texts and items match nothing; an item of fewer
than five words matches where its whole sequence occurs; a document shorter than
an item is one window; equal items each give a row.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.words import _BASE, Words, chunks, mix, shingles, utf8

K = 5
RADIUS = 20
THRESHOLD = 0.75
BLOCK_SHINGLES = 1 << 21
#: Windows that are fingerprinted at once.
STEP = 1 << 14
_BITS = np.arange(64, dtype=np.uint64)
_FILTER = 1 << 24


def votes(s: np.ndarray) -> np.ndarray:
    return ((s[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of summed votes."""
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def window_prints(s: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each run of ``size`` shingles."""
    total = np.zeros((len(s) + 1, 64), np.int32)
    np.cumsum(votes(s), axis=0, out=total[1:])
    return pack(total[size:] - total[:-size])


def similarity(a: Counter, b: Counter) -> float:
    low = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return low / (sum(a.values()) + sum(b.values()) - low)


class MultiIndex:
    """Fingerprints within ``radius`` bits, by tables of radius + 1 blocks of bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        edge = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        self.tables = []
        for shift, mask in self.blocks:
            part = (prints >> shift) & mask
            order = np.argsort(part, kind="stable")
            self.tables.append((part[order], order))

    def near(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, each once."""
        found = []
        for (shift, mask), (values, order) in zip(self.blocks, self.tables, strict=True):
            part = (windows >> shift) & mask
            a, b = np.searchsorted(values, part, "left"), np.searchsorted(values, part, "right")
            n = b - a
            at = np.arange(n.sum()) + np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            w, i = np.repeat(np.arange(len(windows)), n), order[at]
            keep = np.bitwise_count(windows[w] ^ self.prints[i]) <= self.radius
            found.append(w[keep] * len(self.prints) + i[keep])
        key = np.unique(np.concatenate(found))
        return key // len(self.prints), key % len(self.prints)


@dataclass
class Items:
    """A block of items: words, shingle counts, and a sorted index from shingle to items."""
    ids: list
    words: np.ndarray
    counts: list[Counter]
    shingle: np.ndarray
    item: np.ndarray
    by_size: dict[int, tuple[np.ndarray, MultiIndex]]
    short: dict[int, dict[int, list[int]]]
    seen: np.ndarray


def index(ids: list, texts: list[str | None], radius: int = RADIUS) -> Items:
    words, counts, own, item, short = [], [], [], [], {}
    for t in texts:
        data, off = utf8(pa.array([t], pa.string()))
        h = Words(data, off).hashes()
        s = shingles(h, K)
        k = len(counts)
        words.append(len(h))
        counts.append(Counter(s.tolist()))
        if 0 < len(h) < K:
            short.setdefault(len(h), {}).setdefault(int(s[0]), []).append(k)
        elif len(h):
            u = np.unique(s)
            own.append(u)
            item.append(np.full(len(u), k))
    every = np.concatenate(own) if own else np.zeros(0, np.uint64)
    owner = np.concatenate(item) if item else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    sizes = np.array(words, np.int64)
    by_size = {}
    for n in np.unique(sizes[sizes >= K]).tolist():
        which = np.flatnonzero(sizes == n)
        prints = np.concatenate([pack(votes(np.array(list(counts[i].elements()), np.uint64)).sum(axis=0)[None, :]) for i in which])
        by_size[n] = which, MultiIndex(prints, radius)
    seen = np.zeros(_FILTER, bool)
    seen[every % np.uint64(_FILTER)] = True
    return Items(list(ids), sizes, counts, every, owner, by_size, short, seen)


def match_text(s: np.ndarray, n_words: int, hits: list[tuple[int, np.ndarray]], items: Items):
    """{item: (similarity, first word, words)} for one text: its shingles in order, and the places of items' shingles."""
    best: dict[int, tuple[float, int, int]] = {}
    checked: dict[int, set[int]] = {}
    for i, places in hits:
        size = int(items.words[i])
        span = min(size, n_words) - K + 1  # shingles in a window
        starts = np.unique(np.clip((places[:, None] - np.arange(span)[None, :]).ravel(), 0, len(s) - span))
        new = checked.setdefault(size, set())
        starts = np.array(sorted(set(starts.tolist()) - new), np.int64)
        new.update(starts.tolist())
        which, table = items.by_size[size]
        for group in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1) if len(starts) else []:
            for k in range(0, len(group), STEP):
                part = group[k:k + STEP]
                prints = window_prints(s[part[0]:part[-1] + span], span)[part - part[0]]
                for w, j in zip(*table.near(prints), strict=True):
                    at, j = int(part[w]), int(which[j])
                    sim = similarity(Counter(s[at:at + span].tolist()), items.counts[j])
                    if sim >= THRESHOLD and (j not in best or (-sim, at) < (-best[j][0], best[j][1])):
                        best[j] = sim, at, min(size, n_words)
    return best


def matches_of(column, items: Items):
    """(row, item, similarity, first word, words) of the matches of an Arrow column's texts."""
    for lo, _, data, off in chunks(*utf8(column)):
        w = Words(data, off)
        h = w.hashes()
        for size, table in items.short.items():
            if len(h) >= size:
                first = _runs(h, size)
                keys = np.array(sorted(table), np.uint64)
                at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, first), len(keys) - 1)] == first)
                doc = np.searchsorted(w.first, at, "right") - 1
                inside = at + size <= w.first[doc + 1]
                done = set()
                for p, d in zip(at[inside].tolist(), doc[inside].tolist(), strict=True):
                    for i in table[int(first[p])]:
                        if (d, i) not in done:
                            done.add((d, i))
                            yield lo + d, i, 1.0, p - int(w.first[d]), size
        if not len(items.shingle) or not len(h):
            continue
        s = _runs(h, K) if len(h) >= K else np.zeros(0, np.uint64)
        at = np.flatnonzero(items.seen[s % np.uint64(_FILTER)])
        left = np.searchsorted(items.shingle, s[at], "left")
        right = np.searchsorted(items.shingle, s[at], "right")
        doc = np.searchsorted(w.first, at, "right") - 1
        real = (right > left) & (at + K <= w.first[doc + 1])
        at, left, right, doc = at[real], left[real], right[real], doc[real]
        n = right - left
        which = items.item[np.arange(n.sum()) + np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n)] if len(at) else at
        place, doc = np.repeat(at, n), np.repeat(doc, n)
        order = np.lexsort((place, which, doc))
        place, which, doc = place[order], which[order], doc[order]
        for a, b in _runs_of(doc):
            d = int(doc[a])
            first, past = int(w.first[d]), int(w.first[d + 1])
            hits = [(int(which[a + x]), place[a + x:a + y] - first) for x, y in _runs_of(which[a:b])]
            for i, (sim, p, size) in sorted(match_text(s[first:past - K + 1], past - first, hits, items).items()):
                yield lo + d, i, sim, p, size


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, equal to ``shingles`` of that run alone."""
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = (out + h[k:len(out) + k]) * np.uint64(_BASE)
    return mix(out + np.uint64(size))


def _runs_of(x: np.ndarray) -> list[tuple[int, int]]:
    if not len(x):
        return []
    cut = np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]])
    return list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))


SCHEMA = "doc_id long, item_id long, similarity double, start_word long, n_words long"


def item_blocks(benchmark: DataFrame, most: int = BLOCK_SHINGLES):
    """Lists of items of about ``most`` words at most (one item at least), read one after another."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter("text is not null").orderBy("item_id", "text").toLocalIterator(prefetchPartitions=False)
    ids, texts, size = [], [], 0
    for r in rows:
        ids.append(r.item_id)
        texts.append(r.text)
        size += r.text.count(" ") + 1
        if size >= most:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def find_matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, most: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words) of each match."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for ids, items in item_blocks(benchmark, most):
        shared = spark.sparkContext.broadcast(index(ids, items, radius))

        def run(batches, shared=shared):
            block = shared.value
            for b in batches:
                got = list(matches_of(b.column(1), block))
                if got:
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(pa.array([g[0] for g in got])), pa.array([block.ids[g[1]] for g in got], pa.int64()),
                        *(pa.array([g[k] for g in got], t) for k, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64())))],
                        [c.split()[0] for c in SCHEMA.split(", ")])

        found = texts.mapInArrow(run, SCHEMA)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def without_matches(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, most: int = BLOCK_SHINGLES) -> DataFrame:
    """``docs`` without the rows that match an item; the blocks of items are applied one after another."""
    spark = docs.sparkSession
    for ids, items in item_blocks(benchmark, most):
        shared = spark.sparkContext.broadcast(index(ids, items, radius))

        def run(batches, shared=shared):
            block = shared.value
            for b in batches:
                clean = np.ones(len(b), bool)
                clean[[g[0] for g in matches_of(b.column("text"), block)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
