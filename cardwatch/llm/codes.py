"""Vector codes by active-entry Lloyd rounds (operator 12).

Vectors of integers, floor(4096 x), are cut into 8 equal consecutive parts, and each part position has a codebook of 16
entries, at first the parts of the 16 vectors of least id.  A round gives every part its nearest entry (squared
Euclidean distance, the lower index of equals) and moves each entry to its parts' componentwise floor(sum / count).

The state of a round is a row per vector: its integers, and each part's entry and exact distance.  A round's task reads
the rows of the round before and compares by this rule:

* an assigned entry that has not moved keeps the stored distance, so the part is compared with the moved entries only;
  an entry that was not nearest before and has not moved cannot become nearest.  Of equal distances the lower index
  wins, be it the stored one's or a moved one's;
* a part whose entry has moved is compared with all entries.

The state is kept on executors' disks (``persist``), two rounds at once; what a lost executor held is computed again
from the input.  Per round the driver gets the summed parts of each entry (8 x 16 of them for any input) from a map-side
combined aggregation, and makes the codebooks; nothing else leaves the executors.

Defined results: rows whose vector is null, empty, of a length other than the first kept vector's or not a multiple of
8, or holds a null or non-finite component are dropped.  Integers beyond a bound count as the bound: the largest power
of two whose distances fit in 63 bits, 2^27 (components of 32,768) for 64 dimensions.  Repeated ids are rows of their
own; of equal ids the one with the lesser integers counts as first, and a null id comes last.  With fewer than 16 rows,
codebooks have as many entries.  Sums of errors stop at 2^63 - 1.  Columns but the id, vector and label are dropped.
An empty table has no codes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import small_or_not, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MOST = (1 << 63) - 1
_STATE = "vec_id long, label string, v array<long>, entry binary, distance binary"
_SUMS = "part int, entry int, at int, total long, n long"


def bound(length: int) -> int:
    """Integers up to this have whole-vector distances below 2^63."""
    width = max(1, length // PARTS)
    return 1 << ((59 - (width - 1).bit_length()) // 2 - 1)


def integers(vectors: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows whose components are all finite and whose length can be cut."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.lit(2.0 ** 52)
    whole = F.transform(v, lambda x: F.floor(F.greatest(-most, F.least(most, x * scale))).cast("long"))
    return vectors.filter(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % PARTS == 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("v"))


def first_entries(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The rows of the first one's length, and the codebooks [part, entry, position] that the first rows make."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v").asc()]
    got = [x.v for x in rows.orderBy(*order).limit(ENTRIES).collect()]
    if not got:
        return rows, np.zeros((PARTS, 0, 0), np.int64)
    size = len(got[0])
    rows = rows.filter(F.size("v") == size)
    if any(len(x) != size for x in got):
        got = [x.v for x in rows.orderBy(*order).limit(ENTRIES).collect()]
    most = F.lit(bound(size))
    held = rows.withColumn("v", F.transform("v", lambda x: F.greatest(-most, F.least(most, x))))
    book = np.clip(np.array(got, np.int64), -bound(size), bound(size))
    return held, book.reshape(len(got), PARTS, -1).transpose(1, 0, 2).copy()


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer parts [n, width] to entries [k, width]."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < 1 << 53:  # doubles hold every term, so one matrix product is exact
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(entries)), np.int64)
    for k, c in enumerate(entries):
        out[:, k] = ((x - c) ** 2).sum(1)
    return out


def assign_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = distances(x, entries)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def assign_active(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entries again, from those of the round before and their distances."""
    if not moved.any():
        return at, dist
    at, dist = at.copy(), dist.copy()
    again = moved[at]
    if again.any():
        at[again], dist[again] = assign_all(x[again], entries)
    stay = np.flatnonzero(~again)
    if len(stay):
        some = np.flatnonzero(moved)
        k, d = assign_all(x[stay], entries[some])
        k = some[k]
        nearer = (d < dist[stay]) | ((d == dist[stay]) & (k < at[stay]))
        at[stay[nearer]], dist[stay[nearer]] = k[nearer], d[nearer]
    return at, dist


def _parts(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), PARTS, width)


def _bytes(column: pa.Array, kind: type) -> np.ndarray:
    """A column of equally long byte strings as a matrix [row, part]."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), PARTS)


def _as_binary(m: np.ndarray) -> pa.Array:
    width = m.shape[1] * m.itemsize
    off = np.arange(len(m) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(m))])


def _assigner(book: np.ndarray, before: np.ndarray | None):
    """One round over batches of the state of the round before; ``before`` has that round's codebooks."""
    moved = None if before is None else (book != before).any(2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _parts(batch.column(2), book.shape[2])
            if before is not None:
                entry, dist = _bytes(batch.column(3), np.uint8).astype(np.int64), _bytes(batch.column(4), np.int64)
            got = [assign_all(x[:, p], book[p]) if before is None else
                   assign_active(x[:, p], book[p], moved[p], entry[:, p], dist[:, p]) for p in range(PARTS)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _as_binary(np.stack([k for k, _ in got], 1).astype(np.uint8)),
                 _as_binary(np.stack([d for _, d in got], 1))], ["vec_id", "label", "v", "entry", "distance"])
    return run


def _summer(entries: int, width: int):
    """A task's summed parts and counts of each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((PARTS, entries, width), np.int64), np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, at = _parts(batch.column(0), width), _bytes(batch.column(1), np.uint8).astype(np.int64)
            for p in range(PARTS):
                n[p] += np.bincount(at[:, p], minlength=entries)
                order = np.argsort(at[:, p], kind="stable")
                begin = np.searchsorted(at[order, p], np.arange(entries))
                held = np.flatnonzero(np.diff(np.append(begin, len(order))))
                total[p, held] += np.add.reduceat(x[order, p], begin[held], axis=0)
        part, entry, at = np.nonzero(np.broadcast_to(n[:, :, None] > 0, total.shape))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(at.astype(np.int32)),
             pa.array(total[part, entry, at]), pa.array(n[part, entry])], ["part", "entry", "at", "total", "n"])
    return run


def next_book(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """Each entry moved to the floored mean of its parts; one without parts stays."""
    sums = state.select("v", "entry").mapInArrow(_summer(book.shape[1], book.shape[2]), _SUMS).groupBy("part", "entry", "at").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = book.copy()
    for r in sums.collect():
        out[r.part, r.entry, r["at"]] = int(r.total) // r.n
    return out


def _coder(book: np.ndarray, before: np.ndarray | None):
    """The last round, as codes and errors."""
    assign = _assigner(book, before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in assign(batches):
            code = pa.array([x.hex() for x in batch.column(3).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], code, pa.array(_bytes(batch.column(4), np.int64).sum(1))], ["vec_id", "label", "code", "error"])
    return run


def encode(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of each kept vector, as a written table, and the codebooks [part, entry, position]."""
    rows, book = first_entries(integers(vectors, vector))
    state = rows.select("*", F.lit(None).cast("binary").alias("entry"), F.lit(None).cast("binary").alias("distance"))
    before, held = None, None
    for _ in range(rounds if book.shape[1] else 0):
        state = state.mapInArrow(_assigner(book, before), _STATE).persist(StorageLevel.DISK_ONLY)
        before, book = book, next_book(state, book)  # which fills the state
        if held is not None:
            held.unpersist()
        held = state
    coded = stored(state.mapInArrow(_coder(book, before), "vec_id long, label string, code string, error long"), "codes")
    if held is not None:
        held.unpersist()
    return coded, book


def compress(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each kept vector."""
    coded, book = encode(vectors, vector)
    most = F.lit(MOST).cast("decimal(38,0)")
    by_label = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    by_label = stored(by_label, "codes-labels")
    both = coded.alias("c").join(small_or_not(by_label).alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(sha256_of(book)).alias("codebooks_sha256"))


def decoded(coded: DataFrame, book: np.ndarray, out: str = "approximation") -> DataFrame:
    """``coded`` with the vector that each code stands for: the entries of its parts, divided by the scale."""
    entries = F.array(*(F.array(*(F.array(*(F.lit(int(x)) for x in e)) for e in part)) for part in book))
    at = [F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") for p in range(PARTS)]
    whole = F.flatten(F.array(*(F.get(F.get(entries, F.lit(p)), at[p]) for p in range(PARTS))))
    return coded.withColumn(out, F.transform(whole, lambda x: x / F.lit(float(SCALE))))


def sha256_of(book: np.ndarray) -> str:
    """Lowercase hex of all entries' components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()
