"""Exact n-gram Jaccard self-join with set-relation skipping (operator 2).

A text's set holds the 64-bit hashes of its distinct 5-word shingles; equal sets
are one class.  Two sets link when 100 * |x & y| >= 75 * |x | y|.

1. *Order.*  Shingles are ordered rare first: those in ``HOT_SETS`` or more sets
   (counted over all texts) come last, the rest follow their hash.  Any order
   gives right results; this one keeps common passages out of the prefixes.
2. *Prefixes.*  Linked sets share a shingle among the first n - ceil(0.75 n) + 1
   of each.  Prefix entries (shingle, class, size, position) go to buckets by hash.
3. *Index lists, skipped in blocks.*  A list is sorted by size and position and
   cut into blocks; a pair of blocks whose sizes or positions rule out the
   needed overlap is skipped as a whole.  Pairs are counted over all buckets, and
   a pair stays only if its count and what lies behind the prefixes can reach the
   overlap.  Those pairs are verified with their whole sets.
4. *Large lists* (more than ``LONG_LIST`` classes, left after 1. in large groups of
   near copies) emit no pairs.  Their members form hot clusters, which are cut
   into blocks of bounded size; each pair of blocks is one group of a shuffle.  In
   it a set's overlaps with all others are derived from those of the similar set
   before it, by looking up only the shingles in which the two differ, and only
   links that connect something new are returned.
5. Links are closed to components by star contraction.

Nothing is dropped for size: both list kinds are exact.  The hot order table is a
top-k of fixed size, and a filter of fixed size picks the sets to verify.

Defined results: null text and text without words has n_shingles 0 and is its own
component; rows with equal texts share a component, rows of one doc_id with different texts need not; a null doc_id
never names a component while another row of it has an id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import input_partitions, stored
from cardwatch.llm.components import components
from cardwatch.llm.words import Words, _BASE, chunks, mix, shingles, signed, utf8

K = 5
#: Sets in which a shingle occurs from which it is ordered last, and how many such shingles are told to the tasks (8 MB).
HOT_SETS, HOT_MOST = 64, 1 << 20
#: Classes of a list from which it is worked on in blocks.
LONG_LIST = 64
#: Shingles in a block of a hot cluster.
BLOCK_SHINGLES = 1 << 17
#: Entries that a task holds before it hands them on.
FLUSH = 1 << 20
#: Bits of the filter that picks sets to verify (8 MB); too many sets only let more rows pass.
FILTER_BITS = 1 << 26


def needed(nx, ny):
    """The least overlap of linked sets of these sizes: inter >= 3 (nx + ny) / 7."""
    return -(-3 * (nx + ny) // 7)


def prefix_len(n):
    return n - -(-3 * n // 4) + 1


def linked(inter, nx, ny):
    return 100 * inter >= 75 * (nx + ny - inter)


def sets(column):
    """The sorted distinct shingle hashes of each text of an Arrow column, whole."""
    for i, j, data, off in chunks(*utf8(column)):
        w = Words(data, off)
        h = w.hashes()
        n = max(0, len(h) - K + 1)
        every = np.zeros(n, np.uint64)
        for k in range(K):
            every = (every + h[k:n + k]) * np.uint64(_BASE)
        every = mix(every + np.uint64(K))
        for t in range(j - i):
            a, b = w.first[t], w.first[t + 1]
            s = np.sort(every[a:b - K + 1]) if b - a >= K else shingles(h[a:b], K)
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
            yield s


def class_id(s: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D)))
    return int(mix(np.array([total + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, id) of each row; id is null without shingles."""
    def run(batches):
        for b in batches:
            n, ids = [], []
            for s in sets(b.column(1)):
                n.append(len(s))
                ids.append(class_id(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.int64())],
                                             ["doc_id", "n_shingles", "id"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, id long")


def _new_sets(batches, seen: set[int]):
    """(class, set) of the texts of a partition, equal sets once."""
    for b in batches:
        for s in sets(b.column(0)):
            if len(s):
                c = class_id(s)
                if c not in seen:
                    seen.add(c)
                    yield c, s


def _by_bucket(keys: np.ndarray, *more: np.ndarray):
    """(bucket, 32-bit rest of the key, other columns) as bytes, sorted by key."""
    order = np.argsort(keys)
    keys, more = keys[order], [m[order] for m in more]
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    rest = keys.astype(np.uint32)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            yield (int(bucket[a]), rest[a:b].tobytes(), *(m[a:b].tobytes() for m in more))


def top_bits(s: np.ndarray, bits: int) -> np.ndarray:
    """The bucket and 32 more bits of each hash; order is kept."""
    return s >> np.uint64(32 - bits)


def hot_shingles(texts: DataFrame, bits: int, hot_sets: int = HOT_SETS) -> np.ndarray:
    """Sorted keys of the most frequent shingles (at most ``HOT_MOST``), counted over the distinct sets of all texts.

    Only the half of each set with the lower hashes is counted: prefixes rarely reach further."""
    def emit(held):
        rows = list(_by_bucket(np.concatenate(held)))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           pa.array([r[1] for r in rows], pa.binary())], ["bucket", "keys"])

    def run(batches):
        held, n = [], 0
        for _, s in _new_sets(batches, set()):
            half = top_bits(s[:len(s) // 2 + 1], bits)
            held.append(half)
            n += len(half)
            if n >= FLUSH:
                yield emit(held)
                held, n = [], 0
        if held:
            yield emit(held)

    def count(t: pa.Table) -> pa.Table:
        keys, n = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in t.column("keys")]),
                            return_counts=True)
        hit = n >= hot_sets
        bucket = np.int64(t.column("bucket")[0].as_py())
        return pa.table({"key": pa.array((bucket << 32) | keys[hit].astype(np.int64)), "n": pa.array(n[hit])})

    top = texts.mapInArrow(run, "bucket int, keys binary").groupBy("bucket").applyInArrow(count, "key long, n long") \
        .orderBy(F.desc("n"), "key").limit(HOT_MOST).select("key").toPandas()
    return np.sort(top.key.to_numpy(np.int64)).astype(np.uint64)


def is_hot(hot: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(keys), bool)
    return hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys


def prefix(s: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """Keys of the set's first shingles in the global order (hot last, then by hash)."""
    p = prefix_len(len(s))
    keys = top_bits(s[:2 * p + 16], bits)
    mask = is_hot(hot, keys)
    if len(keys) - mask.sum() < p and len(keys) < len(s):
        keys = top_bits(s, bits)
        mask = is_hot(hot, keys)
    if mask.any():
        keys = np.concatenate([keys[~mask], keys[mask]])
    return keys[:p]


def postings(texts: DataFrame, hot, bits: int) -> DataFrame:
    """(bucket, keys, ids, ns, at): the prefix entries of the distinct sets, packed per bucket."""
    def emit(held):
        keys = np.concatenate([h[2] for h in held])
        size = [len(h[2]) for h in held]
        ids = np.repeat(np.array([h[0] for h in held], np.int64), size)
        ns = np.repeat(np.array([h[1] for h in held], np.int32), size)
        at = np.concatenate([np.arange(n, dtype=np.int32) for n in size])
        small = np.uint16 if ns.max() < 1 << 16 else np.int32
        rows = list(_by_bucket(keys, ids, ns.astype(small), at.astype(small)))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(
            pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3, 4))], ["bucket", "keys", "ids", "ns", "at"])

    def run(batches):
        held, n, order = [], 0, hot.value
        for c, s in _new_sets(batches, set()):
            held.append((c, len(s), prefix(s, order, bits)))
            n += len(held[-1][2])
            if n >= FLUSH:
                yield emit(held)
                held, n = [], 0
        if held:
            yield emit(held)

    return texts.mapInArrow(run, "bucket int, keys binary, ids binary, ns binary, at binary")


def _unpacked(t: pa.Table):
    key, ids, ns, at = [], [], [], []
    for k, i, n, p in zip(*(t.column(c) for c in ("keys", "ids", "ns", "at")), strict=True):
        key.append(np.frombuffer(k.as_py(), np.uint32))
        ids.append(np.frombuffer(i.as_py(), np.int64))
        kind = np.uint16 if len(n.as_py()) == 2 * len(key[-1]) else np.int32
        ns.append(np.frombuffer(n.as_py(), kind).astype(np.int64))
        at.append(np.frombuffer(p.as_py(), kind).astype(np.int64))
    key, ids, ns, at = map(np.concatenate, (key, ids, ns, at))
    order = np.lexsort((ids, at, ns, key))
    key, ids, ns, at = key[order], ids[order], ns[order], at[order]
    # equal sets met in several tasks are one entry
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]) | (at[1:] != at[:-1])])
    return key[once], ids[once], ns[once], at[once]


def list_pairs(ns: np.ndarray, at: np.ndarray, block: int = 16):
    """Index pairs of one list (sorted by size, then position) that sizes and positions allow, skipping blocks."""
    n = len(ns)
    starts = range(0, n, block)
    top = [(ns[i:i + block], at[i:i + block]) for i in starts]
    for x, (nx, px) in enumerate(top):
        for y in range(x, len(top)):
            ny, py = top[y]
            if 3 * ny[0] > 4 * nx[-1]:
                break  # all later blocks hold larger sets
            behind = min((nx - px).max(), (ny - py).max())
            if min(px.max(), py.max()) + behind < needed(nx[0], ny[0]):
                continue
            i, j = np.meshgrid(np.arange(len(nx)), np.arange(len(ny)), indexing="ij")
            i, j = i.ravel(), j.ravel()
            keep = (3 * ny[j] <= 4 * nx[i])
            if x == y:
                keep &= i < j
            # common shingles: those before both positions, this one, and those behind it
            keep &= np.minimum(px[i], py[j]) + np.minimum(nx[i] - px[i], ny[j] - py[j]) >= needed(nx[i], ny[j])
            yield i[keep] + x * block, j[keep] + y * block


CANDIDATE = "kind int, a long, b long, na long, nb long, c long"


def candidates(packed: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """kind 0: pairs (a, b) sharing c prefix shingles in short lists.  kind 1: class a is in c long lists with b."""
    def run(t: pa.Table) -> pa.Table:
        key, ids, ns, at = _unpacked(t)
        cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        size = np.diff(cut)
        out = [np.zeros((0, 6), np.int64)]

        def pairs(i, j):
            other = ids[i] != ids[j]  # two shingles of a set may share a key
            i, j = i[other], j[other]
            swap = (ns[i] > ns[j]) | ((ns[i] == ns[j]) & (ids[i] > ids[j]))
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            return np.stack([np.zeros(len(i), np.int64), ids[i], ids[j], ns[i], ns[j], np.ones(len(i), np.int64)], 1)

        two = cut[:-1][size == 2]  # most lists that have a pair at all have one
        near = 3 * ns[two + 1] <= 4 * ns[two]
        near &= np.minimum(at[two], at[two + 1]) + np.minimum(ns[two] - at[two], ns[two + 1] - at[two + 1]) >= \
            needed(ns[two], ns[two + 1])
        out.append(pairs(two[near], two[near] + 1))
        held = 0
        for a, b in zip(cut[:-1][size > 2], cut[1:][size > 2], strict=True):
            if b - a > long_list:
                rep = ids[a:b].min()
                star = np.zeros((b - a, 6), np.int64)
                star[:, 0], star[:, 1], star[:, 2], star[:, 3], star[:, 5] = 1, ids[a:b], rep, ns[a:b], 1
                out.append(star)
                continue
            for i, j in list_pairs(ns[a:b], at[a:b]):
                out.append(pairs(i + a, j + a))
                held += len(i)
            if held > FLUSH:
                out, held = [_summed(np.concatenate(out))], 0
        rows = _summed(np.concatenate(out))
        return pa.table({c.split()[0]: pa.array(rows[:, k], pa.int32() if k == 0 else pa.int64())
                         for k, c in enumerate(CANDIDATE.split(", "))})

    return packed.groupBy("bucket").applyInArrow(run, CANDIDATE)


def _summed(rows: np.ndarray) -> np.ndarray:
    """Equal (kind, a, b) as one row with the sum of c."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
    out = rows[new].copy()
    out[:, 5] = np.add.reduceat(rows[:, 5], np.flatnonzero(new))
    return out


def surviving(cand: DataFrame) -> DataFrame:
    """(a, b): pairs whose shared prefix shingles, and what can lie behind a prefix, reach the needed overlap."""
    pairs = cand.filter("kind = 0").groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"),
                                                          F.sum("c").alias("c"))
    in_long = cand.filter("kind = 1").groupBy("a").agg(F.sum("c").alias("l")).select(F.col("a").alias("m"), "l")
    pairs = pairs.join(in_long.toDF("a", "la"), "a", "left").join(in_long.toDF("b", "lb"), "b", "left")
    behind = lambda n: F.ceil(F.col(n) * 3 / 4) - 1
    both_long = F.least(*(F.coalesce(x, F.lit(0)) for x in ("la", "lb")))
    most = F.col("c") + both_long + F.greatest(behind("na"), behind("nb"))
    return pairs.filter(most * 7 >= (F.col("na") + F.col("nb")) * 3).select("a", "b")


def whole_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, s): the sets of the classes in ``ids``, each once.  A bit filter of fixed size drops most others before the join."""
    bit = F.pmod("id", F.lit(FILTER_BITS)) + 1  # Spark numbers bits from 1, in buckets of 32768
    bits = ids.select(bit.alias("h")).groupBy(F.expr("bitmap_bucket_number(h)").alias("k")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("bits")).collect()  # FILTER_BITS / 32768 rows at most
    mask = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bits:
        part = np.frombuffer(r.bits, np.uint8)
        mask[(r.k - 1) * 4096:(r.k - 1) * 4096 + len(part)] = part
    shared = texts.sparkSession.sparkContext.broadcast(mask)

    def run(batches):
        m = shared.value
        held, size = [], 0

        def emit():
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()),
                                               pa.array([h[1] for h in held], pa.binary())], ["id", "s"])

        for c, s in _new_sets(batches, set()):
            if m[c % FILTER_BITS // 8] >> (c % 8) & 1:
                held.append((c, s.tobytes()))
                size += len(s)
                if size >= FLUSH:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()

    return texts.mapInArrow(run, "id long, s binary").join(ids.select("id").distinct(), "id", "left_semi") \
        .groupBy("id").agg(F.first("s").alias("s"))


def verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """(a, b): the pairs that link, by their whole sets."""
    def run(batches):
        for b in batches:
            hit = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                hit.append(linked(int((y[at] == x).sum()), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    both = pairs.join(whole.toDF("a", "x"), "a").join(whole.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def spanning_links(ids: np.ndarray, members: list[np.ndarray], left: np.ndarray, right: np.ndarray):
    """Links between members of ``left`` and of ``right`` (masks) that join something not joined yet.

    The overlaps of a member with all others are derived from those of the member before it where the two differ in
    fewer shingles than it has: |y & z| = |r & z| - |(r - y) & z| + |(y - r) & z|."""
    size = np.array([len(s) for s in members])
    owner = np.repeat(np.arange(len(members)), size)
    every = np.concatenate(members)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]

    def overlaps(s):
        a, b = np.searchsorted(every, s, "left"), np.searchsorted(every, s, "right")
        n = b - a
        at = np.arange(n.sum()) + np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return np.bincount(owner[at], minlength=len(members))

    group = np.arange(len(members))
    out, before, known = [], None, None
    for y in np.flatnonzero(left):
        if (group[right] == group[y]).all():
            continue
        s = members[y]
        gone = new = None
        if before is not None:
            gone, new = np.setdiff1d(before, s, assume_unique=True), np.setdiff1d(s, before, assume_unique=True)
        if gone is not None and len(gone) + len(new) < len(s):
            known = known - overlaps(gone) + overlaps(new)
        else:
            known = overlaps(s)
        before = s
        hit = right & linked(known, size[y], size) & (group != group[y])
        for g in np.unique(group[hit]):
            z = np.flatnonzero(hit & (group == g))[0]
            out.append((ids[y], ids[z]))
            group[group == g] = group[y]
    return out


def hot_links(cand: DataFrame, whole: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b): links among the members of long lists, one group of a shuffle for each two blocks of a cluster."""
    members = cand.filter("kind = 1").groupBy("a").agg(F.max("na").alias("n"))
    cluster = components(cand.filter("kind = 1").select("a", "b")).select(F.col("id").alias("a"), "root")
    known = members.join(cluster, "a")
    blocks = known.groupBy("root").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"))
    # a member meets every block of its cluster once; equal blocks meet alone
    dealt = known.join(blocks, "root").withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("a", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(t: pa.Table) -> pa.Table:
        ids = t.column("a").to_numpy()
        order = np.argsort(ids)
        raw = t.column("s").to_pylist()
        own = t.column("own").to_numpy()[order]
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        got = spanning_links(ids[order], [np.frombuffer(raw[k], np.uint64) for k in order], own == i, own == j)
        return pa.table({"a": pa.array([x[0] for x in got], pa.int64()), "b": pa.array([x[1] for x in got], pa.int64())})

    return dealt.join(whole.withColumnRenamed("id", "a"), "a").groupBy("root", "i", "j").applyInArrow(run, "a long, b long")


def links(texts: DataFrame, long_list: int = LONG_LIST, hot_sets: int = HOT_SETS,
          block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b): links between classes whose closure is that of all links."""
    spark = texts.sparkSession
    bits = max(8, math.ceil(math.log2(4 * input_partitions(spark))))
    hot = spark.sparkContext.broadcast(hot_shingles(texts, bits, hot_sets))
    cand = stored(candidates(postings(texts, hot, bits), long_list), "sets-candidates")
    pairs = stored(surviving(cand), "sets-pairs")
    any_hot = bool(cand.filter("kind = 1").take(1))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    if any_hot:
        ids = ids.union(cand.filter("kind = 1").select("a"))
    whole = stored(whole_sets(texts, ids.distinct()), "sets-whole")
    found = verified(pairs, whole)
    return found.union(hot_links(cand, whole, block_shingles)) if any_hot else found


def join_components(docs: DataFrame, **sizes) -> DataFrame:
    """(doc_id, n_shingles, component_id, copies) of each row; copies: rows with an equal set, itself included."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(classes(d), "sets-classes")
    label = components(links(d.select("text"), **sizes))
    own = rows.filter("id is not null").groupBy("id").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    own = own.join(label, "id", "left").withColumn("root", F.coalesce("root", "id"))
    root = own.groupBy("root").agg(F.min("least").alias("component_id"))
    named = own.join(root, "root").select("id", "component_id", "copies")
    full = rows.filter("id is not null").join(named, "id", "left").select("doc_id", "n_shingles", "component_id", "copies")
    none = rows.filter("id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
                                            F.lit(1).cast("long").alias("copies"))
    return full.union(none)
