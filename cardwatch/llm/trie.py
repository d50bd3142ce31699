"""Conversation prefix trie in double arrays (operator 11).

A conversation is rebuilt as the first h turns of conversation c - c % 20 and its own turns after its first h; h is
crc32(c) % 4.  A node of the trie is a distinct sequence of first turns; its members start with it.

1. A turn is reduced to a 128-bit hash of (role, text) and the words of its text; texts are not shuffled, but where two
   turns of a conversation have one number and are put in order by role and text.  Places in a conversation are numbered
   by a sort over all tasks (``ranked``).
2. Equal rebuilt conversations become one path, of the least conv_id, with their number, so a common conversation costs
   one path.  A path is cut into stretches of ``STRETCH`` turns, each with the key of the node where it starts (the
   exclusive or of its turns' hashes with their depths), so that no row grows with a conversation.
3. Stretches are sorted over all tasks by starting node and first turns.  Each run of them, a prefix shard, is packed into
   a double array: its turns get dense ids, a child by turn t of the node in slot s lies in slot BASE[s] + t, where CHECK
   holds s.  Nodes with several children look for a base whose slots are free; those with one take the free slots in
   turn.  All paths then walk through the array at once and leave their members, least conv_id and ends in its slots.
4. Upper nodes occur in many shards: nodes' aggregates are merged by key with map-side combine.
5. What a subtree sums up is spread by paths.  A node belongs to its least member, and the nodes of a path that belong to
   it are its last ones, so a path has one number of saved tokens for the nodes above those, and running sums for
   them.  A second walk adds these numbers, and each childless end, to the nodes that the paths pass.

Memory is bounded by the rows of a shard (an Arrow batch); no conversation, node or group meets in one task, but for the
ends of one node: their digest is a chain of bytes, so one task reads their ids in order, in chunks of up to 4,096.

Defined results: null role or text count as empty; turns with one number (null first) go by role, then text, equal ones are
turns of their own; rows with a null conv_id are dropped; c % 20 has the sign of c; a conversation without rebuilt turns
ends at the root; an empty table has no nodes, not even a root; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import input_partitions, ranked, small_or_not, stored, text_or_empty

FAMILY, SHARED = 20, 4
#: Turns of a path in one row.
STRETCH = 64
#: Paths packed into one double array at most.
SHARD_ROWS = 4096
CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
_KEY = ["k1", "k2", "depth"]


# rebuilt conversations ------------------------------------------------------------------------------------------------

def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % SHARED).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, t1, t2, words): ``tie`` orders the turns of a conversation that have one number."""
    role, text = text_or_empty("role"), text_or_empty("text")
    d = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                           role.alias("role"), text.alias("text"))
    t1, t2 = F.xxhash64("role", F.lit(0), "text"), F.xxhash64(F.lit("turn"), "role", F.lit(1), "text")
    rows = stored(d.select("conv_id", "turn", t1.alias("t1"), t2.alias("t2"),
                           F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).cast("long").alias("words")), "trie-turns")
    many = rows.groupBy("conv_id", "turn").agg(F.countDistinct("t1", "t2").alias("n")).filter("n > 1").select("conv_id", "turn")
    many = stored(many, "trie-ties")
    if not many.take(1):
        return rows.withColumn("tie", F.lit(0).cast("long"))
    key = F.struct(F.col("conv_id"), F.col("turn"))
    some = small_or_not(many.select(key.alias("key")))
    texts = d.withColumn("key", key).join(some, "key", "left_semi").select("key", "role", "text", t1.alias("t1"), t2.alias("t2")).distinct()
    ties = ranked(texts, ["key"], ["role", "text"], "tie", "trie-tied").select("key", "t1", "t2", "tie")
    return rows.withColumn("key", key).join(ties, ["key", "t1", "t2"], "left").drop("key").withColumn("tie", F.coalesce("tie", F.lit(0).cast("long")))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of every conversation, and (conv_id, depth, m1, m2, words) of the rebuilt turns: m hashes the turn and its depth."""
    placed = ranked(rows, ["conv_id"], ["turn", "tie"], "at", "trie-places")
    ids = placed.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n")
    ids = stored(ids.withColumn("h", shared_turns(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY), "trie-ids")
    heads = placed.filter((F.col("at") < SHARED - 1) & (F.col("conv_id") % FAMILY == 0))
    heads = heads.select(F.col("conv_id").alias("base"), "at", "t1", "t2", "words")
    taken = ids.select("conv_id", "h", "base").join(heads, "base").filter("at < h").select(
        "conv_id", (F.col("at") + 1).alias("depth"), "t1", "t2", "words")
    sizes = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    moves = ids.join(sizes, "base", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))).alias("got"))
    own = placed.join(moves, "conv_id").filter("at >= h").select(
        "conv_id", (F.col("at") - F.col("h") + F.col("got") + 1).alias("depth"), "t1", "t2", "words")
    mark = [F.xxhash64(F.lit(k), "depth", "t1", "t2").alias(f"m{k}") for k in (1, 2)]
    return ids.select("conv_id"), stored(taken.union(own).select("conv_id", "depth", *mark, "words"), "trie-rebuilt")


# paths ----------------------------------------------------------------------------------------------------------------

def paths(ids: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conv_id, k1, k2, depth) of each conversation's last node; the same of the distinct paths, with their number n of
    conversations, the least of them conv_id; and the paths' stretches (conv_id, n, p1, p2, start, m1, m2, words): arrays of the
    turns that follow the node p at depth start."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")
    ends = rows.groupBy("conv_id").agg(F.bit_xor("m1").alias("k1"), F.bit_xor("m2").alias("k2"), F.max("depth").alias("depth"))
    ends = stored(ids.join(ends, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in _KEY)), "trie-ends")
    leads = stored(ends.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")), "trie-leads")
    cut = F.floor((F.col("depth") - 1) / STRETCH).cast("long").alias("cut")
    parts = rows.join(leads.select("conv_id"), "conv_id", "left_semi").groupBy("conv_id", cut).agg(
        F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"),
        F.sort_array(F.collect_list(F.struct("depth", "m1", "m2", "words"))).alias("turns"))
    before = Window.partitionBy("conv_id").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"p1": F.bit_xor("x1").over(before), "p2": F.bit_xor("x2").over(before)})
    each = [F.coalesce(F.col(f"turns.{c}"), none).alias(c) for c in ("m1", "m2", "words")]
    whole = leads.select("conv_id", "n").join(parts, "conv_id", "left").select(
        "conv_id", "n", F.coalesce("p1", zero).alias("p1"), F.coalesce("p2", zero).alias("p2"),
        (F.coalesce("cut", zero) * STRETCH).alias("start"), *each)
    return ends, leads, stored(whole, "trie-stretches")


def sharded(stretches: DataFrame) -> DataFrame:
    """Stretches sorted over all tasks; where the first turns are common, the hash of all parts them."""
    order = ["start", "p1", "p2", *(F.get("m1", F.lit(i)) for i in range(3)), F.xxhash64("m1", "m2")]
    return stretches.repartitionByRange(input_partitions(stretches.sparkSession), *order).sortWithinPartitions(*order)


# double arrays --------------------------------------------------------------------------------------------------------

class DoubleArray:
    """A trie of symbol rows: the child of slot s by symbol t is slot BASE[s] + t, if CHECK there is s."""

    def __init__(self, symbols: np.ndarray, length: np.ndarray):
        """``symbols`` [row, place] from 0, of which each row has ``length``."""
        n = int(symbols.max(initial=-1)) + 1
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -2, np.int64)
        self.limit = 0  # all slots below are taken
        at = np.zeros(len(symbols), np.int64)
        for d in range(symbols.shape[1]):
            live = np.flatnonzero(length > d)
            if not len(live):
                break
            edges = np.unique(at[live] * n + symbols[live, d])  # by parent slot, then symbol
            self._pack(edges // n, edges % n)
            at[live] = self.base[at[live]] + symbols[live, d]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _pack(self, parent: np.ndarray, symbol: np.ndarray) -> None:
        """Give the children of a level's nodes their slots: large families first, only children last."""
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        size = np.diff(np.append(first, len(parent)))
        for k in np.argsort(-size, kind="stable")[:int((size > 1).sum())]:
            own = symbol[first[k]:first[k] + size[k]]
            base = self._free_base(own)
            self.base[parent[first[k]]] = base
            self.check[base + own] = parent[first[k]]
        alone = first[size == 1]
        if len(alone):
            self._grow(self.limit + 1)
            free = np.flatnonzero(self.check[self.limit:] == -1) + self.limit
            if len(free) < len(alone):
                end = len(self.check)
                self._grow(end + len(alone) - len(free))
                free = np.append(free, np.arange(end, end + len(alone) - len(free)))
            free = free[:len(alone)]
            self.base[parent[alone]] = free - symbol[alone]
            self.check[free] = parent[alone]
            self.limit = int(free[-1]) + 1

    def _free_base(self, own: np.ndarray) -> int:
        """The first base, tried from the first free slots on, that has all of a family's slots free."""
        self._grow(self.limit + int(own[-1]) + 1)
        free = np.flatnonzero(self.check[self.limit:] == -1)[:64] + self.limit
        for base in free - own[0]:
            self._grow(base + int(own[-1]) + 1)
            if (self.check[base + own] == -1).all():
                return int(base)
        used = np.flatnonzero(self.check != -1)
        base = int(used[-1]) + 1 - int(own[0])
        self._grow(base + int(own[-1]) + 1)
        return base

    def child(self, slot: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The slots one symbol further, -1 where there is none."""
        to = self.base[slot] + symbol
        inside = (to >= 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == slot), to, -1)


def _matrix(column: pa.Array, length: np.ndarray) -> np.ndarray:
    """A list column as a matrix, rows padded with zeros."""
    out = np.zeros((len(length), int(length.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Shard:
    """The stretches of a batch, packed into a double array and walked through at once."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        m1 = self.column("m1")
        self.length = np.diff(m1.offsets.to_numpy()).astype(np.int64)
        m1, m2, words = (_matrix(self.column(c), self.length) for c in ("m1", "m2", "words"))
        inside = np.arange(m1.shape[1]) < self.length[:, None]
        start = np.stack([self.numbers(c) for c in ("start", "p1", "p2")], 1)
        pair = np.empty(int(inside.sum()), [("a", np.int64), ("b", np.int64)])
        pair["a"], pair["b"] = m1[inside], m2[inside]
        known, dense = np.unique(pair, return_inverse=True)
        _, node = np.unique(start, axis=0, return_inverse=True)
        symbols = np.zeros((len(start), m1.shape[1] + 1), np.int64)  # the starting node, then the turns
        symbols[:, 0] = len(known) + node.reshape(-1)
        symbols[:, 1:][inside] = dense.reshape(-1)
        self.array = DoubleArray(symbols, self.length + 1)
        slots = len(self.array.check)
        self.k1, self.k2, self.depth, self.q1, self.q2, self.words = (np.zeros(slots, np.int64) for _ in range(6))
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []  # (rows, their slots), place by place
        at = np.zeros(len(start), np.int64)
        for d in range(symbols.shape[1]):
            live = np.flatnonzero(self.length >= d)
            to = self.array.child(at[live], symbols[live, d])
            if d:
                came = at[live]
                self.q1[to], self.q2[to], self.words[to] = self.k1[came], self.k2[came], words[live, d - 1]
                self.k1[to], self.k2[to] = self.k1[came] ^ m1[live, d - 1], self.k2[came] ^ m2[live, d - 1]
            else:
                self.k1[to], self.k2[to] = start[:, 1], start[:, 2]
            self.depth[to] = start[live, 0] + d
            at[live] = to
            self.steps.append((live, to))
        # a stretch's first node is the last of the stretch before, but for the root
        self.nodes = np.flatnonzero((self.array.check >= 0) & ((self.array.check > 0) | (self.depth == 0)))

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name))

    def numbers(self, name: str) -> np.ndarray:
        return self.column(name).to_numpy(zero_copy_only=False).astype(np.int64)

    def summed(self, amount: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Per slot the sum of its paths' amounts, of those alone that count at its depth."""
        out = np.zeros(len(self.array.check), np.int64)
        for rows, to in self.steps:
            some = amount[rows] if until is None else np.where(self.depth[to] < until[rows], amount[rows], 0)
            np.add.at(out, to, some)
        return out

    def least(self, value: np.ndarray) -> np.ndarray:
        out = np.full(len(self.array.check), np.iinfo(np.int64).max)
        for rows, to in self.steps:
            np.minimum.at(out, to, value[rows])
        return out

    def rows(self, **columns: np.ndarray) -> pa.RecordBatch:
        """The shard's nodes."""
        return pa.RecordBatch.from_arrays([pa.array(v[self.nodes]) for v in columns.values()], list(columns))


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[Shard]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield Shard(batch.slice(i, rows))


def _count_members(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for s in _shards(batches, rows):
        yield s.rows(k1=s.k1, k2=s.k2, depth=s.depth, q1=s.q1, q2=s.q2, words=s.words,
                     n=s.summed(s.numbers("n")), conv_id=s.least(s.numbers("conv_id")))


def _sum_subtrees(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for s in _shards(batches, rows):
        yield s.rows(k1=s.k1, k2=s.k2, depth=s.depth, leaves=s.summed(s.numbers("leaf")),
                     below=s.summed(s.numbers("total"), s.numbers("first")))


# nodes ----------------------------------------------------------------------------------------------------------------

def merged_nodes(stretches: DataFrame) -> DataFrame:
    """(k1, k2, depth, q1, q2, words, n, conv_id) of each node; q is its parent's key."""
    walked = sharded(stretches).mapInArrow(
        partial(_count_members, rows=SHARD_ROWS), "k1 long, k2 long, depth long, q1 long, q2 long, words long, n long, conv_id long")
    return stored(walked.groupBy(*_KEY).agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("words").alias("words"), F.sum("n").alias("n"),
        F.min("conv_id").alias("conv_id")), "trie-nodes")


def own_sums(nodes: DataFrame) -> DataFrame:
    """(k1, k2, depth, conv_id, own): of the nodes with several members, the tokens saved by those from there on that belong to
    the same conversation; summed in blocks of depths and over the blocks."""
    many = nodes.filter("n > 1").withColumn("saved", (F.col("n") - 1) * F.col("words")) \
        .withColumn("block", F.floor(F.col("depth") / STRETCH).cast("long"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = many.groupBy("conv_id", "block").agg(F.sum("saved").alias("s")).select(
        "conv_id", "block", F.coalesce(F.sum("s").over(beyond), F.lit(0)).alias("later"))
    return many.withColumn("own", F.sum("saved").over(inside)).join(blocks, ["conv_id", "block"]).select(
        *_KEY, "conv_id", (F.col("own") + F.col("later")).alias("own"))


def ends_digests(ends: DataFrame, leads: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the nodes where conversations end."""
    one = leads.filter("n = 1").select(*_KEY, F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    several = ends.join(leads.filter("n > 1").select(*_KEY), _KEY, "left_semi")
    chunk = F.floor(F.col("conv_id") / CHUNK).cast("long").alias("chunk")
    chunks = several.groupBy(*_KEY, chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("ids")).select(
        *_KEY, "chunk", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for *at, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != key:
                    out += [(*key, state.hexdigest())] if key else []
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(out)
        if key:
            yield _digests([(*key, state.hexdigest())])

    ordered = stored(chunks, "trie-chunks").repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    return one.union(ordered.mapInArrow(digest, "k1 long, k2 long, depth long, ends_sha256 string"))


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*_KEY, "ends_sha256"])


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    ids, rows = rebuilt(turns(conversations))
    ends, leads, stretches = paths(ids, rows)
    nodes = merged_nodes(stretches)
    children = nodes.filter("depth > 0").groupBy("q1", "q2", "depth").agg(F.count("*").alias("n_children")).select(
        F.col("q1").alias("k1"), F.col("q2").alias("k2"), (F.col("depth") - 1).alias("depth"), "n_children")
    children = stored(children, "trie-children")
    own = stored(own_sums(nodes), "trie-own")
    totals = own.groupBy("conv_id").agg(F.max("own").alias("total"), F.min("depth").alias("first"))
    zero = F.lit(0).cast("long")
    weights = leads.join(children, _KEY, "left").join(totals, "conv_id", "left").select(
        "conv_id", F.col("n_children").isNull().cast("long").alias("leaf"), F.coalesce("total", zero).alias("total"),
        F.coalesce("first", zero).alias("first")).filter("leaf > 0 or total > 0")
    below = sharded(stored(stretches.join(weights, "conv_id"), "trie-weighted")).mapInArrow(
        partial(_sum_subtrees, rows=SHARD_ROWS), "k1 long, k2 long, depth long, leaves long, below long").groupBy(*_KEY).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("below").alias("below"))
    whole = nodes.join(children, _KEY, "left").join(below, _KEY, "left").join(own.drop("conv_id"), _KEY, "left") \
        .join(ends_digests(ends, leads), _KEY, "left").withColumn("up", F.col("depth") - 1)
    parent = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("depth").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return stored(whole, "trie-whole").join(parent, ["q1", "q2", "up"], "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("n_leaves", zero).alias("n_leaves"), (F.coalesce("below", zero) + F.coalesce("own", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
