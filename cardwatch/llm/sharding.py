"""Sharding by longest-processing-time scheduling (operator 13).

Rows with equal texts form a group that stays together; a group's weight is the sum of its rows' sizes (UTF-8 bytes of
the text plus 1).  Groups are taken from the heaviest down, equal ones by their least doc_id, and each goes to the shard
that has least so far, the lowest-numbered of equals.

1. Rows are reduced to (size, two text hashes) and groups are summed with map-side combine.
2. Only a histogram of the weights, how many groups have each, is scheduled in order.  Over n bytes it has at most
   sqrt(2 n) rows, and one task streams through it with a heap of the shards' loads.  A run of m equal groups is
   scheduled at once: the heap would hand out the m least numbers of the shards' series load, load + w, load + 2w, ...;
   ordered by load // w, then load % w, they are at most one stretch per shard, each a cycle through some shards.
3. A group's number in its run (sorted over all tasks) gives its shard, and a join by text hash its rows'.  Slots number
   the rows of a shard by doc_id, sorted over all tasks.

Defined results: a null text has no bytes and is in one group with the empty texts; repeated rows and rows with a null
doc_id are rows of their own; an empty table has no shards; columns of the input other than doc_id and text are dropped.
Groups are told apart by 128 bits of hashes and the size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import ranked, small_or_not, stored, text_or_empty
from cardwatch.llm.langid import unused

SHARDS = 8
_RUNS = "weight long, stretches array<struct<start: long, cycle: array<int>>>"


def schedule_run(loads: list[int], weight: int, count: int) -> list[tuple[int, list[int]]]:
    """Stretches (number of the first group, shards in turn) of ``count`` equal groups; adds their weight to ``loads``."""
    first = min((load, i) for i, load in enumerate(loads))[1]
    if count == 1:
        loads[first] += weight
        return [(0, [first])]
    shards = sorted(range(len(loads)), key=lambda i: (loads[i] // weight, loads[i] % weight, i))
    out, start, cycle = [], 0, []
    for k, i in enumerate(shards):
        level = loads[i] // weight
        cycle = sorted([*cycle, i], key=lambda j: (loads[j] % weight, j))
        after = loads[shards[k + 1]] // weight if k + 1 < len(shards) else None
        if after == level:
            continue
        out.append((start, cycle))
        start += len(cycle) * (after - level) if after is not None else count
        if start >= count:
            break
    for (at, turn), end in zip(out, [x[0] for x in out[1:]] + [count], strict=True):
        rounds, more = divmod(end - at, len(turn))
        for k, i in enumerate(turn):
            loads[i] += weight * (rounds + (k < more))
    return out


def _scheduler(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = [(0, i) for i in range(shards)]
        for batch in batches:
            got = []
            for weight, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if count == 1:
                    load, i = heap[0]
                    heapq.heapreplace(heap, (load + weight, i))
                    got.append([(0, [i])])
                    continue
                loads = [load for load, _ in sorted(heap, key=lambda x: x[1])]
                got.append(schedule_run(loads, weight, count))
                heap = [(load, i) for i, load in enumerate(loads)]
                heapq.heapify(heap)
            runs = [[{"start": s, "cycle": c} for s, c in stretches] for stretches in got]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("cycle", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, kind)], ["weight", "stretches"])
    return run


def slim(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, h1, h2) of each row."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("shard"), text).alias("h2"))


def group_shards(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(h1, h2, size, shard) of each group of equal texts."""
    groups = rows.groupBy("h1", "h2", "size").agg(F.sum("size").alias("weight"), F.min("doc_id").alias("first"))
    groups = ranked(stored(groups, "shard-groups"), ["weight"], ["first", "h1", "h2"], "number", "shard-runs")
    sizes = stored(groups.groupBy("weight").agg(F.count("*").alias("n")), "shard-weights")
    runs = stored(sizes.coalesce(1).sortWithinPartitions(F.col("weight").desc()).mapInArrow(_scheduler(shards), _RUNS), "shard-plan")
    at = F.element_at(F.filter("stretches", lambda s: s["start"] <= F.col("number")), -1)
    both = groups.join(small_or_not(runs), "weight").select("h1", "h2", "size", "number", at.alias("at"))
    turn = (F.col("number") - F.col("at.start")) % F.size("at.cycle")
    return both.select("h1", "h2", "size", F.get("at.cycle", turn.cast("int")).alias("shard"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``docs``."""
    rows = stored(slim(docs), "shard-rows")
    placed = rows.join(group_shards(rows, shards), ["h1", "h2", "size"])
    return ranked(stored(placed, "shard-placed"), ["shard"], ["doc_id", "h1", "h2"], "slot", "shard-slots").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The rows of ``docs`` as Parquet, a folder ``shard=i`` for each shard: several files each, sorted by text hash."""
    h1, h2, size, to = (unused(docs, x) for x in ("h1", "h2", "size", "shard"))
    text = text_or_empty()
    keyed = docs.withColumns({h1: F.xxhash64(text), h2: F.xxhash64(F.lit("shard"), text), size: (F.octet_length(text) + 1).cast("long")})
    groups = group_shards(stored(slim(docs), "shard-rows"), shards).toDF(h1, h2, size, to)
    placed = keyed.join(groups, [h1, h2, size]).drop(h2, size)
    placed.repartitionByRange(to, h1).sortWithinPartitions(to, h1).drop(h1).write.partitionBy(to).parquet(path)
