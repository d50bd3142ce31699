"""Reading inputs and scratch tables shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once, as Parquet, into the shared folder of
    ``spark.checkpoint.dir`` and read it back.  It cuts lineage, is read with
    column pruning, and survives the loss of executors."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_partitions(spark: SparkSession, least: int = 8) -> int:
    """Shuffle partitions the session asks for."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(c: str = "text"):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


#: Rows of a key column (32 MB as a hash table) up to which a side is broadcast.
BROADCAST_ROWS = 1 << 21


def small_or_not(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join, to be broadcast only if it has at most ``rows`` rows now; else joined by a shuffle."""
    return F.broadcast(keys) if keys.count() <= rows else keys


def ranked(rows: DataFrame, by: list[str], order: list[str], out: str, name: str = "ranked") -> DataFrame:
    """``rows`` with their number from 0 among the rows equal in ``by`` (none null), in the order of ``order``.

    The rows are sorted over all tasks and written once; a row's number is its place in its part, less the place where
    its group begins there, plus the group's rows in earlier parts.  So a group of any size is spread over many tasks;
    only its counts, one a part, meet.  Equal rows are numbered in any order."""
    d = rows.repartitionByRange(input_partitions(rows.sparkSession), *by, *order).sortWithinPartitions(*by, *order) \
        .withColumn("_at", F.monotonically_increasing_id())
    d = stored(d, name).withColumn("_part", F.shiftright("_at", 33))
    counts = d.groupBy("_part", *by).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), f"{name}-counts")
    both = d.join(small_or_not(counts), ["_part", *by])
    return both.select(*rows.columns, (F.col("_at") - F.col("_from") + F.col("_before")).alias(out))
