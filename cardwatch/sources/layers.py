"""Layer layout and table I/O (S3, S4, S7, S10).  The table format is a
parameter: ``parquet`` works everywhere, ``delta`` when its jar is present."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class LayerPaths:
    """``{base}/{bronze,silver}/transactions``, ``{base}/gold/fraud_signals``,
    ``{base}/checkpoints/{layer}`` plus quarantine, alert and audit tables."""

    base: str

    @property
    def bronze(self) -> str:
        return os.path.join(self.base, "bronze", "transactions")

    @property
    def silver(self) -> str:
        return os.path.join(self.base, "silver", "transactions")

    @property
    def rejects(self) -> str:
        return os.path.join(self.base, "silver", "rejects")

    @property
    def gold(self) -> str:
        return os.path.join(self.base, "gold", "fraud_signals")

    @property
    def alerts(self) -> str:
        return os.path.join(self.base, "gold", "alerts")

    @property
    def audit(self) -> str:
        return os.path.join(self.base, "gold", "batch_audit")

    @property
    def silver_audit(self) -> str:
        return os.path.join(self.base, "silver", "batch_audit")

    def checkpoint(self, layer: str) -> str:
        return os.path.join(self.base, "checkpoints", layer)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Batch scan of a layer table."""
    r = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        r = r.schema(schema)
    return r.load(path)


def read_table_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """S3: stream every append to an upstream layer.  An explicit schema lets
    the stream start before the upstream table exists."""
    r = spark.readStream.format(fmt)
    if schema is not None and fmt != "delta":
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def write_batch(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    batch_id: int | None = None,
    run_id: str = "run",
) -> None:
    """Append a batch so that a retry of the same (``run_id``, ``batch_id``)
    does not duplicate rows.  Batch ids restart at 0 with a new checkpoint, so
    the run id, which lives in the checkpoint, is part of the key.

    parquet: rows carry ``batch_id``, and the table is partitioned by run and
    batch; the write replaces only that partition (dynamic partition overwrite).
    delta: ``txnAppId`` (path and run) / ``txnVersion`` make the append idempotent.
    Without ``batch_id`` it is a plain append.
    """
    w = df.write.format(fmt)
    if batch_id is None:
        w.mode("append").save(path)
    elif fmt == "delta":
        w.mode("append").option("txnAppId", f"{path}#{run_id}").option("txnVersion", batch_id).save(path)
    else:
        keyed = df.withColumn("run_id", F.lit(run_id)).write.format(fmt)
        (keyed.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").save(path))


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a stream's checkpoint belongs to: made with the
    checkpoint, and gone with it."""
    path = os.path.join(checkpoint, "run_id")
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException:  # no such folder yet
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("value")).write.mode("overwrite").text(path)
        return spark.read.text(path).first()[0]


# dimension snapshots -------------------------------------------------------------

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots under ``path`` (those that Spark's writer has marked as done)."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(path, "version=*/_SUCCESS")
    found = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(mark) or []
    return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in found)


def publish_snapshot(df: DataFrame, path: str) -> int:
    """Write ``df`` as the next whole version of a dimension; readers see it when it is complete."""
    version = (_versions(df.sparkSession, path) or [-1])[-1] + 1
    df.write.parquet(f"{path}/version={version}")
    return version


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a dimension."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no snapshot under {path}")
    return spark.read.parquet(f"{path}/version={versions[-1]}")
