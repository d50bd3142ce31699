"""SparkSession construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # session windows merge fragments inside each input partition before the
    # shuffle, so one very busy card never ships all its rows to one task
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are gone are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "cardwatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` is only set when given, so that ``spark-submit`` on a cluster
    keeps control of it.  Table formats (delta, parquet) are job parameters;
    if a delta jar is on the classpath, pass its extension settings in
    ``extra``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the engine's SQL settings to a session built elsewhere (e.g. by
    a driver); static settings that can no longer change are skipped."""
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.sql."):
            continue
        try:
            if spark.conf.get(k, None) != v:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static conf of a running session
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is only
    read.  Only when it is unset (local tests) is a private folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cardwatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cardwatch`` importable in executor Python workers (needed by
    the keyed-state pandas function of the stateful operator).  Same as
    ``--py-files``: the driver zips the package once and Spark distributes
    it; skipped when workers can already import it from an installed copy."""
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="cardwatch-pyfiles-"), "cardwatch.zip")
    with zipfile.ZipFile(out, "w") as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
