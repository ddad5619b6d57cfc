"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: adaptive execution (runtime broadcast
# conversion by measured size, partition coalescing, skew-join splitting),
# UTC session time, and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Shuffle files go when the query that made them has ended, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    app_name: str = "ledgerlens",
    extra: dict | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own conf."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temp folder would be lost with
    the executor.  Only a local master (tests, bench) gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in some versions
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster"
        )
    folder = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder inside the checkpoint folder; ``clear_scratch`` removes it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/ledgerlens-{spark.sparkContext.applicationId}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove their shuffle files as soon as they have ended: nothing reads those again."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint, but in a single job: an
    eager ``checkpoint()`` computes the plan once to count it and again to
    write it.  The folder is shared storage on a cluster, so a lost executor
    re-reads the files instead of recomputing.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    with shuffles_removed(spark):
        df.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.__dict__["_ledgerlens_path"] = path
    return stored


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(stored: DataFrame) -> None:
    """Remove the files (and the name, if any) of a stored table that nothing reads any more."""
    path, table = (stored.__dict__.pop(k, None) for k in ("_ledgerlens_path", "_ledgerlens_table"))
    if table:
        stored.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    if path:
        _delete(stored.sparkSession, path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has stored; results that read it must have been written before."""
    _delete(spark, scratch_dir(spark))
