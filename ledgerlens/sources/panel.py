"""A3 / A4: store and reload a per-month panel.

One table partitioned by ``lifetime`` replaces one directory per month.
Overwrite is dynamic per partition, so re-running a month replaces exactly
that month instead of appending duplicates.  Reads filter on ``lifetime`` and
Spark prunes the other partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_panel(
    df: DataFrame,
    path: str,
    partition_col: str = "lifetime",
    files_per_partition: int | None = None,
) -> None:
    """Write ``df`` partitioned by ``partition_col``.

    ``files_per_partition`` spreads each month over that many files by a hash
    of ``user1`` (bounded task size at scale); None lets every write task emit
    its own files.
    """
    out = df
    if files_per_partition:
        bucket = F.pmod(F.xxhash64("user1"), F.lit(files_per_partition))
        out = df.repartition(partition_col, bucket)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def read_panel(
    spark: SparkSession,
    path: str,
    lifetime: int | None = None,
    partition_col: str = "lifetime",
    months: DataFrame | None = None,
) -> DataFrame:
    """The stored panel, one month of it, or the months listed in a table.

    ``months`` has a row per wanted month; its values need not be known when the
    query is planned, the scan still opens only their partitions.  It is
    broadcast, so it is first reduced to distinct values, of which there are no
    more than partitions.
    """
    df = spark.read.parquet(path)
    if lifetime is not None:
        df = df.where(F.col(partition_col) == lifetime)
    if months is not None:
        df = df.join(F.broadcast(months.select(partition_col).distinct()), partition_col)
    return df
