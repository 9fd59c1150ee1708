"""Silver sinks: the date-partitioned flat table and the quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadstrata.operators.layout import by_partition
from roadstrata.operators.survivors import dedupe
from roadstrata.schema import SILVER_KEYS
from roadstrata.sinks.metrics import counted
from roadstrata.workspace import (
    SHUFFLE_WIDTH,
    SMALLEST,
    discard,
    few_partitions,
    materialize_at,
    partition_folders,
    scratch_path,
    session_setting,
    shuffle_width,
    shuffles_dropped,
)

#: A compressed file is read by one task, so each holds at most so many rejected rows.
ROWS_PER_FILE = 200_000
SMALLEST_TASK = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def write_silver(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition: str = "date",
    layout: str = "rebalance",
    cluster_by: Sequence[str] = (),
    **layout_options,
) -> int:
    """Write partitioned by day; the number of rows written. With `mode="overwrite"` only the days in `df` are replaced.

    Every day costs a file, however few rows it holds, and AQE packs tasks by bytes
    alone; the lower floor keeps a write of many thin days from becoming one task.
    """
    laid_out, written = counted(by_partition(df, partition, layout, cluster_by, **layout_options))
    with session_setting(df.sparkSession, SMALLEST_TASK, "64kb"), shuffles_dropped(df.sparkSession):
        (
            laid_out.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(path)
        )
    return written.get["rows"]


def stored_partitions(batch: DataFrame, path: str, partition: str = "date") -> tuple[DataFrame | None, list[str]]:
    """Rows stored at `path` for the days in `batch`, a null day among them, and their folders.

    One plan for every size: the batch's days, of which each has a folder to be written anyway, are
    matched with the folders there, and only those are read. None if there is none.
    """
    spark = batch.sparkSession
    there = partition_folders(spark, path, partition)
    if not there:
        return None, []
    days = batch.select(F.col(partition).cast("string").alias("day")).distinct()
    folders = sorted(there[row.day] for row in days.toLocalIterator() if row.day in there)
    if not folders:
        return None, []
    stored = spark.read.option("basePath", path).parquet(*folders)
    kind = batch.schema[partition].dataType
    return stored.withColumn(partition, F.col(partition).cast(kind)), folders


def merge_partitions(
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = SILVER_KEYS,
    order: Sequence[Column | str] | None = None,
    partition: str = "date",
    batch_bytes: int = 0,
    **layout_options,
) -> int:
    """Add `batch` to the table so that running it again changes nothing; the rows written.

    Days not stored yet are deduplicated and written straight in. For the others,
    stored plus new rows are deduplicated, written to the shared folder, and only
    then swapped in: a path is never overwritten while it is read, and rows of a
    day that the batch holds only in part stay, those of a null day too. `partition` must be
    determined by `keys`. The batch is scanned twice, once for its days: pass a stored table.
    The shuffle is sized by the stored folders it meets and `batch_bytes`.
    """
    spark = batch.sparkSession
    stored, folders = stored_partitions(batch, path, partition)
    width = shuffle_width(spark, *folders, more_bytes=batch_bytes)
    with session_setting(spark, SHUFFLE_WIDTH, str(width)):
        if stored is None:
            return write_silver(dedupe(batch, keys, order), path, "append", partition, **layout_options)
        rows = stored.unionByName(batch, allowMissingColumns=True)
        staging = scratch_path(spark, "merged")
        try:
            rebuilt = materialize_at(dedupe(rows, keys, order), staging)
            return write_silver(rebuilt, path, "overwrite", partition, **layout_options)
        finally:
            discard(spark, staging)


def write_quarantine(
    invalid: DataFrame,
    path: str,
    batch_columns: Sequence[str] = (),
    skip_empty: bool = False,
) -> bool:
    """Write rejected rows as compressed JSON with the rules they broke; True if a write took place.

    Without `batch_columns` rows are appended. With them each landed batch has a folder of its own,
    which a rerun replaces, whatever other batches run with it. `skip_empty` first looks for
    one row, where a count would scan them all; without it no extra job runs.
    """
    if skip_empty and invalid.isEmpty():
        return False
    how = {**SMALLEST, "maxRecordsPerFile": ROWS_PER_FILE}
    if not batch_columns:
        with shuffles_dropped(invalid.sparkSession):
            invalid.write.mode("append").options(**how).json(path)
    else:
        writer = invalid.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **how)
        with few_partitions(invalid.sparkSession):
            writer.partitionBy(*batch_columns).json(path)
    return True
