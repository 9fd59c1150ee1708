"""Physical layout of a frame before a partitioned write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def by_partition(
    df: DataFrame,
    column: str,
    layout: str = "rebalance",
    cluster_by: Sequence[str] = (),
    buckets: int = 1,
    bucket_by: Sequence[str] = (),
) -> DataFrame:
    """Bring rows of one partition value together, so each value gets few, well-sized files.

    `rebalance`: AQE merges small values and splits big ones by measured size, so
    a value that holds a third of the rows does not become one task.
    `hash`: one task per value, or `buckets` tasks per value when that is over 1;
    the bucket comes from `bucket_by`, so a retried task sees the same rows.
    `cluster_by` sorts rows inside each file, which narrows min/max statistics.
    """
    if layout == "rebalance":
        df = df.hint("rebalance", column)
    elif layout == "hash" and buckets > 1:
        bucket = F.pmod(F.xxhash64(*(bucket_by or df.columns)), F.lit(buckets))
        df = df.repartition(F.col(column), bucket)
    elif layout == "hash":
        df = df.repartition(column)
    elif layout != "as_is":
        raise ValueError(f"unknown layout {layout!r}")
    return df.sortWithinPartitions(column, *cluster_by) if cluster_by else df
