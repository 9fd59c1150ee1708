"""Connected components of a graph given by its edges, without gathering a component anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadstrata.llm.common import stored
from roadstrata.workspace import session_setting

EDGES = "u long, v long"


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the classes of a[i] and b[i]; `labels` holds each element's smallest member."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def edge_batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges as stars of its own components: at most one edge per node is left."""
    for batch in batches:
        u, v = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        labels = np.arange(len(nodes))
        join_labels(labels, at[: len(u)], at[len(u) :])
        rest = labels != np.arange(len(nodes))
        yield edge_batch(nodes[rest], nodes[labels[rest]])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): every node that is not the smallest of its component, with the smallest one.

    `edges` has two long columns (u, v). Each task first replaces its edges by stars; then rounds of
    linking each node's larger neighbours, then its smaller ones, to its smallest neighbour follow until
    nothing changes: about log(nodes) rounds, each written to the shared folder. A node with a third
    of all edges is one row per task in the minima and is split by the skew join of AQE.
    """
    with session_setting(edges.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "200000"):
        now = stored(edges.toDF("u", "v").filter("u <> v").mapInArrow(_forest, EDGES).distinct(), "forest")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first()
        if mark == before:
            return now.withColumnRenamed("v", "root")
        before = mark
        now = stored(_small_star(_large_star(now)), "stars")
