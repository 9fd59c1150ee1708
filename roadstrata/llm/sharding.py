"""Jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstrata.llm.common import repeated, stored

SHARDS = 24
#: Distinct rows that one task of the slot numbering holds on average.
ROWS_PER_CELL = 65_536


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to `shards` - 1, of each unsigned 64-bit key.

    Follows each key's sequence of jumps: the shard changes at ever larger shard counts,
    drawn from the key alone, and the last jump below `shards` counts. So one more shard
    takes 1 in `shards` + 1 of the keys, and no key moves between old shards.
    """
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    landed = np.zeros(len(state), np.int64)
    alive = np.arange(len(state))
    while len(alive):
        shard[alive] = landed[alive]
        state[alive] = state[alive] * np.uint64(2862933555777941757) + np.uint64(1)
        ratio = float(1 << 31) / ((state[alive] >> np.uint64(33)).astype(np.float64) + 1.0)
        landed[alive] = ((shard[alive] + 1) * ratio).astype(np.int64)
        alive = alive[landed[alive] < shards]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a long column; map-only. `key` must not be null."""
    if shards < 1:
        raise ValueError("there must be at least one shard")

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return shard_of(key)


def stable_key(*parts: Column) -> Column:
    """A 64-bit key from one or more columns; null counts as a value of its own."""
    return F.xxhash64(*[x for p in parts for x in (p.isNull(), p)])


def with_shard(rows: DataFrame, key: str, shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """`rows` with the shard of their key. No shuffle: the key and the shard count decide alone.

    Rows of equal key share a shard, null keys too. A column called `name` is replaced.
    """
    return rows.withColumn(name, jump_shard(stable_key(F.col(key)), shards))


def write_shards(rows: DataFrame, key: str, path: str, shards: int = SHARDS) -> None:
    """Write `rows` under one folder per shard; the rebalance cuts big shards into several files."""
    placed = with_shard(rows, key, shards)
    placed.hint("rebalance", "shard").write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_slots(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 8 and text_crc32 its checksum; a null text has no bytes (8
    and 0). slot numbers a shard's documents from 0 without gaps, by cell, doc_id (null first), size
    and checksum. grown_shard is the shard with one more shard. Extra columns are not used; an empty
    table gives no rows.

    Equal (doc_id, size, checksum) are counted before the shuffle and numbered as one range, so
    a key with a third of all rows is one row until the end. A cell is a hash class of a shard's
    rows and bounded on average; cells are numbered apart and shifted by the totals of the cells before.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("rows"))
    )
    digests = stored(digests, "digests")
    cells = max(1, -(-digests.count() // (shards * ROWS_PER_CELL)))
    key = stable_key(F.col("doc_id"))
    # The cell comes from all three columns: documents of one doc_id do not meet in one cell.
    cell = F.pmod(F.xxhash64(F.lit(7), "doc_id", "size", "text_crc32"), F.lit(cells))
    placed = digests.withColumns(
        {"shard": jump_shard(key, shards), "grown_shard": jump_shard(key, shards + 1), "cell": cell}
    )
    placed = stored(placed, "placed")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "cell")
        .agg(F.sum("rows").alias("in_cell"))
        .select("shard", "cell", F.coalesce(F.sum("in_cell").over(before), F.lit(0)).alias("start"))
    )
    inside = (
        Window.partitionBy("shard", "cell")
        .orderBy("doc_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("start") + F.coalesce(F.sum("rows").over(inside), F.lit(0))
    numbered = placed.join(starts, ["shard", "cell"]).withColumn("first", first)
    return repeated(numbered, F.col("rows"), "slot", F.col("first")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
