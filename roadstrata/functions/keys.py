"""Surrogate keys that do not depend on how a plan was executed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadstrata.workspace import materialize, partition_folders, path_exists

KEY_HEX_DIGITS = 15  # 60 bits: always a non-negative BIGINT


def as_column(value: Column | str) -> Column:
    """A column from a column or from SQL text."""
    return value if isinstance(value, Column) else F.expr(value)


def same_zero(value: Column | str) -> Column:
    """FLOAT with -0.0 folded into 0.0, as grouping and joining already do."""
    return as_column(value).cast("float") + F.lit(0).cast("float")


def hash_key(parts: Sequence[Column | str]) -> Column:
    """BIGINT key computed from the business key alone: no shuffle, no state, same on every run.

    The text hashed is the length of every part, -1 for null, and then the parts, so
    different part lists never give the same text.
    """
    texts = [as_column(part).cast("string") for part in parts]
    lengths = [F.coalesce(F.length(text), F.lit(-1)).cast("string") for text in texts]
    digest = F.md5(F.concat_ws("|", *lengths, *texts))
    return F.conv(F.substring(digest, 1, KEY_HEX_DIGITS), 16, 10).cast("bigint")


def derived_key(parts: Sequence[Column | str], null_safe: bool = False) -> Column:
    """The key a lookup of `parts` in a hash-keyed dimension would find, without the join.

    Holds when the dimension was built from rows that include this one. Unless
    `null_safe`, a null part matches no member, so the key is null.
    """
    key = hash_key(parts)
    if null_safe:
        return key
    complete = reduce(lambda a, b: a & b, [as_column(p).isNotNull() for p in parts])
    return F.when(complete, key)


def dense_key(members: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Add keys 0..n-1 in the order of `order`, for dimensions too big for 60-bit hashes.

    One range shuffle sorts the members; each task numbers its own slice, and the
    slice sizes, one row per task, become offsets. The key is the rank in a total
    order, so it does not depend on how many slices there were. `order` must be
    unique over `members`.
    """
    ranked = members.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    # Stored before use: a second evaluation could cut the slices elsewhere.
    sliced = materialize(ranked.withColumn("__row", F.monotonically_increasing_id()), key)
    # The id holds the task number above bit 33 and the position in the task below it.
    sliced = sliced.withColumns(
        {
            "__slice": F.shiftright("__row", 33),
            "__position": F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    # One row per task of the range shuffle, however many members there are, so the
    # running total in a single window and the join below stay small.
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("__slice")
        .agg(F.count("*").alias("__size"))
        .select(
            "__slice",
            F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"),
        )
    )
    return (
        sliced.join(offsets, "__slice")
        .withColumn(key, F.col("__offset") + F.col("__position"))
        .drop("__row", "__slice", "__position", "__offset")
    )


def null_safe_on(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of all `columns`; null equals null."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def stable_dense_key(members: DataFrame, order: Sequence[str], key: str, path: str) -> DataFrame:
    """Add dense keys that stay: a member met before keeps its number, new ones get the next numbers in the order of `order`.

    The table at `path` holds a number for every member ever met, a folder per call that met new ones; no number is given twice and none is left
    out. `order` must be unique over `members`; nulls are values. A call that was cut off before its folder was complete is done again
    under the same numbers. One writer at a time.
    """
    spark = members.sparkSession
    members = materialize(members, f"{key}-members")
    folders = [
        folder
        for _, folder in sorted(partition_folders(spark, path, "batch").items(), key=lambda item: int(item[0]))
        if path_exists(spark, f"{folder}/_SUCCESS")
    ]

    def numbers(some: list[str]) -> DataFrame:
        kinds = [f for f in members.schema if f.name in order]
        schema = T.StructType([*kinds, T.StructField(key, T.LongType())])
        return spark.read.schema(schema).parquet(*some) if some else spark.createDataFrame([], schema)

    known = numbers(folders)
    new = members.select(*order).join(known, null_safe_on(members, known, order), "left_anti")
    first = known.agg(F.coalesce(F.max(key) + 1, F.lit(0))).first()[0]
    if not new.isEmpty():
        numbered = dense_key(new, order, key).withColumn(key, F.col(key) + first)
        folders.append(f"{path.rstrip('/')}/batch={len(folders)}")
        numbered.select(*order, key).write.mode("overwrite").parquet(folders[-1])
    known = numbers(folders)
    return members.join(known, null_safe_on(members, known, order)).select(*[members[c] for c in members.columns], known[key])


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one member: must be empty for a sound dimension."""
    return dim.groupBy(key).agg(F.count("*").alias("members")).filter("members > 1")
