"""One row per key, chosen by a total order so that reruns choose the same row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RANK = "__rank"


def content_order(df: DataFrame) -> list[Column]:
    """A total order over rows of any content: a hash first, the columns themselves on a tie.

    Rows that still tie are equal in every column, so either may survive.
    """
    names = sorted(df.columns)
    return [F.xxhash64(*names), *[F.col(n).asc_nulls_first() for n in names]]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key under `order`. Null keys form one group, as in grouping.

    `row_number() = 1` is planned with a rank limit on both sides of the shuffle:
    each map task sends at most one row per key, so a key that holds a third of
    the input still arrives as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(RANK, F.row_number().over(window))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """Drop repeated keys; the survivor is the least row by `order` (default: by content)."""
    return first_per_key(df, keys, order or content_order(df))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[Column | str] | None = None
) -> DataFrame:
    """The newest row of each key; rows of equal time are told apart by `ties`."""
    return first_per_key(df, keys, [F.col(time).desc(), *(ties or content_order(df))])
