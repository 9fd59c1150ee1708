"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadstrata.workspace import materialize

#: Spaces of the contracts: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the cluster's shared folder and read back from there."""
    return materialize(df, label)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that follows from `parts` alone, so reruns and lost tasks draw it again."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


#: Numbers in an array at most when rows are repeated.
RANGE = 65_536


def repeated(df: DataFrame, rows: Column, name: str, first: Column | None = None) -> DataFrame:
    """`df` with each row as often as `rows` (1 or more) says, numbered in `name` from `first` (1).

    Ranges of numbers come first and their numbers then, so that a row that stands for very many never becomes one long array.
    """
    first = F.lit(1).cast("long") if first is None else first
    part = unused_name(df, "range")
    ranges = df.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((rows - 1) / RANGE).cast("long"))))
    start = first + F.col(part) * RANGE
    return ranges.withColumn(name, F.explode(F.sequence(start, F.least(first + rows - 1, start + RANGE - 1)))).drop(part)


def content_key(df: DataFrame, seed: int) -> Column:
    """A 64-bit key of all columns of a row; null is a value of its own in each."""
    return F.xxhash64(F.lit(seed), *[x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def shared_bytes(spark: SparkSession, path: str):
    """The bytes of a vocabulary file (below 2 MB each), read by the driver and sent to the executors."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def unused_name(df: DataFrame, wanted: str) -> str:
    """A column name like `wanted` that `df` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_blocks(texts: list[str | None], size: int) -> Iterator[list[str | None]]:
    """Runs of whole texts of about `size` characters together; a longer text is a run of its own."""
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text or "")
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held
