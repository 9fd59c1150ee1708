"""Readers of raw, landed and flat telemetry."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstrata.schema import CORRUPT, telemetry_schema
from roadstrata.workspace import partition_folders

SOURCE_FILE = "source_file"

#: Last characters of lines from which something may have to be taken off: marks of arrays, white space, and what a regex takes for a line's end.
_MAY_FOLLOW = tuple(",] \t\n\x0b\f\r\x85\u2028\u2029")


def read_telemetry(
    spark: SparkSession,
    paths: str | Sequence[str],
    multiline: bool = True,
    name_filter: str | None = None,
    corrupt_column: bool = True,
) -> DataFrame:
    """Raw JSON (a file, folders or globs) under the fixed schema, plus its source file.

    Bad leaves become null and, with `corrupt_column`, the text of a malformed
    record is kept. `multiline` documents are not split: each file is one task, and the text of
    a malformed one is taken whole. documents.read_documents() splits them. JSON Lines (`multiline=False`) splits freely.
    """
    reader = spark.read.schema(telemetry_schema(corrupt_column)).option("multiLine", multiline)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.json(paths).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    name_filter: str | None = None,
) -> DataFrame:
    """Raw JSON with one record per line, alone or as the elements of an array, plus its text and source file.

    Lines are read as text, so files split freely and no document is ever held. Brackets on lines of their own
    or around a record and the comma after it are taken off. `payload` is the record's whole text, fields outside the schema
    with it. A line that is no record is one malformed record; the rest of its file is read.
    """
    reader = spark.read
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    lines = reader.text(paths).select(F.trim("value").alias("line"), F.col("_metadata.file_path").alias(SOURCE_FILE))
    # An opening bracket before a record, then a comma or closing bracket after it. Most lines show by their ends that they have neither.
    opened = F.when(F.startswith("line", F.lit("[")), F.regexp_replace("line", r"^\[\s*(?=\{|$)", "")).otherwise(F.col("line"))
    opened = lines.select(opened.alias("line"), SOURCE_FILE)
    closed = F.regexp_replace("line", r"(?:^|(?<=\}))\s*[,\]]+\s*$", "")
    bare = F.when(F.substring("line", -2, 2).isin("},", "}]"), F.expr("left(line, length(line) - 1)"))
    bare = bare.when(F.substring("line", -1, 1).isin(*_MAY_FOLLOW), closed).otherwise(F.col("line"))
    return parsed_records(opened.select(bare.alias("payload"), SOURCE_FILE).filter("payload <> ''"))


def parsed_records(records: DataFrame) -> DataFrame:
    """(payload, source_file) under the fixed schema; a payload that cannot be parsed is also its record's malformed text."""
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    parsed = records.withColumn("record", F.from_json("payload", telemetry_schema(), options))
    return parsed.select("record.*", "payload", SOURCE_FILE)


def read_inferred(
    spark: SparkSession,
    paths: str | Sequence[str],
    multiline: bool = True,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Raw JSON under a schema found by scanning the input: an extra pass, so not the default."""
    reader = spark.read.option("multiLine", multiline).option("samplingRatio", sampling_ratio)
    return reader.json(paths)


def read_landed(spark: SparkSession, path: str, ingest_dates: Iterable[str] | None = None) -> DataFrame:
    """Landed records (columnar, splittable); `ingest_dates` prunes partitions."""
    df = spark.read.parquet(path)
    if ingest_dates is None:
        return df
    return df.filter(F.col("ingest_date").cast("string").isin(list(ingest_dates)))


def read_silver(
    spark: SparkSession,
    path: str,
    dates: Iterable | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The flat table; `dates` prunes partitions and `columns` prunes the scan."""
    df = spark.read.parquet(path)
    if dates is not None:
        df = df.filter(F.col("date").isin(list(dates)))
    return df.select(*columns) if columns else df


def loaded_dates(spark: SparkSession, path: str) -> DataFrame:
    """Days present in the flat table: the names of its folders, no file is opened."""
    days = [(day,) for day in sorted(partition_folders(spark, path, "date"), key=str)]
    return spark.createDataFrame(days, "date STRING").select(F.col("date").cast("date"))
