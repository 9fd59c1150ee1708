"""A partitioned table whose versions are lists of files: many days change at once, and a merge opens only files that hold its keys.

Under the table's path lie

* `data/load=…/<partition>=…/`: the files, each written once and never changed;
* `keys/load=…/<partition>=…/`: the hash of every row's key, and its file;
* `versions/0, 1, …`: the files that make up a version, put in place by one rename.

A reader takes the files of one version and keeps seeing them whatever is written meanwhile. Keys are stored as hashes, eight bytes a row, and not
as Bloom filters: a late batch has many keys a day, and one false answer among them would open a file for nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadstrata.operators.layout import by_partition
from roadstrata.operators.lookup import join_hash
from roadstrata.operators.survivors import dedupe
from roadstrata.schema import SILVER_KEYS
from roadstrata.workspace import SHUFFLE_WIDTH, path_exists, remove, session_setting, shuffle_width

KEY, FILE, LOAD = "__key", "__file", "load"
FILES = "file STRING, load STRING, part STRING, rows BIGINT, bytes BIGINT"


class Conflict(RuntimeError):
    """Another writer has put the next version in place; nothing of this write is to be seen."""


@dataclass(frozen=True)
class Merged:
    """What a write did: the version it made, and how many files it read, left as they were, and wrote."""

    version: int
    opened: int
    kept: int
    written: int


@dataclass(frozen=True)
class VersionedTable:
    """The table at `path`, partitioned by `partition`, one row per `keys`, which determine the partition.

    A version is put in place by a rename that fails where the target is there: atomic on HDFS and the like; on an object store it is
    as atomic as that store's rename. Files are named to the driver, as for any scan; rows and keys are not.
    """

    spark: SparkSession
    path: str
    partition: str = "date"
    keys: Sequence[str] = tuple(SILVER_KEYS)

    # --- reading ---

    def versions(self) -> list[int]:
        """The versions there are, oldest first."""
        folder = f"{self.path}/versions"
        if not path_exists(self.spark, folder):
            return []
        target = self._hadoop.Path(folder)
        found = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(target)
        names = [status.getPath().getName() for status in found]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, by default the last one. No version yet: an error, as for a path that is not there."""
        version = self._last() if version is None else version
        return self._rows(self._schema(version), [row.file for row in self.files(version).select("file").collect()])

    def files(self, version: int) -> DataFrame:
        """(file, load, part, rows, bytes) of a version; a null partition has a null `part`."""
        return self.spark.read.schema(FILES).parquet(f"{self.path}/versions/{version}/files")

    # --- writing ---

    def merge(self, batch: DataFrame, order: Sequence[Column | str] | None = None, **layout) -> Merged:
        """Add `batch` so that adding it again changes nothing: of the rows of a key the least by `order` stays (default: by content).

        The batch's keys are looked up among the stored ones of its partitions, and only the files that hold one of them are read and
        written anew, with the batch, as files of a new load; the rest of a day is neither opened nor written. All partitions change at once. The batch is scanned twice: pass
        a stored table. Null keys and a null partition are values. Columns that one side lacks are null there. An empty batch makes a version of the same files.
        """
        base = self._last()
        if base < 0:
            return self._put(base, dedupe(batch, self.keys, order), [], 0, layout)
        schema = self._schema(base)
        for name in {*self.keys, self.partition}:
            # Another type would hash to another key.
            if schema[name].dataType != batch.schema[name].dataType:
                raise ValueError(f"{name} is {schema[name].dataType} in the table and {batch.schema[name].dataType} in the batch")
        kept = self.files(base)
        touched = self._files_with(kept, batch)
        rows = self._rows(schema, [row.file for row in touched]).unionByName(batch, allowMissingColumns=True)
        width = shuffle_width(self.spark, more_bytes=2 * sum(row.bytes for row in touched))
        with session_setting(self.spark, SHUFFLE_WIDTH, str(width)):
            return self._put(base, dedupe(rows, self.keys, order), touched, kept.count(), layout)

    def replace_partitions(self, rows: DataFrame, **layout) -> Merged:
        """Put `rows` in the place of all that their partitions hold, in all of them at once. Their keys must be unique.

        The rows are scanned twice, once for their partitions: pass a stored table.
        """
        base = self._last()
        if base < 0:
            return self._put(base, rows, [], 0, layout)
        parts = rows.select(F.col(self.partition).cast("string").alias("given")).distinct()
        files = self.files(base)
        gone = files.join(parts, files["part"].eqNullSafe(parts["given"]), "left_semi").collect()
        return self._put(base, rows, gone, files.count(), layout)

    def compact(self, parts: Collection[str | None], **layout) -> Merged:
        """Write the files of some partitions anew, as few as their size asks for: late batches leave small ones."""
        base = self._last()
        files = self.files(base)
        wanted = F.col("part").isin([p for p in parts if p is not None]) | (F.col("part").isNull() & F.lit(None in parts))
        old = files.filter(wanted).collect()
        return self._put(base, self._rows(self._schema(base), [row.file for row in old]), old, files.count(), layout)

    def vacuum(self, versions: int = 1) -> int:
        """Delete all but the last `versions` versions, and the loads that none of those left uses; the loads deleted. Not while others write."""
        there = self.versions()
        for version in there[:-versions]:
            remove(self.spark, f"{self.path}/versions/{version}")
        used = {row.load for v in there[-versions:] for row in self.files(v).select("load").distinct().collect()}
        target = self._hadoop.Path(f"{self.path}/data")
        loads = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(target)
        unused = {status.getPath().getName().removeprefix("load=") for status in loads} - used
        for load in unused:
            self._discard(load)
        return len(unused)

    # --- how ---

    @property
    def _hadoop(self):
        return self.spark._jvm.org.apache.hadoop.fs

    def _key(self) -> Column:
        return join_hash([F.col(f"`{key}`") for key in self.keys]).alias(KEY)

    def _last(self) -> int:
        return max(self.versions(), default=-1)

    def _schema(self, version: int) -> T.StructType:
        text = self.spark.read.text(f"{self.path}/versions/{version}/schema").first()[0]
        return T.StructType.fromJson(json.loads(text))

    def _rows(self, schema: T.StructType, files: Collection[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        # Paths of scans are spelled as URIs, readers take them plain.
        reader = self.spark.read.option("basePath", f"{self.path}/data")
        return reader.schema(self._with_load(schema)).parquet(*map(unquote, files)).select(*schema.names)

    def _with_load(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])

    def _files_with(self, files: DataFrame, batch: DataFrame) -> list:
        """The files that hold a key of the batch."""
        wanted = batch.select(F.col(self.partition).cast("string").alias("part"), self._key()).distinct()
        parts = wanted.select("part").distinct()
        near = files.join(parts, files["part"].eqNullSafe(parts["part"]), "left_semi").select("load", "part").distinct()
        folders = [self._key_folder(row.load, row.part) for row in near.collect()]
        if not folders:
            return []
        stored = self.spark.read.schema(f"{KEY} BIGINT, {FILE} STRING").parquet(*folders)
        holding = stored.join(wanted.select(KEY).distinct(), KEY, "left_semi").select(FILE).distinct()
        return files.join(holding, files["file"] == holding[FILE], "left_semi").collect()

    def _key_folder(self, load: str, part: str | None) -> str:
        # The text of the partition in hex: a folder name that needs no escaping.
        return f"{self.path}/keys/load={load}/part={'null' if part is None else part.encode().hex()}"

    def _put(self, base: int, rows: DataFrame, gone: list, before: int, layout: dict) -> Merged:
        """A new version: the files of `base` but for those `gone`, and `rows` as a new load."""
        load = uuid.uuid4().hex
        try:
            written = self._write(load, rows, layout)
            if base >= 0:
                left = [row.file for row in gone]
                names = self.spark.createDataFrame([(f,) for f in left], "gone STRING")
                old = self.files(base)
                written = old.join(names, old["file"] == names["gone"], "left_anti").unionByName(written)
            attempt = f"{self.path}/versions/attempt-{load}"
            written.write.parquet(f"{attempt}/files")
            schema = self.spark.createDataFrame([(rows.schema.json(),)], "value STRING")
            schema.coalesce(1).write.text(f"{attempt}/schema")
            made = self.spark.read.schema(FILES).parquet(f"{attempt}/files").filter(F.col("load") == load).count()
            self._swap_in(attempt, base + 1)
        except BaseException:
            self._discard(load)
            remove(self.spark, f"{self.path}/versions/attempt-{load}")
            raise
        return Merged(base + 1, len(gone), before - len(gone), made)

    def _write(self, load: str, rows: DataFrame, layout: dict) -> DataFrame:
        """Write a load and the keys of its rows; its files."""
        data = f"{self.path}/data/load={load}"
        by_partition(rows, self.partition, **layout).write.partitionBy(self.partition).parquet(data)
        kinds = T.StructType([f for f in rows.schema if f.name in {*self.keys, self.partition}])
        part = F.col(self.partition).cast("string")
        found = self.spark.read.schema(kinds).parquet(data).select(
            self._key(),
            F.col("_metadata.file_path").alias(FILE),
            part.alias("text"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        folder = F.when(F.col("text").isNull(), "null").otherwise(F.lower(F.hex(F.encode("text", "utf-8")))).alias("part")
        found.select(KEY, FILE, folder).write.partitionBy("part").parquet(f"{self.path}/keys/load={load}")
        counted = found.groupBy(F.col(FILE).alias("file"), F.col("text").alias("part")).agg(
            F.count("*").alias("rows"), F.max("bytes").alias("bytes")
        )
        return counted.select("file", F.lit(load).alias("load"), "part", "rows", "bytes")

    def _swap_in(self, attempt: str, version: int) -> None:
        conf = self.spark._jsc.hadoopConfiguration()
        source, target = self._hadoop.Path(attempt), self._hadoop.Path(f"{self.path}/versions/{version}")
        source, target = (p.getFileSystem(conf).makeQualified(p) for p in (source, target))
        rename = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        rename[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self._hadoop.FileContext.getFileContext(source.toUri(), conf).rename(source, target, rename)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(f"version {version} of {self.path} was made by another writer") from error
            raise

    def _discard(self, load: str) -> None:
        for kind in ("data", "keys"):
            remove(self.spark, f"{self.path}/{kind}/load={load}")
