"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadstrata.llm.common import SPACES, stored, unused_name
from roadstrata.workspace import discard, scratch_path, session_setting, shuffle_width

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
#: Documents are taken in by this many batches.
BATCHES = 4
#: So many runs of one level are merged into one run of the next.
FANOUT = 2
#: Stands for a null doc_id, which counts as one document below all others.
NO_ID = -(1 << 63)

STRIPPED = SPACES.encode()


def line_hash(line: bytes) -> tuple[int, int] | None:
    """128 bits of the line's key, as two signed longs; None for a key that is too short to count."""
    key = line.strip(STRIPPED)
    if len(key) < MIN_LENGTH or len(key) < 4 * MIN_LENGTH and len(key.decode()) < MIN_LENGTH:
        return None
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def hashed_lines(text: str | None) -> tuple[list[bytes], list[tuple[int, int] | None]]:
    """The text's lines as they are, and the hashes of their keys. bytes.lower() changes A-Z only."""
    raw = (text or "").encode()
    return raw.split(b"\n"), [line_hash(x) for x in raw.lower().split(b"\n")]


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc, part, h1, h2): the keys that count of each document row, once each. part tells rows of one doc_id by their texts."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[], [], [], []]
            for doc, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for a, b in {h for h in hashed_lines(text)[1] if h}:
                    for column, value in zip(found, (doc, part, a, b), strict=True):
                        column.append(value)
            columns = [pa.array(x, pa.int64()) for x in found]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "part", "h1", "h2"])

    return docs.select(*_document(docs), "text").mapInArrow(keys, "doc long, part long, h1 long, h2 long")


def _document(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(docs["text"]).alias("part")]


class LineRuns:
    """Runs of (h1, h2, known, docs, top): in how many documents a key was found, and the largest of them.

    A run is a table in buckets of the hash, sorted in each, so runs meet in merge joins and are merged without being dealt or sorted
    again. A batch is merge-joined with all runs: a key that none of them holds makes the batch's own run; one that a run
    holds (`known`) only raises its counts. When a level has `fanout` runs, they are merged into one of the next, so
    a key is rewritten once per level and a batch meets few runs. Batches must not share a document.
    """

    KEY = ["h1", "h2"]

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.levels: list[list[tuple[str, str]]] = []

    def add(self, keys: DataFrame) -> None:
        """Take in one batch of (doc, h1, h2)."""
        with self._layout():
            self._put(0, self.told_apart(keys))

    def told_apart(self, keys: DataFrame) -> DataFrame:
        """A batch's keys with their counts and whether a run holds them."""
        # Documents are counted in the tasks first: a key that very many hold is a row per task when it is dealt to its bucket.
        once = keys.select("doc", *self.KEY).distinct().groupBy(*self.KEY)
        now, known = once.agg(F.count("*").alias("docs"), F.max("doc").alias("top")), F.lit(False)
        for i, run in enumerate(self.runs()):
            held = self._read(run).filter("not known").select(*self.KEY, F.lit(True).alias(f"in_{i}"))
            now = now.join(held.hint("merge"), self.KEY, "left")
            known |= F.col(f"in_{i}").isNotNull()
        return now.select(*self.KEY, "docs", "top", known.alias("known"))

    def runs(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def merged(self, one: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        """Two runs as one, by a merge join of both; a key that either held first is not `known`."""
        a, b = self._read(one), self._read(other)

        def of(name: str) -> tuple[Column, Column]:
            return a[name], b[name]

        return a.join(b.hint("merge"), self.KEY, "full").select(
            *self.KEY,
            sum((F.coalesce(c, F.lit(0)) for c in of("docs")), F.lit(0)).cast("long").alias("docs"),
            F.greatest(*of("top")).alias("top"),
            (F.coalesce(a["known"], F.lit(True)) & F.coalesce(b["known"], F.lit(True))).alias("known"),
        )

    def compact(self) -> None:
        """Merge all runs into one."""
        runs = self.runs()
        if len(runs) > 1:
            with self._layout():
                top = len(self.levels)
                self.levels = [[] for _ in range(top)] + [[self._folded(runs)]]

    def losing(self, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
        """(h1, h2, top) of keys found in enough documents. The runs are compacted for it."""
        self.compact()
        if not self.runs():
            return self.spark.createDataFrame([], "h1 long, h2 long, top long")
        (run,) = self.runs()
        return self._read(run).filter(F.col("docs") >= min_documents).select(*self.KEY, "top")

    def discard(self) -> None:
        """Drop all runs."""
        self._discard(self.runs())
        self.levels = []

    @contextmanager
    def _layout(self):
        """One task per bucket, whose file's order counts."""
        with ExitStack() as settings:
            for name, value in {
                "spark.sql.shuffle.partitions": str(self.buckets),
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
                "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
            }.items():
                settings.enter_context(session_setting(self.spark, name, value))
            yield

    def _put(self, level: int, run: DataFrame) -> None:
        self._place(level, self._write(run))

    def _place(self, level: int, run: tuple[str, str]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._place(level + 1, self._folded(full))

    def _folded(self, runs: list[tuple[str, str]]) -> tuple[str, str]:
        """One run of several, by twos."""
        runs = list(runs)
        while len(runs) > 1:
            one, other = runs.pop(0), runs.pop(0)
            runs.append(self._write(self.merged(one, other)))
            self._discard([one, other])
        return runs[0]

    def _write(self, run: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "run")
        run.write.bucketBy(self.buckets, *self.KEY).sortBy(*self.KEY).option("path", path).saveAsTable(name)
        return name, path

    def _read(self, run: tuple[str, str]) -> DataFrame:
        return self.spark.table(run[0])

    def _discard(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            discard(self.spark, path)


def lost_keys(docs: DataFrame, batches: int = BATCHES, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc, part, lost): the hashes, h1 and h2 in turn, of the keys whose lines a document loses.

    The law counts over all documents, so all batches have met the runs before the first one's lines are
    looked up. That join deals lines by hash, not by bucket: a line that a third of all documents share is split by the skew
    join of AQE. What a document loses is gathered per text, so rows of one doc_id, or of none, do not meet.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    batch = F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int")
    # Each batch gets a file from each task: a scan of one batch opens its own folder only.
    line_keys(docs).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc long, part long, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, shuffle_width(spark, path))
    for b in range(batches):
        runs.add(lines.filter(F.col("batch") == b).drop("batch"))
    losing = stored(runs.losing(min_documents), "losing")
    runs.discard()
    pair = F.array("h1", "h2")
    return (
        lines.join(losing.hint("merge"), ["h1", "h2"])
        .filter(F.col("doc") != F.col("top"))
        .groupBy("doc", "part")
        .agg(F.flatten(F.collect_set(pair)).alias("lost"))
    )


def _with_lost(docs: DataFrame, batches: int, min_documents: int) -> tuple[DataFrame, str]:
    name, doc, part = (unused_name(docs, n) for n in ("lost_lines", "lost_doc", "lost_part"))
    lost = lost_keys(docs, batches, min_documents).select(F.col("doc").alias(doc), F.col("part").alias(part), F.col("lost").alias(name))
    own_doc, own_part = _document(docs)
    return docs.join(lost, (own_doc == F.col(doc)) & (own_part == F.col(part)), "left").drop(doc, part), name


def kept_lines(text: str | None, lost: list[int] | None) -> tuple[int, int, bytes]:
    """Number of lines, number dropped, and the rest joined again."""
    if not lost:
        raw = (text or "").encode()
        return raw.count(b"\n") + 1, 0, raw
    gone = set(zip(lost[::2], lost[1::2], strict=True))
    lines, hashes = hashed_lines(text)
    kept = [line for line, h in zip(lines, hashes, strict=True) if h not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def line_report(docs: DataFrame, batches: int = BATCHES, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256.

    A line's key is the line stripped of SPACES with A-Z in lower case. A key of at least 20 code points
    that at least `min_documents` different doc_ids hold loses all its lines but those of the largest one. A null
    or empty text is one empty line. Rows of equal doc_id are one document for the count and keep or lose alike;
    null ids are one document, below all others. Extra columns are not used.
    """

    def report(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, losts = part.column("text").to_pylist(), part.column("lost").to_pylist()
            found = [kept_lines(t, x) for t, x in zip(texts, losts, strict=True)]
            columns = [
                part.column("doc_id"),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.int64()),
                pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined, name = _with_lost(chosen, batches, min_documents)
    return joined.select("doc_id", "text", F.col(name).alias("lost")).mapInArrow(
        report, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


def drop_repeated_lines(docs: DataFrame, batches: int = BATCHES, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """`docs` with the lines of line_report() dropped from text, all columns kept; n_chars, if there, follows.

    A null text stays null; a document that loses all its lines keeps an empty text.
    """
    joined, name = _with_lost(docs, batches, min_documents)

    @F.pandas_udf(T.StringType())
    def rest(texts, lost):
        import pandas as pd

        pairs = zip(texts, lost, strict=True)
        return pd.Series([kept_lines(t, None if x is None else list(x))[2].decode() for t, x in pairs], dtype=object)

    text = F.when(F.col(name).isNull() | F.col("text").isNull(), F.col("text")).otherwise(rest("text", name))
    out = joined.withColumn("text", text).drop(name)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
