"""Run metrics: what each stage wrote and how long it took."""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

METRICS_DDL = "run_id STRING, stage STRING, rows BIGINT, seconds DOUBLE"


@dataclass
class RunMetrics:
    """Timings taken around actions only; a lazy step has no time of its own."""

    run_id: str
    entries: list[tuple[str, str, int | None, float]] = field(default_factory=list)

    @contextmanager
    def stage(self, name: str):
        """Time a block; set `.rows` on the yielded object to record a row count. A block that raises leaves no count."""
        entry = _Entry()
        start = time.monotonic()
        try:
            yield entry
        except BaseException:
            entry.rows = None
            raise
        finally:
            self.record(name, entry.rows, time.monotonic() - start)

    def record(self, name: str, rows: int | None, seconds: float = 0.0) -> None:
        self.entries.append((self.run_id, name, rows, float(seconds)))

    def rows(self) -> dict[str, int | None]:
        return {stage: rows for _, stage, rows, _ in self.entries}

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, METRICS_DDL)

    def write(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).coalesce(1).write.mode("append").parquet(path)


@dataclass
class _Entry:
    rows: int | None = None


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df`, and its row count as a by-product of the action that writes it: no job of its own.

    Count at the end of a plan: there each task's rows are taken once, even if it runs twice.
    """
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a stored Parquet table. No column is read, so the footers answer it."""
    return spark.read.parquet(path).count()
