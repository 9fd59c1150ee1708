"""Where intermediate tables go: the shared folder the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

#: How rows are written as text: at the library's own level, as the fastest one takes half as much disk again.
PACKED = {"compression": "gzip", "zlib.compress.level": "DEFAULT_COMPRESSION"}
#: How raw files and rejected rows are, which are the most of what stays: a twentieth less again, for a fifth more time. The closest level takes
#: a twentieth less than this one, for twice the time.
SMALLEST = {"compression": "gzip", "zlib.compress.level": "SEVEN"}
#: How tables of whole records are written: this level takes a sixth less than the codec's own.
DENSE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}

SHUFFLE_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. A local session without one gets a fresh temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local-cluster") or not master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that every executor can reach; "
            "intermediate tables must outlive the loss of an executor"
        )
    folder = tempfile.mkdtemp(prefix="roadstrata-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/roadstrata/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: later plans start from the files."""
    return materialize_at(df, scratch_path(df.sparkSession, label))


def materialize_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system its scheme names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of this application once its rows are stored elsewhere."""
    if not path.startswith(_own_folder(spark) + "/"):
        raise ValueError(f"{path} is not an intermediate table of this application")
    remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is at `path`, if anything."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def bytes_under(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files under `paths`: name folders of one run, not whole histories, each listing is a walk."""
    total = 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(target).getLength()
    return total


def shuffle_width(
    spark: SparkSession, *paths: str, more_bytes: int = 0, bytes_per_task: int = 64 << 20
) -> int:
    """How many partitions a shuffle of the files under `paths`, and `more_bytes`, should start with.

    AQE merges shuffle partitions that turn out small but cannot split ones that are all
    too big, so the starting number must follow the input: about `bytes_per_task`
    of compressed columnar data each, never under the session's own number.
    """
    wanted = -(-(bytes_under(spark, *paths) + more_bytes) // bytes_per_task)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_folders(spark: SparkSession, path: str, column: str) -> dict[str | None, str]:
    """Value -> folder of the partitions of `column` right under `path`: a listing, no file is opened.

    Null has the value None. A path that is not there, or holds no such folder, gives none.
    """
    if not path_exists(spark, path):
        return {}
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = {}
    for status in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target):
        name, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and name == column:
            value = unquote(value)
            found[None if value == NO_VALUE else value] = f"{path.rstrip('/')}/{status.getPath().getName()}"
    return found


def evenly_cut(df: DataFrame, spread: int = 2) -> bool:
    """Whether `df` is read from files in as many tasks as there are cores or more, none with over `spread` times the mean of bytes.

    A plan with a shuffle is none that can be known before it is run.
    """
    plan = df._jdf.queryExecution()
    if any(name in plan.executedPlan().toString() for name in ("AdaptiveSparkPlan", "Exchange")):
        return False
    sizes = []
    for part in plan.toRdd().partitions():
        if not part.getClass().getSimpleName() == "FilePartition":
            return False
        sizes.append(sum(f.length() for f in part.files()))
    return len(sizes) >= df.sparkSession.sparkContext.defaultParallelism and max(sizes) * len(sizes) <= spread * sum(sizes)


@contextmanager
def few_partitions(spark: SparkSession, most: int = 16):
    """Write to partitions of which a task has only a few, without sorting its rows by them first: wide rows would spill.

    A task that meets more than `most` sorts the rest.
    """
    with session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Delete the shuffle files of each action in the block as it ends; else they stay until the driver happens to collect its garbage.

    For writes, whose rows then stand elsewhere: toLocalIterator() still reads after its action has ended.
    """
    with session_setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """Run the actions in the block under one changed session setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
