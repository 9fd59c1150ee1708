"""The three jobs: files -> bronze -> silver -> gold. Each can be run again without harm."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from roadstrata.functions.keys import repeated_keys, stable_dense_key
from roadstrata.operators.flatten import flatten
from roadstrata.operators.layout import by_partition
from roadstrata.operators.rules import RuleSet, split, telemetry_rules
from roadstrata.plans.dims import BUSINESS_KEYS, DIMENSIONS, MEMBERS_OF_DAY, dim_time
from roadstrata.plans.facts import GOLD_INPUT, fact_traffic, hot_members, traffic_rollup
from roadstrata.sinks.bronze import land_bronze, manifest_rows, write_manifest
from roadstrata.sinks.gold import JdbcTarget, publish
from roadstrata.sinks.metrics import RunMetrics, counted
from roadstrata.sinks.silver import merge_partitions, write_quarantine
from roadstrata.schema import CORRUPT
from roadstrata.sources.files import (
    append_ledger,
    batch_id,
    declare_intent,
    faulty_files,
    intents,
    list_inputs,
    open_batches,
    pending_files,
    read_ledger,
)
from roadstrata.sources.documents import read_documents
from roadstrata.sources.telemetry import SOURCE_FILE, read_records, read_telemetry
from roadstrata.workspace import (
    SHUFFLE_WIDTH,
    bytes_under,
    discard,
    partition_folders,
    path_exists,
    remove,
    scratch_path,
    session_setting,
    shuffle_width,
    shuffles_dropped,
)


@dataclass(frozen=True)
class Layers:
    """Where each table lives, as URIs of any file system Spark can reach."""

    bronze: str
    manifest: str
    bronze_ledger: str
    silver: str
    quarantine: str
    silver_ledger: str
    gold: str
    metrics: str

    @property
    def state(self) -> str:
        """What the gold job keeps by day to build its tables from."""
        return f"{self.gold}-state"

    @classmethod
    def under(cls, root: str) -> Layers:
        root = root.rstrip("/")
        return cls(
            bronze=f"{root}/bronze/raw",
            manifest=f"{root}/bronze/manifest",
            bronze_ledger=f"{root}/bronze/ledger",
            silver=f"{root}/silver/telemetry",
            quarantine=f"{root}/silver/quarantine",
            silver_ledger=f"{root}/silver/ledger",
            gold=f"{root}/gold",
            metrics=f"{root}/metrics",
        )


def run_bronze(
    spark: SparkSession,
    source: str,
    layers: Layers,
    ingest_date: str | None = None,
    multiline: bool = True,
    pattern: str = "*.json",
    record_per_line: bool = False,
) -> RunMetrics:
    """Land the files not landed before and record each in the manifest.

    No new files: nothing is written. A malformed file is recorded as failed and
    does not stop the others, nor does one that cannot be opened or read to its end: of that nothing is landed. Which files make up a batch, its name and its date are written down first
    and its ledger last: a run after a crash finishes open batches under their own names, replacing what
    they had written, before it takes in what has arrived since.

    `multiline` documents may have any layout. They are split freely, as are files with `record_per_line` (JSON Lines, or arrays with an
    element per line), in one pass less; both keep each record's text in `payload`. Without either, files are JSON Lines and no text is kept.
    """
    ingest_date = ingest_date or dt.datetime.now(dt.timezone.utc).date().isoformat()
    metrics = RunMetrics(f"bronze-{ingest_date}")
    declared = f"{layers.bronze_ledger}-intents"

    def ledger() -> DataFrame:
        return read_ledger(spark, layers.bronze_ledger)

    def land(day: str, batch: str) -> None:
        listing = intents(spark, declared, batch).drop("ingest_date", "batch")
        # The reader takes its paths on the driver, as every file scan does: one string per new file.
        paths = [row.read_path for row in listing.select("read_path").toLocalIterator()]
        faults: dict[str, str] = {}
        scratch = scratch_path(spark, "documents")

        def land_files(some: Sequence[str]) -> None:
            if record_per_line:
                raw = read_records(spark, some)
            elif multiline:
                raw = read_documents(spark, some, scratch=scratch)
            else:
                raw = read_telemetry(spark, some, multiline=False)
            # All come in even splits, so nothing is spread anew.
            land_bronze(raw, layers.bronze, day, batch, rebalance=False)

        with metrics.stage("land"):
            try:
                land_files(paths)
            except Exception:
                faults = faulty_files(spark, paths)
                if not faults:
                    raise
                discard(spark, scratch)
                if good := [p for p in paths if p not in faults]:
                    land_files(good)
            discard(spark, scratch)
        if faults:
            metrics.record("faulty_files", len(faults))
        with metrics.stage("manifest") as stage:
            target = f"{layers.bronze}/ingest_date={day}/batch={batch}"
            landed = spark.read.parquet(target) if len(faults) < len(paths) else None
            write_manifest(manifest_rows(listing, landed, target, day, batch, faults=faults), layers.manifest)
            stage.rows = len(paths)
        append_ledger(listing, layers.bronze_ledger)

    unfinished = open_batches(spark, declared, ledger())
    for day, batch in unfinished:
        land(day, batch)
    listing = pending_files(list_inputs(spark, source, pattern), ledger())
    new = listing.count()
    metrics.record("listed_files", new)
    if new:
        batch = batch_id(listing)
        declare_intent(listing, declared, ingest_date, batch)
        land(ingest_date, batch)
    return metrics


def landed_batches(spark: SparkSession, bronze: str, ingest_dates: Iterable[str] | None = None) -> list[str]:
    """ingest_date/batch of all landed batches, from folder names: no file is opened."""
    wanted = None if ingest_dates is None else set(map(str, ingest_dates))
    return [
        f"{day}/{batch}"
        for day, folder in partition_folders(spark, bronze, "ingest_date").items()
        if wanted is None or day in wanted
        for batch in partition_folders(spark, folder, "batch")
    ]


def run_silver(
    spark: SparkSession,
    layers: Layers,
    ingest_dates: Iterable[str] | None = None,
    rules: RuleSet | None = None,
    order: Sequence[Column | str] | None = None,
    cluster_by: Sequence[str] = (),
    cache_flat: bool = False,
    partition: str = "date",
) -> RunMetrics:
    """Flatten, validate, quarantine and merge the landed batches not taken in before.

    One pass writes the rejected rows and, as it goes, counts rows and broken rules; it
    ends in no shuffle, so no count is taken twice when a task is run again. The
    other passes find the days and write the good rows; they come first, so that the rejected rows never stand beside
    the shuffle files of the merge. All read columnar landed files of the new batches
    only; `cache_flat` keeps the flat rows between them, for batches that fit on the executors. `order` says
    which row of a repeated key survives (default: by content). Rejected rows keep their source file and,
    if it could not be read, their text; each landed batch has its own quarantine folder.
    """
    rules = rules or telemetry_rules()
    listed = spark.createDataFrame(
        [(name,) for name in landed_batches(spark, layers.bronze, ingest_dates)], "file_path STRING"
    )
    new = pending_files(listed, read_ledger(spark, layers.silver_ledger)).collect()
    names = sorted(row.file_path for row in new)
    metrics = RunMetrics("silver-" + (names[-1] if names else "none"))
    metrics.record("batches", len(names))
    if not names:
        return metrics
    batches = spark.createDataFrame([(name,) for name in names], "file_path STRING")
    folders = ["{}/ingest_date={}/batch={}".format(layers.bronze, *name.split("/")) for name in names]
    landed = spark.read.option("basePath", layers.bronze).parquet(*folders)
    # Under another name: JSON readers take the usual one for their own.
    flat = flatten(landed, keep=["ingest_date", "batch", SOURCE_FILE, F.col(CORRUPT).alias("unreadable")])
    if cache_flat:
        flat = flat.persist(StorageLevel.MEMORY_AND_DISK)

    with metrics.stage("silver") as stage:
        valid, _ = split(flat.drop("ingest_date", "batch", SOURCE_FILE, "unreadable"), rules)
        stage.rows = merge_partitions(
            valid, layers.silver, order=order, partition=partition, cluster_by=cluster_by,
            batch_bytes=bytes_under(spark, *folders),
        )

    seen = Observation()
    with metrics.stage("quarantine") as stage:
        _, invalid = split(flat.observe(seen, *rules.totals()), rules)
        write_quarantine(invalid, layers.quarantine, ("ingest_date", "batch"))
        counts = seen.get
        stage.rows = counts["invalid"]
    for name, rows in counts.items():
        metrics.record(f"rows_{name}", rows)
    if cache_flat:
        flat.unpersist()
    append_ledger(batches, layers.silver_ledger)
    return metrics


def member_days(
    spark: SparkSession,
    layers: Layers,
    name: str,
    rows_of: Callable[[Collection[str | None] | None], DataFrame],
    wanted: Collection[str] | None,
) -> DataFrame:
    """Each day's members of a dimension, found anew for the days `wanted` and those not met before, or for all (None).

    One table, far smaller than the flat one, written as a new version: a run that is cut off leaves the old one.
    """
    path = f"{layers.state}/{name}"
    versions = [v for v, f in partition_folders(spark, path, "version").items() if path_exists(spark, f"{f}/_SUCCESS")]
    last = max(map(int, versions), default=-1)
    kept, days = None, None
    if wanted is not None and last >= 0:
        old = spark.read.parquet(f"{path}/version={last}")
        known = {None if r.date is None else str(r.date) for r in old.select("date").distinct().collect()}
        days = [d for d in partition_folders(spark, layers.silver, "date") if d not in known or d in wanted]
        renewed = F.coalesce(F.col("date").cast("string").isin([d for d in days if d is not None]), F.lit(None in days))
        kept = old.filter(~renewed)
    members = MEMBERS_OF_DAY[name](rows_of(days))
    if kept is not None:
        members = kept.unionByName(members)
    members.write.mode("overwrite").parquet(f"{path}/version={last + 1}")
    for v in versions:
        remove(spark, f"{path}/version={v}")
    return spark.read.parquet(f"{path}/version={last + 1}")


def of_days(path: str, spark: SparkSession, days: Collection[str | None] | None) -> DataFrame:
    """The table at `path`, or only the folders of `days`, which must be there."""
    if days is None:
        return spark.read.parquet(path)
    there = partition_folders(spark, path, "date")
    folders = [there[day] for day in sorted(days, key=str) if day in there]
    if not folders:
        return spark.read.parquet(path).limit(0)
    read = spark.read.option("basePath", path).parquet(*folders)
    return read.withColumn("date", F.col("date").cast("date"))


def _rolled_up_days(days: Collection[str | None] | None, grain: str) -> tuple[Collection | None, Collection | None]:
    """(days of groups that rows of `days` can belong to, days whose rows can belong to these groups).

    Only an hour may begin on the day before, where the zone is off by a part of an hour.
    """
    if days is None or grain != "hour":
        return days, days

    def beside(some: set, by: int) -> set:
        return some | {str(dt.date.fromisoformat(d) + dt.timedelta(days=by)) for d in some if d}

    groups = beside(set(days), -1)
    return groups, beside(groups, 1)


def run_gold(
    spark: SparkSession,
    layers: Layers,
    calendar: tuple[dt.datetime, dt.datetime] | None = None,
    dates: Collection[dt.date] | None = None,
    resolve: str = "derive",
    dense: Collection[str] = (),
    null_safe: bool = False,
    grain: str = "second",
    fact_mode: str = "overwrite",
    partition_fact: bool = True,
    jdbc: JdbcTarget | None = None,
    cache_silver: bool = False,
    parallel: int = 4,
    stable: Collection[str] = (),
    split_hot: bool = False,
) -> RunMetrics:
    """Build the dimensions, then the fact and its rollup, each evaluated once.

    The fact is stored by day and rebuilt day by day, all days or just `dates`, so a
    rerun replaces its rows; `fact_mode="append"` adds them again instead. Beside it each day's members of every
    dimension are kept (`layers.state`), and the rollup is stored by day: with `dates`, only these days of the flat table and of the
    fact are read, and those not met before; dimensions are built from all days' members, and the rollup is rebuilt for the days' groups. Without `partition_fact` all is one flat table each, and a rerun rebuilds all of it.
    `resolve` is how fact rows find their keys: "derive" or "join"; with "join", `split_hot` looks for hot keys first, in one
    pass over the key columns, and cuts them into pieces. Dimensions named in
    `dense` are numbered 0..n-1; those numbers move as members arrive, so they need
    "join" and a fact rebuilt as a whole. Those named in `stable` have dense numbers too, but members keep them from run to run
    (`layers.state` holds the numbers), so single days can be rebuilt; they need "join" as well. `cache_silver` keeps the columns in use on
    the executors: worth it while they fit there, above all when the days are many
    and thin; beyond that each table's scan reads only its own columns anyway. A
    lost executor's part is read again.
    """
    if resolve not in ("derive", "join"):
        raise ValueError(f"unknown way to resolve keys: {resolve!r}")
    if dates is not None and not partition_fact:
        raise ValueError("single days can only be rebuilt in a fact stored by day")
    if dense and (resolve == "derive" or dates is not None or fact_mode == "append"):
        raise ValueError("dense keys need resolve='join' and a fact rebuilt as a whole")
    if stable and (resolve == "derive" or set(stable) & set(dense)):
        raise ValueError("stable keys need resolve='join', and a dimension has one kind of key")
    metrics = RunMetrics("gold")
    by_day = ("date",) if partition_fact else ()
    wanted = None if dates is None else {str(d) for d in dates}
    read = [layers.silver]
    if wanted is not None:
        read = [f for day, f in partition_folders(spark, layers.silver, "date").items() if day in wanted]
    with session_setting(spark, SHUFFLE_WIDTH, str(shuffle_width(spark, *read))), shuffles_dropped(spark):
        cached: list[DataFrame] = []

        def silver_of(days: Collection[str | None] | None) -> DataFrame:
            rows = of_days(layers.silver, spark, days).select(*GOLD_INPUT)
            if cache_silver:
                rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
                cached.append(rows)
            return rows

        def store(name: str, df: DataFrame, **how) -> DataFrame:
            with metrics.stage(name) as stage:
                df, written = counted(df)
                stored = publish(df, layers.gold, name, jdbc=jdbc, **how)
                stage.rows = written.get["rows"]
            return stored

        rows = silver_of(None if wanted is None else list(wanted))

        def build_dim(name: str) -> DataFrame:
            build, key = DIMENSIONS[name]
            members = rows
            if partition_fact:
                # The rows at hand serve where they are of the days asked for.
                rows_of = lambda days: rows if (days and set(days)) == wanted else silver_of(days)
                members = member_days(spark, layers, name, rows_of, wanted)
            built = build(members, dense=name in dense)
            if name in stable:
                columns = built.columns
                built = stable_dense_key(built.drop(key), BUSINESS_KEYS[name], key, f"{layers.state}/keys_{name}").select(*columns)
            stored = store(name, built)
            if not repeated_keys(stored, key).isEmpty():
                raise ValueError(f"{name}: two members share a {key}; use dense keys")
            return stored

        tasks: dict[str, Callable[[], DataFrame]] = {
            "dim_time": lambda: store("dim_time", dim_time(spark, *(calendar or ())))
        }
        for name in DIMENSIONS:
            tasks[name] = lambda name=name: build_dim(name)
        # The tables do not depend on each other, so their jobs share the cluster.
        with ThreadPoolExecutor(max(1, parallel)) as pool:
            running = {n: pool.submit(inheritable_thread_target(spark)(t)) for n, t in tasks.items()}
            dims = {name: future.result() for name, future in running.items()}

        hot = None
        if split_hot and resolve == "join":
            hot = hot_members(rows, int(spark.conf.get(SHUFFLE_WIDTH)))
        fact = fact_traffic(rows, dims if resolve == "join" else None, null_safe, keep=by_day, hot=hot)
        if by_day and resolve == "join":
            fact = by_partition(fact, "date")
        # Else: derived facts come straight from files of one day each and need no shuffle.
        stored = store(
            "fact_traffic", fact, mode=fact_mode, partition_by=by_day,
            keep_other_partitions=dates is not None,
        )
        if not by_day:
            store("fact_traffic_minute_agg", traffic_rollup(stored, grain))
        else:
            # The state of a day is its part of the fact; only days that can hold rows of the groups are read.
            groups, their_rows = _rolled_up_days(None if wanted is None else list(wanted), grain)
            rolled = traffic_rollup(of_days(f"{layers.gold}/fact_traffic", spark, their_rows), grain)
            rolled = rolled.withColumn("date", F.to_date(F.timestamp_seconds("time_sk")))
            if groups is not None:
                own = F.col("date").cast("string").isin([d for d in groups if d is not None])
                rolled = rolled.filter(own | F.col("date").isNull() if None in groups else own)
            store(
                "fact_traffic_minute_agg", by_partition(rolled, "date"), partition_by=by_day,
                keep_other_partitions=groups is not None,
            )
        for df in cached:
            df.unpersist()
    return metrics
