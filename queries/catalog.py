"""Queries over the given tables, one per operator or table of the library."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from queries.telemetry_view import COLUMNS, TIE_BREAK, nested, table, telemetry, telemetry_in_slices
from roadstrata.functions.keys import null_safe_on, stable_dense_key
from roadstrata.functions.times import calendar_between, observed_hours
from roadstrata.operators.flatten import flatten
from roadstrata.operators.rules import FAILED, split, telemetry_rules, validation_summary
from roadstrata.operators.survivors import dedupe, latest_per_key
from roadstrata.plans import dims as D
from roadstrata.plans.facts import fact_traffic, hot_members, traffic_rollup
from roadstrata.plans.jobs import Layers, run_bronze, run_gold, run_silver
from roadstrata.schema import CORRUPT, SILVER_KEYS
from roadstrata.sinks.bronze import land_bronze
from roadstrata.sinks.gold import publish
from roadstrata.sinks.metrics import RunMetrics
from roadstrata.sinks.silver import merge_partitions, write_quarantine, write_silver
from roadstrata.sinks.versions import VersionedTable
from roadstrata.sources.documents import read_documents
from roadstrata.sources.files import (
    append_ledger,
    batch_id,
    declare_intent,
    intents,
    list_inputs,
    pending_files,
    read_ledger,
)
from roadstrata.sources.telemetry import (
    loaded_dates,
    read_inferred,
    read_landed,
    read_records,
    read_silver,
    read_telemetry,
)
from roadstrata.workspace import DENSE, PACKED, SMALLEST, discard, materialize, materialize_at, scratch_path, shuffles_dropped

Query = Callable[[SparkSession, str], DataFrame]

_stored: dict[tuple[str, str, str], object] = {}


def stored_once(name: str):
    """Let queries over the same tables in one application share an intermediate table."""

    def wrap(build: Query) -> Query:
        def get(spark: SparkSession, sf_dir: str):
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _stored:
                _stored[key] = build(spark, sf_dir)
            return _stored[key]

        return get

    return wrap


def presented(df: DataFrame) -> DataFrame:
    """Types that compare exactly across engines: naive timestamps, doubles, no arrays."""
    columns = []
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            columns.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif f.name == "alerts":
            columns.append(F.size(f.name).alias("n_alerts"))
        elif isinstance(f.dataType, T.ArrayType):
            columns.append(F.concat_ws(",", f.name).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


# --- files to read ---

#: A compressed file is read by one task, so each holds at most so many records.
RECORDS_PER_FILE = 200_000
#: One order in so many has its documents in plain files: with one in twenty these outweigh the packed ones.
PLAIN_ORDERS = 200


def write_records(records: DataFrame, path: str) -> None:
    """Add JSON Lines, compressed: as text the records are some forty times the size of the tables they come from."""
    with shuffles_dropped(records.sparkSession):
        records.write.mode("append").options(**SMALLEST, maxRecordsPerFile=RECORDS_PER_FILE).json(path)


def write_documents(records: DataFrame, path: str, size: int, marks: tuple[str, str, str], how: dict[str, str]) -> None:
    """Add array documents of up to `size` records each, given as text: a task joins the records it has, so none is shuffled.

    `marks` open a document, stand between its records and close it.
    """
    opening, between, closing = marks

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def document(some: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"value": [opening + between.join(some) + closing]})

        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= size:
                yield document(held[:size])
                held = held[size:]
        if held:
            yield document(held)

    documents = records.mapInArrow(joined, "value string")
    with shuffles_dropped(records.sparkSession):
        documents.write.mode("append").options(**how, maxRecordsPerFile=max(1, RECORDS_PER_FILE // size)).text(path)


# --- intermediate tables ---


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(telemetry(spark, sf_dir), telemetry_rules())[0]


@stored_once("valid")
def valid_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good readings, from which merges take their batches: stored, as a batch is scanned more than once."""
    return materialize(valid(spark, sf_dir), "valid")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(valid(spark, sf_dir), SILVER_KEYS, TIE_BREAK)


@stored_once("silver")
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(clean(spark, sf_dir), "silver")


@stored_once("gold")
def gold_root(spark: SparkSession, sf_dir: str) -> str:
    return scratch_path(spark, "gold")


@stored_once("dims")
def gold_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root, source = gold_root(spark, sf_dir), silver(spark, sf_dir)
    return {n: publish(build(source), root, n) for n, (build, _) in D.DIMENSIONS.items()}


@stored_once("fact")
def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fact_traffic(silver(spark, sf_dir), gold_dims(spark, sf_dir))
    return publish(fact, gold_root(spark, sf_dir), "fact_traffic")


@stored_once("raw")
def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The readings as JSON Lines files."""
    path = scratch_path(spark, "raw")
    for readings in telemetry_in_slices(spark, sf_dir):
        write_records(nested(readings), path)
    return path


@stored_once("damaged")
def damaged_files(spark: SparkSession, sf_dir: str) -> str:
    """The readings as JSON Lines; those of the widest vehicles are cut off mid-record."""
    path = scratch_path(spark, "damaged")
    for readings in telemetry_in_slices(spark, sf_dir):
        records = nested(readings, "vehicle_width = 25 as cut")
        text = F.to_json(F.struct(*[c for c in records.columns if c != "cut"]))
        line = F.when(F.col("cut"), F.expr("left(line, length(line) - 20)")).otherwise(F.col("line"))
        lines = records.select(text.alias("line"), "cut").select(line.alias("value"))
        with shuffles_dropped(spark):
            lines.write.mode("append").options(**SMALLEST, maxRecordsPerFile=RECORDS_PER_FILE).text(path)
    return path


# --- scans and projections ---


def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_telemetry(spark, raw_files(spark, sf_dir), multiline=False)
    return presented(flatten(raw))


def flatten_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as array documents with a record per line."""
    path = scratch_path(spark, "documents")
    record = F.to_json(F.struct("*"))
    for readings in telemetry_in_slices(spark, sf_dir):
        lines = nested(readings).select(record.alias("line"))
        # Some hundred records to a document, whatever the size of the tables.
        write_documents(lines, path, 500, ("[\n", ",\n", "\n]"), SMALLEST)
    return presented(flatten(read_records(spark, path)))


@stored_once("pretty")
def pretty_documents(spark: SparkSession, sf_dir: str) -> str:
    """The readings as array documents with a record on many lines, each with a nested field that the schema does not know."""
    path = scratch_path(spark, "pretty")
    # Files of one order in PLAIN_ORDERS are left plain, for the reader to split; as text all are a hundred times the size of the tables.
    plain = F.coalesce(F.pmod("l_orderkey", F.lit(PLAIN_ORDERS)) == 0, F.lit(False))
    some = [("plain", telemetry(spark, sf_dir).filter(plain), {})]
    some += [("packed", readings.filter(~plain), PACKED) for readings in telemetry_in_slices(spark, sf_dir)]
    for name, readings, how in some:
        rows = nested(readings, "struct(passenger_count * 2 as reading) as new_sensor")
        records = rows.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("record"))
        # Some thousand records to a document, whatever the size of the tables.
        write_documents(records, f"{path}/{name}", 5000, ("[ ", ", ", " ]"), how)
    return path


def flatten_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(flatten(read_documents(spark, f"{pretty_documents(spark, sf_dir)}/*")))


def flatten_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts by their content."""
    flat = flatten(read_telemetry(spark, raw_files(spark, sf_dir), multiline=False))
    alert = flat.select("vehicle_id", F.explode("alerts").alias("a"))
    return alert.select("vehicle_id", "a.type", "a.description", "a.severity", F.col("a.timestamp").alias("raised"))


def flatten_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and owners under a schema found in the data rather than declared."""
    raw = read_inferred(spark, raw_files(spark, sf_dir), multiline=False)
    picked = {
        "owner_name": "owner.name",
        "email": "owner.contact_info.email",
        "road_district": "road.district",
        "destination_district": "estimated_time_of_arrival.destination.district",
        "rpm": "engine_status.rpm",
        "is_running": "engine_status.is_running",
        "temperature": "weather_condition.temperature_celsius",
    }
    return presented(flatten(raw, picked))


def props_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k BIGINT")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def bronze_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    raw = read_telemetry(spark, damaged_files(spark, sf_dir), multiline=False)
    land_bronze(raw, path, "2024-01-01", "b0")
    landed = read_landed(spark, path, ["2024-01-01"])
    return landed.groupBy(F.col(CORRUPT).isNotNull().alias("malformed")).agg(
        F.count("*").alias("records"), F.count("vehicle_id").alias("with_vehicle")
    )


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole bronze job over damaged files: malformed records by the manifest's account."""
    layers = Layers.under(scratch_path(spark, "manifest"))
    run_bronze(
        spark, damaged_files(spark, sf_dir), layers, "2024-01-01", multiline=False, pattern="*.txt.gz"
    )
    errors = F.regexp_extract("error_msg", "^[0-9]+", 0).try_cast("bigint")
    files = list_inputs(spark, damaged_files(spark, sf_dir), "*.txt.gz").select(
        F.col("file_name").alias("listed_name"), F.col("size_bytes").alias("listed_bytes")
    )
    rows = spark.read.parquet(layers.manifest)
    folder = F.concat_ws("/", F.lit(layers.bronze), F.concat(F.lit("ingest_date="), F.col("ingest_date").cast("string")))
    path = F.concat_ws("/", folder, F.concat(F.lit("batch="), "batch"), "file_name")
    joined = rows.join(files, F.col("file_name") == F.col("listed_name"), "full")
    return joined.agg(
        F.sum(errors).alias("malformed_records"),
        F.count_if((F.col("status") == "failed") != errors.isNotNull()).alias("wrong_status"),
        F.count_if(~F.col("size_bytes").eqNullSafe(F.col("listed_bytes"))).alias("wrong_size"),
        F.count_if(~F.col("s3_path").eqNullSafe(path)).alias("wrong_path"),
    )


def bronze_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that the schema does not know comes back from the landed records."""
    root = scratch_path(spark, "payload")
    for readings in telemetry_in_slices(spark, sf_dir):
        write_records(nested(readings, "passenger_count * 2 as new_sensor"), f"{root}/in")
    layers = Layers.under(f"{root}/lake")
    run_bronze(spark, f"{root}/in", layers, "2024-01-01", pattern="*.json.gz", record_per_line=True)
    sensor = F.get_json_object("payload", "$.new_sensor").cast("bigint")
    return read_landed(spark, layers.bronze).groupBy(sensor.alias("new_sensor")).agg(
        F.count("*").alias("records"), F.count(CORRUPT).alias("malformed")
    )


def bronze_payload_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze job over documents: a nested field that the schema does not know comes back by its path."""
    layers = Layers.under(scratch_path(spark, "payload-documents"))
    run_bronze(spark, pretty_documents(spark, sf_dir), layers, "2024-01-01", pattern="*.txt*")
    reading = F.variant_get(F.parse_json("payload"), "$.new_sensor.reading", "bigint")
    return read_landed(spark, layers.bronze).groupBy(reading.alias("reading")).agg(
        F.count("*").alias("records"), F.count(CORRUPT).alias("malformed")
    )


def ingest_manifest_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file that cannot be opened and one that is cut off in its compression: both failed, the rest landed."""
    root = scratch_path(spark, "faults")
    layers = Layers.under(f"{root}/lake")
    for readings in telemetry_in_slices(spark, sf_dir):
        write_records(nested(readings), f"{root}/in/good")
    few = table(spark, sf_dir, "region").coalesce(1)
    few.write.json(f"{root}/tmp/plain")
    few.write.option("compression", "gzip").json(f"{root}/tmp/cut")
    _copy_first(spark, f"{root}/tmp/plain", f"{root}/in/not-compressed.json.gz", 1.0)
    _copy_first(spark, f"{root}/tmp/cut", f"{root}/in/cut-off.json.gz", 0.5)
    run_bronze(spark, f"{root}/in", layers, "2024-01-01", multiline=False, pattern="*.json*")
    landed = read_landed(spark, layers.bronze).groupBy(F.regexp_extract("source_file", r"/in/(good|[^/]+)", 1).alias("file")).agg(
        F.count("*").alias("records")
    )
    kind = F.when(F.col("file_name").startswith("part-"), "good").otherwise(F.col("file_name"))
    manifest = spark.read.parquet(layers.manifest).groupBy(kind.alias("file"), "status").agg(
        (F.count("error_msg") == F.count("*")).alias("with_error")
    )
    return manifest.join(landed, "file", "left").select("file", "status", "with_error", F.coalesce("records", F.lit(0)).cast("bigint").alias("records"))


def _copy_first(spark: SparkSession, folder: str, path: str, share: float) -> None:
    """Copy the first part of the largest file in `folder`, a small one, to `path`, on whatever file system that is."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    files = hadoop.fs.Path(folder).getFileSystem(conf)
    largest = max(files.listStatus(hadoop.fs.Path(folder)), key=lambda status: status.getLen())
    source, target = files.open(largest.getPath()), files.create(hadoop.fs.Path(path))
    data = spark.sparkContext._gateway.new_array(spark._jvm.byte, int(largest.getLen() * share))
    source.readFully(0, data)
    target.write(data)
    source.close()
    target.close()


def pending_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of returned items are in the ledger already; read just the others."""
    root, ledger = scratch_path(spark, "inbox"), scratch_path(spark, "ledger")
    records = [nested(readings) for readings in telemetry_in_slices(spark, sf_dir)]
    returned = F.col("weather_condition.condition") == "R"
    for some in records:
        write_records(some.filter(returned), f"{root}/first")
    append_ledger(list_inputs(spark, root, "*.json.gz"), ledger, "2024-01-01")
    for some in records:
        write_records(some.filter(~returned), f"{root}/second")
    pending = pending_files(list_inputs(spark, root, "*.json.gz"), read_ledger(spark, ledger))
    # File names only: the reader takes its paths on the driver.
    paths = [row.read_path for row in pending.select("read_path").collect()]
    return (
        flatten(read_telemetry(spark, paths, multiline=False))
        .groupBy("weather_condition")
        .agg(F.count("*").alias("records"))
    )


# --- validation and deduplication ---


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(valid(spark, sf_dir).drop(*TIE_BREAK))


def invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(split(telemetry(spark, sf_dir), telemetry_rules())[1].drop(*TIE_BREAK))


def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_summary(telemetry(spark, sf_dir), telemetry_rules())


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "quarantine")
    invalid = split(telemetry(spark, sf_dir), telemetry_rules())[1]
    write_quarantine(invalid, path)
    stored = spark.read.schema(invalid.schema).json(path)
    return stored.groupBy("date").agg(
        F.count("*").alias("rejected"),
        F.sum(F.size(FAILED)).alias("broken_rules"),
        F.count_if(F.array_contains(FAILED, "eta")).alias("eta_broken"),
    )


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(clean(spark, sf_dir).drop(*TIE_BREAK))


def dedupe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe(table(spark, sf_dir, "documents"), ["text"], ["doc_id"])
    return kept.select("doc_id", "text", "lang", "source", "n_chars")


def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", ties=["o_orderkey"])


# --- silver layout ---


@stored_once("by_date")
def silver_by_date(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "by-date")
    write_silver(silver(spark, sf_dir), path, cluster_by=["road_district", "timestamp"])
    return path


def silver_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_dates(spark, silver_by_date(spark, sf_dir))


def cluster_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = read_silver(spark, silver_by_date(spark, sf_dir))
    place = F.struct("road_district", "timestamp")
    in_file = Window.partitionBy("file").orderBy("row")
    rows = stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.withColumn("before", F.lag(place).over(in_file)).groupBy("date").agg(
        F.count("*").alias("rows"),
        F.max("timestamp").cast("timestamp_ntz").alias("latest"),
        F.count_if(F.col("before") > place).alias("out_of_order"),
    )


def silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches end as one clean table, here partitioned by month."""
    path = scratch_path(spark, "merged-silver")
    good = valid_stored(spark, sf_dir).withColumn("month", F.date_format("timestamp", "yyyyMM"))
    for flags in (["A", "N"], ["N", "R"]):
        batch = good.filter(F.col("weather_condition").isin(flags))
        merge_partitions(batch, path, order=TIE_BREAK, partition="month")
    return presented(read_silver(spark, path, columns=[*COLUMNS, "alerts"]))


def silver_merge_null_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As silver_merge, with a third of all readings in the partition of null, and the first batch once more."""
    path = scratch_path(spark, "null-days")
    month = F.when(F.dayofmonth("timestamp") > 10, F.date_format("timestamp", "yyyyMM"))
    good = valid_stored(spark, sf_dir).withColumn("month", month)
    for flags in (["A", "N"], ["N", "R"], ["A", "N"]):
        batch = good.filter(F.col("weather_condition").isin(flags))
        merge_partitions(batch, path, order=TIE_BREAK, partition="month")
    stored = read_silver(spark, path, columns=[*COLUMNS, "alerts", "month"])
    return presented(stored.withColumn("month", F.col("month").cast("string")))


@stored_once("versions")
def versioned(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """A table of months in versions: accepted and new readings first, late ones with some of the first again, and these once more."""
    stored = VersionedTable(spark, scratch_path(spark, "versions"), "month")
    good = valid_stored(spark, sf_dir).withColumn("month", F.date_format("timestamp", "yyyyMM"))
    for flags in (["A", "N"], ["N", "R"], ["N", "R"]):
        stored.merge(good.filter(F.col("weather_condition").isin(flags)), TIE_BREAK, cluster_by=["vehicle_id"])
    return stored


def silver_merge_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches, by the list of files of the last version."""
    return presented(versioned(spark, sf_dir).read().select(*COLUMNS, "alerts"))


def silver_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before the late batches."""
    return presented(versioned(spark, sf_dir).read(0).select(*COLUMNS, "alerts"))


def silver_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each version by its list of files, by month."""
    stored = versioned(spark, sf_dir)
    lists = [stored.files(v).withColumn("version", F.lit(v).cast("bigint")) for v in stored.versions()]
    return reduce(DataFrame.unionByName, lists).groupBy("version", F.col("part").alias("month")).agg(F.sum("rows").alias("rows"))


# --- gold ---


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    return presented(calendar_between(events, "ts"))


def dim_time_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_hours(silver(spark, sf_dir), "timestamp")


def dimension(name: str, dense: bool = False) -> Query:
    build = D.DIMENSIONS[name][0]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(build(silver(spark, sf_dir), dense=dense))

    return query


def dense_key_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners in two batches, the second with the first's members among its own: which batch gave a number, and the number."""
    path = scratch_path(spark, "owner-numbers")
    owners = silver(spark, sf_dir).select(*D.OWNER_KEY, "weather_condition")
    first = stable_dense_key(owners.filter("weather_condition = 'A'").select(*D.OWNER_KEY).distinct(), D.OWNER_KEY, "owner_sk", path)
    first = materialize(first, "first-numbers").withColumnRenamed("owner_sk", "first_sk")
    second = stable_dense_key(owners.select(*D.OWNER_KEY).distinct(), D.OWNER_KEY, "owner_sk", path)
    return second.join(first, null_safe_on(second, first, D.OWNER_KEY), "left").select(*[second[c] for c in D.OWNER_KEY], "owner_sk", "first_sk")


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.current_and_destination(silver(spark, sf_dir))


def fact_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(fact_traffic(silver(spark, sf_dir), gold_dims(spark, sf_dir)))


def fact_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(fact_traffic(silver(spark, sf_dir)))


def fact_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = gold_dims(spark, sf_dir)
    return presented(fact_traffic(silver(spark, sf_dir), dims, null_safe=True))


def fact_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys looked up, null parts too, where a third of all readings have one owner: hot keys are found and cut into pieces."""
    pooled = {"owner_name": "Pool", "phone": "1", "email": "fleet"}
    readings = silver(spark, sf_dir).withColumns(
        {c: F.when(F.col("l_orderkey") % 3 == 0, v).otherwise(F.col(c)) for c, v in pooled.items()}
    )
    dims = {n: materialize(build(readings), n) for n, (build, _) in D.DIMENSIONS.items()}
    hot = hot_members(readings, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return presented(fact_traffic(readings, dims, null_safe=True, hot=hot))


def rollup(grain: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        groups = traffic_rollup(gold_fact(spark, sf_dir), grain)
        return groups.withColumns(
            {name: F.round(name, 6) for name in ("avg_speed", "avg_congestion")}
        )

    return query


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per published table, from file footers."""
    fact = gold_fact(spark, sf_dir)
    tables = {**gold_dims(spark, sf_dir), "fact_traffic": fact}
    tables["fact_traffic_minute_agg"] = publish(
        traffic_rollup(fact), gold_root(spark, sf_dir), "fact_traffic_minute_agg"
    )
    counts = None
    for name, df in tables.items():
        count = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = count if counts is None else counts.unionByName(count)
    return counts


# --- whole jobs ---


def by_all_columns() -> list[Column]:
    """Alerts are left out: they follow from the other columns."""
    return [F.col(name).asc_nulls_first() for name in sorted(COLUMNS)]


@stored_once("lake")
def lake(spark: SparkSession, sf_dir: str) -> tuple[Layers, RunMetrics, RunMetrics]:
    """The three jobs one after another, from JSON files to the star schema."""
    layers, inbox = Layers.under(scratch_path(spark, "lake")), scratch_path(spark, "inbox")
    for readings in telemetry_in_slices(spark, sf_dir):
        write_records(nested(readings), inbox)
    run_bronze(spark, inbox, layers, "2024-01-01", multiline=False, pattern="*.json.gz")
    # All its records are landed, and nothing else reads these files.
    discard(spark, inbox)
    silver_run = run_silver(spark, layers, order=by_all_columns())
    gold_run = run_gold(spark, layers, partition_fact=False, cache_silver=True)
    return layers, silver_run, gold_run


def job_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = lake(spark, sf_dir)[0]
    return presented(read_silver(spark, layers.silver, columns=[*COLUMNS, "alerts"]))


def job_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(spark.read.parquet(f"{lake(spark, sf_dir)[0].gold}/fact_traffic"))


def job_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = spark.read.parquet(f"{lake(spark, sf_dir)[0].gold}/fact_traffic_minute_agg")
    return groups.withColumns({n: F.round(n, 6) for n in ("avg_speed", "avg_congestion")})


def job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the silver and gold jobs say they read, rejected and wrote."""
    _, silver_run, gold_run = lake(spark, sf_dir)
    counts = silver_run.to_frame(spark).unionByName(gold_run.to_frame(spark))
    # The number of landed batches depends on nothing in the tables.
    return counts.filter("stage <> 'batches'").select("stage", "rows")


def job_fact_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job by day with keys looked up."""
    layers = replace(lake(spark, sf_dir)[0], gold=scratch_path(spark, "gold-joined"))
    run_gold(spark, layers, resolve="join")
    return presented(spark.read.parquet(f"{layers.gold}/fact_traffic").drop("date"))


@stored_once("days")
def lake_by_day(spark: SparkSession, sf_dir: str) -> Layers:
    """Gold by day over all but some readings of the first and the last day, which come in late; then these two days again."""
    root = scratch_path(spark, "days")
    layers = Layers.under(f"{root}/lake")
    days = telemetry(spark, sf_dir).agg(F.min("date"), F.max("date")).first()
    late = F.col("date").isin(list(days)) & (F.col("weather_condition") != "A")
    # Only the late ones wait as a table: all of them would stand beside their raw files.
    kept = scratch_path(spark, "readings")
    waiting = materialize_at(telemetry(spark, sf_dir).filter(late), kept, **DENSE)

    def run(dates: list | None) -> None:
        run_bronze(spark, f"{root}/in", layers, "2024-01-01", pattern="*.json.gz", record_per_line=True)
        run_silver(spark, layers, order=by_all_columns())
        run_gold(spark, layers, dates=dates)

    for readings in telemetry_in_slices(spark, sf_dir):
        write_records(nested(readings.filter(~late)), f"{root}/in/first")
    run(None)
    write_records(nested(waiting), f"{root}/in/second")
    discard(spark, kept)
    run(list(days))
    return layers


def job_gold_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presented(spark.read.parquet(f"{lake_by_day(spark, sf_dir).gold}/fact_traffic"))


def job_gold_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = spark.read.parquet(f"{lake_by_day(spark, sf_dir).gold}/fact_traffic_minute_agg")
    return groups.withColumns({n: F.round(n, 6) for n in ("avg_speed", "avg_congestion")})


def job_gold_one_day_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All members of all dimensions, in one column set."""
    gold = lake_by_day(spark, sf_dir).gold
    shapes = {
        "dim_owner": ("owner_sk", D.OWNER_KEY, []),
        "dim_vehicle": ("vehicle_sk", ["license_number", "vehicle_type", "vehicle_classification"], ["vehicle_length", "vehicle_width", "vehicle_height"]),
        "dim_location": ("location_sk", D.LOCATION_KEY, []),
        "dim_weather": ("weather_sk", ["weather_condition"], ["temperature", "humidity"]),
    }
    parts = []
    for name, (key, texts, numbers) in shapes.items():
        text = [F.col(texts[i]) if i < len(texts) else F.lit(None).cast("string") for i in range(3)]
        number = [F.col(numbers[i]).cast("double") if i < len(numbers) else F.lit(None).cast("double") for i in range(3)]
        named = [c.alias(n) for c, n in zip([*text, *number], ("text_1", "text_2", "text_3", "number_1", "number_2", "number_3"), strict=True)]
        parts.append(spark.read.parquet(f"{gold}/{name}").select(F.lit(name).alias("dimension"), F.col(key).alias("key"), *named))
    return reduce(DataFrame.unionByName, parts)


def job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs lose their ledgers once, with a file more before the next run: nothing is doubled or lost."""
    root = scratch_path(spark, "rerun")
    layers = Layers.under(f"{root}/lake")
    records = [nested(readings) for readings in telemetry_in_slices(spark, sf_dir)]
    returned = F.col("weather_condition.condition") == "R"
    for some in records:
        write_records(some.filter(returned), f"{root}/in/first")
    # Landed, but the driver was lost before the ledger was written.
    files = list_inputs(spark, f"{root}/in", "*.json.gz")
    batch = batch_id(files)
    declare_intent(files, f"{layers.bronze_ledger}-intents", "2024-01-01", batch)
    land_bronze(read_records(spark, f"{root}/in/first"), layers.bronze, "2024-01-01", batch)
    run_silver(spark, layers, order=by_all_columns())
    for some in records:
        write_records(some.filter(~returned), f"{root}/in/second")
    run_bronze(spark, f"{root}/in", layers, "2024-01-02", pattern="*.json.gz", record_per_line=True)
    # The next silver run does not know of the first one either.
    run_silver(spark, replace(layers, silver_ledger=f"{layers.silver_ledger}-new"), order=by_all_columns())
    manifest = spark.read.parquet(layers.manifest)
    repeated = manifest.groupBy("s3_path").count().filter("count > 1")
    counts = {
        "landed": spark.read.parquet(layers.bronze),
        "quarantined": spark.read.json(layers.quarantine),
        "silver": read_silver(spark, layers.silver, columns=["vehicle_id"]),
        "manifest_repeats": repeated,
        "open_batches": pending_files(intents(spark, f"{layers.bronze_ledger}-intents"), read_ledger(spark, layers.bronze_ledger)),
    }
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("what"), "rows") for name, df in counts.items()],
    )


QUERIES: dict[str, Query] = {
    "flatten_nested": flatten_nested,
    "flatten_multiline": flatten_multiline,
    "flatten_documents": flatten_documents,
    "flatten_alerts": flatten_alerts,
    "flatten_inferred": flatten_inferred,
    "props_parse": props_parse,
    "bronze_landing": bronze_landing,
    "ingest_manifest": ingest_manifest,
    "ingest_manifest_faults": ingest_manifest_faults,
    "bronze_payload": bronze_payload,
    "bronze_payload_documents": bronze_payload_documents,
    "pending_records": pending_records,
    "valid_rows": valid_rows,
    "invalid_rows": invalid_rows,
    "validation_summary": validation_totals,
    "quarantine_roundtrip": quarantine_roundtrip,
    "dedupe_latest": dedupe_latest,
    "dedupe_documents": dedupe_documents,
    "latest_order_per_customer": latest_order_per_customer,
    "loaded_dates": silver_dates,
    "cluster_layout": cluster_layout,
    "silver_merge": silver_merge,
    "silver_merge_null_day": silver_merge_null_day,
    "silver_merge_late": silver_merge_late,
    "silver_as_of": silver_as_of,
    "silver_versions": silver_versions,
    "dim_time": dim_time,
    "dim_time_hour": dim_time_hour,
    "dim_owner": dimension("dim_owner"),
    "dim_owner_dense": dimension("dim_owner", dense=True),
    "dense_key_stable": dense_key_stable,
    "dim_vehicle": dimension("dim_vehicle"),
    "dim_location": dimension("dim_location"),
    "dim_weather": dimension("dim_weather"),
    "union_by_name": union_by_name,
    "fact_traffic": fact_looked_up,
    "fact_traffic_derived": fact_derived,
    "fact_traffic_nullsafe": fact_null_safe,
    "fact_traffic_skewed": fact_skewed,
    "traffic_rollup": rollup("second"),
    "traffic_rollup_minute": rollup("minute"),
    "table_row_counts": table_row_counts,
    "job_silver": job_silver,
    "job_fact": job_fact,
    "job_rollup": job_rollup,
    "job_metrics": job_metrics,
    "job_rerun": job_rerun,
    "job_fact_joined": job_fact_joined,
    "job_gold_by_day": job_gold_by_day,
    "job_gold_one_day": job_gold_one_day,
    "job_gold_one_day_dims": job_gold_one_day_dims,
}
