"""Whole jobs over small files: results, invariants, and reruns that change nothing."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from roadstrata.functions.keys import repeated_keys
from roadstrata.operators.flatten import flatten
from roadstrata.operators.rules import split, telemetry_rules
from roadstrata.plans.dims import DIMENSIONS
from roadstrata.plans.facts import fact_traffic, traffic_rollup
from roadstrata.plans.jobs import Layers, run_bronze, run_gold, run_silver
from roadstrata.schema import FLAT_COLUMNS, MANIFEST_COLUMNS
from roadstrata.sinks.silver import merge_partitions, stored_partitions, write_quarantine, write_silver
from roadstrata.sources.telemetry import loaded_dates, read_silver, read_telemetry
from tests.records import record, write_document, write_lines


def rows(df):
    return sorted((tuple(repr(v) for v in r) for r in df.select(*sorted(df.columns)).collect()))


def day(d, minute=0, **changes):
    return record(
        timestamp=f"2024-03-{d:02d}T08:{minute:02d}:00Z",
        estimated_time_of_arrival__eta=f"2024-03-{d:02d}T09:30:00Z",
        **changes,
    )


SHORT = (dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2))

FIRST = [
    day(1), day(1), day(1, 5, vehicle_id="V2", owner__license_number="L2"),
    day(2, speed_kmph=999.0), day(2, road__street=None, engine_status__rpm=-1),
    day(2, 7, owner__contact_info__phone=None, traffic_status__congestion_level="Jammed"),
]
SECOND = [day(2, 9, vehicle_id="V3"), day(3, estimated_time_of_arrival__destination=None), day(1)]


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    write_document(folder / "first.json", FIRST)
    (folder / "bad.json").write_text(json.dumps([day(1)])[:50])
    (folder / "readme.txt").write_text("not data")
    return folder


@pytest.fixture
def layers(tmp_path):
    return Layers.under(str(tmp_path / "lake"))


def test_bronze_without_files_writes_nothing(spark, tmp_path, layers):
    (tmp_path / "empty").mkdir()
    assert run_bronze(spark, str(tmp_path / "empty"), layers).rows() == {"listed_files": 0}
    assert not (tmp_path / "lake").exists()


def test_bronze_lands_all_files_and_reports_the_bad_one(spark, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    manifest = spark.read.parquet(layers.manifest)
    assert sorted(manifest.columns) == sorted([*MANIFEST_COLUMNS, "batch"])
    got = {r.file_name: r for r in manifest.collect()}
    assert set(got) == {"first.json", "bad.json"}
    assert got["first.json"].status == "success" and got["first.json"].error_msg is None
    assert got["first.json"].size_bytes == (inbox / "first.json").stat().st_size
    assert got["bad.json"].status == "failed" and got["bad.json"].error_msg.startswith("1 ")
    landed = spark.read.parquet(layers.bronze)
    assert landed.filter("_corrupt_record is null").count() == len(FIRST)
    assert str(landed.first().ingest_date) == "2024-03-05"


def test_bronze_again_lands_only_new_files(spark, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    assert run_bronze(spark, str(inbox), layers, "2024-03-05").rows() == {"listed_files": 0}
    write_document(inbox / "second.json", SECOND)
    assert run_bronze(spark, str(inbox), layers, "2024-03-05").rows()["listed_files"] == 1
    assert spark.read.parquet(layers.bronze).count() == len(FIRST) + 1 + len(SECOND)
    assert spark.read.parquet(layers.manifest).count() == 3


def test_silver_counts_quarantine_and_rerun(spark, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    metrics = run_silver(spark, layers, cluster_by=["road_district", "timestamp"]).rows()
    assert metrics["rows_total"] == len(FIRST) + 1
    # Rejected: two bad readings and the unreadable file.
    assert metrics["rows_invalid"] == 3 and metrics["rows_valid"] == 4
    silver = read_silver(spark, layers.silver)
    assert sorted(silver.columns) == sorted(FLAT_COLUMNS)
    assert dict(silver.dtypes)["date"] == "date"
    assert silver.count() == 3 and silver.select("vehicle_id", "timestamp").distinct().count() == 3
    rejected = spark.read.json(layers.quarantine)
    assert rejected.count() == 3
    reasons = {tuple(r.failed_rules) for r in rejected.collect()}
    assert ("speed",) in reasons and ("road_street", "rpm") in reasons

    before = rows(silver)
    assert run_silver(spark, layers).rows() == {"batches": 0}
    assert rows(read_silver(spark, layers.silver)) == before


def test_silver_in_two_batches_equals_one(spark, tmp_path, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    run_silver(spark, layers)
    write_document(inbox / "second.json", SECOND)
    run_bronze(spark, str(inbox), layers, "2024-03-06")
    assert run_silver(spark, layers, ["2024-03-05", "2024-03-06"]).rows()["batches"] == 1

    at_once = Layers.under(str(tmp_path / "other"))
    run_bronze(spark, str(inbox), at_once, "2024-03-06")
    run_silver(spark, at_once)
    assert rows(read_silver(spark, layers.silver)) == rows(read_silver(spark, at_once.silver))


def test_silver_repeats_safely_after_a_crash_before_the_ledger(spark, inbox, layers, monkeypatch):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    import roadstrata.plans.jobs as jobs

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "append_ledger", crash)
        with pytest.raises(RuntimeError):
            run_silver(spark, layers)
    before = rows(read_silver(spark, layers.silver)), spark.read.json(layers.quarantine).count()
    run_silver(spark, layers)
    assert (rows(read_silver(spark, layers.silver)), spark.read.json(layers.quarantine).count()) == before


@pytest.fixture
def silver(spark, tmp_path):
    records = FIRST + SECOND + [
        day(4, 1, owner__license_number=None), day(4, 2, owner__license_number=None, vehicle_type="Bus"),
        day(4, 3, weather_condition__temperature_celsius="NaN"),
        day(4, 4, weather_condition__temperature_celsius=-0.0),
        day(4, 5, weather_condition__temperature_celsius=0.0),
        day(4, 6, road__city=None), day(4, 7, fuel_level_percentage=None),
    ]
    path = write_lines(tmp_path / "silver.json", records)
    flat = flatten(read_telemetry(spark, path, multiline=False))
    out = str(tmp_path / "silver")
    merge_partitions(split(flat, telemetry_rules())[0], out)
    return read_silver(spark, out)


def test_dimensions_are_unique_on_both_keys(silver):
    for name, (build, key) in DIMENSIONS.items():
        dim = build(silver)
        business = [c for c in dim.columns if c != key]
        assert repeated_keys(dim, key).isEmpty(), name
        assert dim.count() == dim.select(*business).distinct().count(), name
    vehicles = {r.license_number: r.vehicle_type for r in DIMENSIONS["dim_vehicle"][0](silver).collect()}
    assert vehicles[None] == "Bus"
    weather = DIMENSIONS["dim_weather"][0](silver)
    assert weather.filter("temperature = 0").count() == 1
    assert [math.copysign(1, r.temperature) for r in weather.filter("temperature = 0").collect()] == [1]
    assert weather.filter("isnan(temperature)").count() == 1


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("dense", [False, True])
def test_looked_up_fact_is_whole_and_resolves(silver, null_safe, dense):
    dims = {name: build(silver, dense=dense) for name, (build, _) in DIMENSIONS.items()}
    fact = fact_traffic(silver, dims, null_safe)
    assert fact.count() == silver.count()
    for alias, dim, key in [
        ("owner_sk", "dim_owner", "owner_sk"), ("vehicle_sk", "dim_vehicle", "vehicle_sk"),
        ("cur_location_sk", "dim_location", "location_sk"),
        ("dest_location_sk", "dim_location", "location_sk"), ("weather_sk", "dim_weather", "weather_sk"),
    ]:
        keys = fact.select(F.col(alias).alias(key)).filter(f"{key} is not null")
        assert keys.join(dims[dim], key, "left_anti").isEmpty()
    nulls = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in fact.columns if c.endswith("_sk")]).first()
    if null_safe:
        assert not any(nulls)
    else:
        assert nulls.vehicle_sk == 2 and nulls.owner_sk == 1
        assert nulls.cur_location_sk == 1 and nulls.dest_location_sk == 1 and nulls.weather_sk == 0
    if not dense:
        assert rows(fact) == rows(fact_traffic(silver, None, null_safe))


def test_derived_fact_needs_no_shuffle(silver):
    plan = fact_traffic(silver)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert "alerts" not in plan.split("ReadSchema")[1]


def test_rollup_grains(silver):
    fact = fact_traffic(silver)
    by_second, by_minute = traffic_rollup(fact), traffic_rollup(fact, "minute")
    assert by_second.agg(F.sum("traffic_count")).first()[0] == silver.count()
    assert by_minute.filter("time_sk % 60 <> 0").isEmpty()
    # The place without a city is a group of its own.
    assert by_second.filter("cur_location_sk is null").count() == 1
    jammed = fact.filter("congestion_score = 0")
    assert jammed.count() == 1


def test_gold_twice_gives_the_same_tables(spark, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    run_silver(spark, layers)
    tables = [*DIMENSIONS, "fact_traffic", "fact_traffic_minute_agg"]
    stored = lambda: {t: rows(spark.read.parquet(f"{layers.gold}/{t}")) for t in tables}
    metrics = run_gold(spark, layers).rows()
    assert metrics["dim_time"] == 262_080 and metrics["fact_traffic"] == 3
    first = stored()
    run_gold(spark, layers, SHORT, resolve="join")
    assert stored() == first
    run_gold(spark, layers, SHORT, dates=[dt.date(2024, 3, 1)])
    assert stored() == first
    run_gold(spark, layers, SHORT, fact_mode="append")
    assert len(rows(spark.read.parquet(f"{layers.gold}/fact_traffic"))) == 6


def test_gold_refuses_colliding_keys(spark, inbox, layers, monkeypatch):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    run_silver(spark, layers)
    build = DIMENSIONS["dim_owner"][0]

    def colliding(silver, dense):
        return build(silver).withColumn("owner_sk", F.lit(1).cast("bigint"))

    monkeypatch.setitem(DIMENSIONS, "dim_owner", (colliding, "owner_sk"))
    with pytest.raises(ValueError, match="dense"):
        run_gold(spark, layers, SHORT)


@pytest.mark.parametrize("null_safe", [False, True])
def test_gold_with_hot_keys_cut_gives_the_derived_fact(spark, inbox, layers, null_safe):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    run_silver(spark, layers)
    run_gold(spark, layers, SHORT, null_safe=null_safe)
    derived = rows(spark.read.parquet(f"{layers.gold}/fact_traffic"))
    run_gold(spark, layers, SHORT, resolve="join", split_hot=True, null_safe=null_safe)
    assert rows(spark.read.parquet(f"{layers.gold}/fact_traffic")) == derived


def test_gold_with_dense_keys_and_one_flat_fact(spark, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    run_silver(spark, layers)
    metrics = run_gold(
        spark, layers, SHORT, resolve="join", dense=["dim_owner"], partition_fact=False, cache_silver=True
    ).rows()
    fact = spark.read.parquet(f"{layers.gold}/fact_traffic")
    assert fact.count() == metrics["fact_traffic"] == 3 and "date" not in fact.columns
    owners = spark.read.parquet(f"{layers.gold}/dim_owner")
    assert sorted(r.owner_sk for r in owners.collect()) == [0, 1]
    assert fact.filter("owner_sk is not null").join(owners, "owner_sk", "left_anti").isEmpty()


@pytest.mark.parametrize(
    "options",
    [
        {"resolve": "guess"},
        {"dense": ["dim_owner"]},
        {"dense": ["dim_owner"], "resolve": "join", "fact_mode": "append"},
        {"dates": ["2024-03-01"], "partition_fact": False},
    ],
)
def test_gold_refuses_unsound_options(spark, layers, options):
    with pytest.raises(ValueError):
        run_gold(spark, layers, **options)


def test_silver_after_a_batch_without_one_good_row(spark, tmp_path, layers):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_document(inbox / "a.json", [day(1, vehicle_id=None)])
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    assert run_silver(spark, layers).rows()["silver"] == 0
    write_document(inbox / "b.json", [day(1)])
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    assert run_silver(spark, layers).rows()["silver"] == 1
    assert read_silver(spark, layers.silver).count() == 1


def test_merge_keeps_rows_of_a_partly_covered_day(spark, tmp_path):
    schema = "vehicle_id string, timestamp int, date string, v string"
    out = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, "d1", "x"), ("b", 2, "d1", "x"), ("c", 3, "d2", "x")], schema)
    late = spark.createDataFrame([("b", 2, "d1", "x"), ("z", 9, "d1", "x"), ("n", 5, "d3", "x")], schema)
    for batch in (first, late, late, first):
        merge_partitions(batch, out)
    got = spark.read.parquet(out)
    assert sorted(r.vehicle_id for r in got.collect()) == ["a", "b", "c", "n", "z"]


def test_merge_over_many_days_reads_their_folders_only(spark, tmp_path):
    schema = "vehicle_id string, timestamp int, date string"
    out = str(tmp_path / "t")
    stored = [(v, d, f"d{d}") for v in "ab" for d in (1, 2, 3, 4, 5)]
    merge_partitions(spark.createDataFrame(stored, schema), out)
    late = [("a", 1, "d1"), ("c", 3, "d3"), ("c", 5, "d5")]
    batch = spark.createDataFrame(late, schema)
    read = stored_partitions(batch, out)[0].select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("date=")[1].split("/")[0] for r in read} == {"d1", "d3", "d5"}
    assert merge_partitions(batch, out) == 8
    got = sorted(map(tuple, spark.read.parquet(out).select("vehicle_id", "timestamp", "date").collect()))
    assert got == sorted({*stored, *late})


def test_merge_keeps_rows_of_a_null_day(spark, tmp_path):
    schema = "vehicle_id string, timestamp int, date string"
    out = str(tmp_path / "t")
    first, late = [("a", None, None), ("b", 1, "d1")], [("c", None, None), ("e", 2, "d1")]
    for rows in (first, late, late, [("a", None, None)]):
        merge_partitions(spark.createDataFrame(rows, schema), out)
    got = spark.read.parquet(out).select("vehicle_id", "timestamp", "date").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, first + late))


@pytest.mark.parametrize("crash_at", ["write_manifest", "append_ledger"])
def test_bronze_repeats_safely_after_a_crash_and_a_new_file(spark, inbox, layers, monkeypatch, crash_at):
    import roadstrata.plans.jobs as jobs

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, crash_at, crash)
        with pytest.raises(RuntimeError):
            run_bronze(spark, str(inbox), layers, "2024-03-05")
    write_document(inbox / "second.json", SECOND)
    run_bronze(spark, str(inbox), layers, "2024-03-06")
    assert spark.read.parquet(layers.bronze).count() == len(FIRST) + 1 + len(SECOND)
    manifest = spark.read.parquet(layers.manifest)
    assert sorted(r.file_name for r in manifest.collect()) == ["bad.json", "first.json", "second.json"]
    assert {str(r.ingest_date) for r in manifest.filter("file_name <> 'second.json'").collect()} == {"2024-03-05"}
    assert run_bronze(spark, str(inbox), layers, "2024-03-07").rows() == {"listed_files": 0}


def test_silver_repeats_safely_after_a_crash_and_a_new_batch(spark, inbox, layers, monkeypatch):
    import roadstrata.plans.jobs as jobs

    run_bronze(spark, str(inbox), layers, "2024-03-05")
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "append_ledger", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            run_silver(spark, layers)
    before = spark.read.json(layers.quarantine).count()
    write_document(inbox / "second.json", [day(1, vehicle_id=None)])
    run_bronze(spark, str(inbox), layers, "2024-03-06")
    run_silver(spark, layers)
    rejected = spark.read.json(layers.quarantine)
    assert rejected.count() == before + 1
    # What could not be read can be traced: its text and its file.
    lost = rejected.filter("unreadable is not null").first()
    assert lost.source_file.endswith("bad.json") and lost.unreadable


def test_batches_are_listed_without_opening_a_file(spark, inbox, layers):
    run_bronze(spark, str(inbox), layers, "2024-03-05")
    names = jobs_module().landed_batches(spark, layers.bronze)
    assert len(names) == 1 and names[0].startswith("2024-03-05/b")
    assert jobs_module().landed_batches(spark, layers.bronze, ["2024-03-06"]) == []
    run_silver(spark, layers)
    days = loaded_dates(spark, layers.silver)
    assert "FileScan" not in days._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.date for r in days.collect()) == sorted({r.date for r in read_silver(spark, layers.silver).collect()})


def jobs_module():
    import roadstrata.plans.jobs as jobs

    return jobs


def test_silver_overwrite_touches_only_its_days(spark, tmp_path):
    out = str(tmp_path / "t")
    df = lambda *r: spark.createDataFrame(list(r), "v int, date string")
    write_silver(df((1, "d1"), (2, "d2")), out)
    write_silver(df((9, "d2")), out, mode="overwrite")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "d1"), (9, "d2")]


def test_silver_reader_prunes_partitions_and_columns(spark, silver, tmp_path):
    out = str(tmp_path / "pruned")
    write_silver(silver, out)
    some = read_silver(spark, out, dates=["2024-03-04"], columns=["vehicle_id"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 7
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<vehicle_id:string>" in plan


def test_quarantine_guard(spark, tmp_path):
    empty = spark.createDataFrame([], "x int")
    assert not write_quarantine(empty, str(tmp_path / "q"), skip_empty=True)
    assert not (tmp_path / "q").exists()
    assert write_quarantine(empty, str(tmp_path / "q"))
