"""What files weigh, how many records share one, and how wide shuffles start."""

import json
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from queries import catalog, telemetry_view
from roadstrata.plans import jobs
from roadstrata.schema import CORRUPT
from roadstrata.sinks import silver as silver_sink
from roadstrata.sinks.bronze import land_bronze
from roadstrata.sinks.silver import write_quarantine
from roadstrata.sources.documents import read_documents
from roadstrata.sources.files import list_inputs
from roadstrata.sources.telemetry import read_records, read_telemetry
from roadstrata.workspace import SHUFFLE_WIDTH, SMALLEST, bytes_under, evenly_cut, few_partitions, materialize_at, path_exists, session_setting
from tests.records import record


@pytest.fixture
def fresh(monkeypatch):
    monkeypatch.setattr(catalog, "_stored", {})


@pytest.mark.parametrize("build", [catalog.raw_files, catalog.damaged_files])
def test_raw_files_are_packed_and_hold_a_bounded_number_of_records(spark, sf_dir, fresh, monkeypatch, build):
    monkeypatch.setattr(catalog, "RECORDS_PER_FILE", 500)
    path = build(spark, sf_dir)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    text = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert bytes_under(spark, path) < text / 4
    held = [r["count"] for r in lines.groupBy("file").count().collect()]
    assert max(held) <= 500 and sum(held) == catalog.telemetry(spark, sf_dir).count()


def test_documents_are_joined_where_their_records_are(spark, tmp_path):
    """No record is lost at the end of a task, and files stay small; one plain and one packed folder are read alike."""
    texts = spark.range(0, 23, 1, 3).select(F.concat(F.lit('{"vehicle_id": "V'), "id", F.lit('"}')).alias("record"))
    for name, how in (("plain", {}), ("packed", catalog.PACKED)):
        catalog.write_documents(texts, str(tmp_path / name), 5, ("[ ", ", ", " ]"), how)
        documents = [json.loads(r.value) for r in spark.read.text(str(tmp_path / name)).collect()]
        assert sorted(len(d) for d in documents) == [2, 3, 3, 5, 5, 5]
        assert sorted(r["vehicle_id"] for d in documents for r in d) == sorted(f"V{i}" for i in range(23))
    assert read_documents(spark, str(tmp_path / "*")).groupBy("vehicle_id").count().filter("count = 2").count() == 23
    assert {r.file_name.rpartition("-")[2].partition(".")[2] for r in list_inputs(spark, str(tmp_path), "*.txt*").collect()} == {"c000.txt", "c000.txt.gz"} or \
        list_inputs(spark, str(tmp_path), "*.txt.gz").count() > 0


def test_landed_records_are_packed_and_not_sorted_by_their_batch(spark, tmp_path):
    (tmp_path / "in.json").write_text("".join(json.dumps(record(vehicle_id=f"V{i}")) + "\n" for i in range(50)) + "{\n")
    land_bronze(read_records(spark, str(tmp_path / "in.json")), str(tmp_path / "out"), "2024-01-01", "b", rebalance=False)
    files = list((tmp_path / "out" / "ingest_date=2024-01-01" / "batch=b").glob("*.parquet"))
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    landed = spark.read.parquet(str(tmp_path / "out"))
    assert landed.count() == 51 and landed.filter(F.col(CORRUPT).isNotNull()).count() == 1


def test_more_partitions_than_a_task_writes_at_once(spark, tmp_path):
    rows = spark.range(0, 400, 1, 2).withColumn("p", F.col("id") % 40)
    with few_partitions(spark, 16):
        rows.write.partitionBy("p").json(str(tmp_path / "t"))
    assert spark.read.json(str(tmp_path / "t")).groupBy("p").count().filter("count = 10").count() == 40


def test_quarantine_is_packed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(silver_sink, "ROWS_PER_FILE", 10)
    rows = spark.range(0, 95, 1, 1).select("id", F.array(F.lit("eta")).alias("failed_rules"), (F.col("id") % 2).alias("batch"))
    for columns, path in (((), "flat"), (("batch",), "by_batch"), (("batch",), "by_batch")):
        write_quarantine(rows, str(tmp_path / path), columns)
        files = list((tmp_path / path).rglob("part-*"))
        assert all(f.name.endswith(".json.gz") for f in files) and len(files) == 10
        stored = spark.read.json(str(tmp_path / path))
        assert sorted(r.id for r in stored.select("id").collect()) == list(range(95))


def test_shuffles_of_the_joined_tables_are_as_wide_as_their_files_ask(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(telemetry_view, "BYTES_PER_TASK", 1000)
    big = bytes_under(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet")
    with session_setting(spark, SHUFFLE_WIDTH, "1"):
        telemetry_view.telemetry(spark, sf_dir)
        assert int(spark.conf.get(SHUFFLE_WIDTH)) == -(-big // 1000)


def test_only_the_big_tables_are_shuffled_and_before_anything_is_looked_up(spark, sf_dir, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    few = telemetry_view.telemetry(spark, sf_dir)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert plan.rindex("BroadcastHashJoin [l_partkey") < plan.index("SortMergeJoin [l_orderkey")
    # Tables that are too big are joined while the rows are narrow; the places are still sent.
    monkeypatch.setattr(telemetry_view, "LOOKUP_BYTES", 0)
    wide = telemetry_view.telemetry(spark, sf_dir)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and plan.index("SortMergeJoin [l_orderkey") < plan.index("SortMergeJoin [l_partkey")
    assert "BroadcastHashJoin [c_nationkey" in plan and "BroadcastHashJoin [s_nationkey" in plan
    assert few.exceptAll(wide).isEmpty() and wide.exceptAll(few).isEmpty() and few.count() > 0


def test_plain_documents_weigh_little_beside_the_packed_ones(spark, sf_dir, fresh):
    path = catalog.pretty_documents(spark, sf_dir)
    held = {n: read_documents(spark, f"{path}/{n}").count() for n in ("plain", "packed")}
    assert held["plain"] > 0 and sum(held.values()) == catalog.telemetry(spark, sf_dir).count()
    assert bytes_under(spark, f"{path}/plain") < 0.25 * bytes_under(spark, f"{path}/packed")


def test_stored_readings_are_deleted_once_their_files_are_written(spark, sf_dir, fresh, monkeypatch):
    rows, there = [], []
    monkeypatch.setattr(catalog, "materialize_at", lambda df, path, **how: there.append(path) or materialize_at(df, path, **how))
    monkeypatch.setattr(catalog, "run_bronze", lambda spark, source, *a, **k: rows.append(spark.read.option("recursiveFileLookup", "true").text(source).count()))
    for job in ("run_silver", "run_gold"):
        monkeypatch.setattr(catalog, job, lambda *a, **k: None)
    catalog.lake_by_day(spark, sf_dir)
    assert 0 < rows[0] < rows[1] == catalog.telemetry(spark, sf_dir).count()
    assert len(there) == 1 and not path_exists(spark, there[0])


def test_shuffle_files_are_deleted_once_their_rows_are_written(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n for n in blocks.getAllFiles().mkString(" ").split() if "/shuffle_" in n}
    rows = spark.range(0, 2000, 1, 4).repartition(4, "id").select("id", F.array(F.lit("eta")).alias("failed_rules"))
    text = rows.select(F.col("id").cast("string").alias("record"))
    days = rows.withColumn("date", F.lit("2024-01-01"))
    writes = {
        "records": lambda p: catalog.write_records(rows, p),
        "documents": lambda p: catalog.write_documents(text, p, 50, ("[", ",", "]"), catalog.PACKED),
        "table": lambda p: materialize_at(rows, p),
        "quarantine": lambda p: write_quarantine(rows, p),
        "silver": lambda p: silver_sink.write_silver(days, p),
        "bronze": lambda p: land_bronze(rows, p, "2024-01-01", "b"),
    }
    for name, write in writes.items():
        before = shuffled()
        write(str(tmp_path / name))
        # They are deleted in the background.
        until = time.time() + 20
        while shuffled() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled() - before, name
    assert rows.count() == 2000 and spark.read.parquet(str(tmp_path / "bronze")).count() == 2000


def test_merges_join_the_tables_once(spark, sf_dir, fresh, monkeypatch):
    calls = []
    monkeypatch.setattr(catalog, "telemetry", lambda *a: calls.append(a) or telemetry_view.telemetry(*a))
    kept = catalog.silver_merge_late(spark, sf_dir).count()
    assert kept == catalog.silver_merge(spark, sf_dir).count() == catalog.silver_merge_null_day(spark, sf_dir).count() > 0
    assert len(calls) == 1


def test_records_are_packed_closer_than_at_the_fastest_level(spark, sf_dir, tmp_path):
    records = catalog.nested(catalog.telemetry(spark, sf_dir)).coalesce(1)
    fastest = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    catalog.write_records(records, str(tmp_path / "own"))
    records.write.options(**fastest).json(str(tmp_path / "fastest"))
    assert bytes_under(spark, str(tmp_path / "own")) < 0.8 * bytes_under(spark, str(tmp_path / "fastest"))
    own, other = (spark.read.text(str(tmp_path / name)) for name in ("own", "fastest"))
    assert own.exceptAll(other).isEmpty() and other.exceptAll(own).isEmpty()


def test_landed_texts_are_packed_closer_than_at_the_codecs_own_level(spark, sf_dir, tmp_path):
    catalog.write_records(catalog.nested(catalog.telemetry(spark, sf_dir)).coalesce(1), str(tmp_path / "in"))
    raw = read_records(spark, str(tmp_path / "in"))
    land_bronze(raw, str(tmp_path / "own"), "2024-01-01", "b", rebalance=False)
    raw.write.options(compression="zstd").parquet(str(tmp_path / "plain"))
    weight = {n: sum(pq.ParquetFile(f).metadata.row_group(0).column(i).total_compressed_size
                     for f in (tmp_path / n).rglob("*.parquet") for i in range(pq.ParquetFile(f).metadata.num_columns)
                     if pq.ParquetFile(f).schema.column(i).name == "payload") for n in ("own", "plain")}
    assert 0 < weight["own"] < 0.95 * weight["plain"]


def test_raw_files_are_written_from_slices_that_hold_each_reading_once(spark, sf_dir, fresh, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    whole = telemetry_view.telemetry(spark, sf_dir)
    assert len(telemetry_view.telemetry_in_slices(spark, sf_dir)) == 1
    monkeypatch.setattr(telemetry_view, "SLICE_BYTES", 60_000)
    slices = telemetry_view.telemetry_in_slices(spark, sf_dir)
    assert 1 < len(slices) < telemetry_view.SLICES
    held = [s.count() for s in slices]
    assert min(held) > 0 and max(held) < 0.6 * sum(held)
    joined = slices[0]
    for other in slices[1:]:
        joined = joined.unionAll(other)
    assert whole.exceptAll(joined).isEmpty() and joined.exceptAll(whole).isEmpty()
    # Neither big table is shuffled beyond the slice.
    plan = slices[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("pmod(xxhash64(l_orderkey") >= 1 and plan.count("pmod(xxhash64(o_orderkey") >= 1
    written = []
    monkeypatch.setattr(catalog, "write_records", lambda records, path, write=catalog.write_records: written.append(path) or write(records, path))
    raw = spark.read.text(catalog.raw_files(spark, sf_dir))
    assert len(written) == len(slices) and raw.count() == whole.count()
    monkeypatch.setattr(telemetry_view, "SLICE_BYTES", 1)
    assert len(telemetry_view.telemetry_in_slices(spark, sf_dir)) == telemetry_view.SLICES


def test_landed_files_of_the_jobs_are_deleted_and_rejected_rows_come_last(spark, sf_dir, fresh, monkeypatch):
    calls = []
    monkeypatch.setattr(catalog, "write_records", lambda records, path, write=catalog.write_records: calls.append(path) or write(records, path))
    monkeypatch.setattr(catalog, "run_gold", lambda *a, **k: None)
    for name in ("merge_partitions", "write_quarantine"):
        own = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda *a, name=name, own=own, **k: calls.append(name) or own(*a, **k))
    layers, silver_run, _ = catalog.lake(spark, sf_dir)
    assert calls[1:] == ["merge_partitions", "write_quarantine"] and not path_exists(spark, calls[0])
    assert spark.read.parquet(layers.bronze).count() == silver_run.rows()["rows_total"] == catalog.telemetry(spark, sf_dir).count()


def test_only_late_readings_wait_as_a_table(spark, sf_dir, fresh, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "materialize_at", lambda df, path, **how: stored.append(df.count()) or materialize_at(df, path, **how))
    for job in ("run_bronze", "run_silver", "run_gold"):
        monkeypatch.setattr(catalog, job, lambda *a, **k: None)
    catalog.lake_by_day(spark, sf_dir)
    assert 0 < stored[0] < 0.1 * catalog.telemetry(spark, sf_dir).count()


def test_files_that_come_in_even_splits_are_landed_without_a_shuffle(spark, tmp_path):
    lines = spark.range(0, 1600, 1, 16).select(F.concat(F.lit('{"vehicle_id": "V'), "id", F.lit('"}')).alias("value"))
    lines.write.options(**SMALLEST).text(str(tmp_path / "even"))
    with session_setting(spark, "spark.sql.files.openCostInBytes", str(1 << 30)):
        raw = read_telemetry(spark, str(tmp_path / "even"), multiline=False)
        assert evenly_cut(raw)
        land_bronze(raw, str(tmp_path / "out"), "2024-01-01", "b")
        assert len(list((tmp_path / "out").rglob("*.parquet"))) == 16
        assert spark.read.parquet(str(tmp_path / "out")).select("vehicle_id").distinct().count() == 1600
        # A file that is much bigger than the others, few files, and rows whose tasks are not known yet are spread.
        (tmp_path / "uneven").mkdir()
        for i in range(16):
            (tmp_path / "uneven" / f"{i}.json").write_text(json.dumps([record()] * (1 if i else 100)))
        assert not evenly_cut(read_telemetry(spark, str(tmp_path / "uneven")))
        assert not evenly_cut(read_telemetry(spark, str(tmp_path / "uneven" / "1.json")))
        assert not evenly_cut(raw.repartition(16)) and not evenly_cut(spark.range(0, 100, 1, 16)) and not evenly_cut(spark.createDataFrame([], "a int"))
