import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadstrata.operators.flatten import flatten
from roadstrata.schema import CORRUPT, FLAT_COLUMNS
from roadstrata.sources.files import append_ledger, batch_id, list_inputs, pending_files, read_ledger
from roadstrata.sources.telemetry import read_inferred, read_records, read_silver, read_telemetry
from tests.records import record, write_document, write_lines


def flat_row(spark, path, **kw):
    rows = flatten(read_telemetry(spark, path, **kw)).collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_good_record_flattens_to_34_columns(spark, tmp_path):
    row = flat_row(spark, write_document(tmp_path / "a.json", [record()]))
    assert list(row) == list(FLAT_COLUMNS) and len(row) == 34
    assert row["owner_name"] == "An" and row["phone"] == "090"
    assert str(row["timestamp"]) == "2024-03-01 08:15:30" and str(row["date"]) == "2024-03-01"
    assert row["destination_district"] == "D2" and row["latitude"] == 10.7
    assert row["alerts"][0]["timestamp"] == "08:15"


def test_null_parent_struct_gives_null_leaves(spark, tmp_path):
    rec = record(owner=None, estimated_time_of_arrival__destination=None)
    row = flat_row(spark, write_document(tmp_path / "a.json", [rec]))
    assert row["owner_name"] is None and row["phone"] is None and row["license_number"] is None
    assert row["destination_street"] is None and row["eta"] is not None


@pytest.mark.parametrize("alerts", [None, []])
def test_alerts_pass_through(spark, tmp_path, alerts):
    row = flat_row(spark, write_document(tmp_path / "a.json", [record(alerts=alerts)]))
    assert row["alerts"] == alerts


def test_bad_leaf_nulls_that_leaf_and_keeps_the_text(spark, tmp_path):
    rec = record(engine_status__rpm=2.5, fuel_level_percentage="3", speed_kmph="NaN")
    path = write_lines(tmp_path / "a.json", [rec])
    raw = read_telemetry(spark, path, multiline=False)
    row = flatten(raw, keep=[CORRUPT]).first().asDict()
    assert row["rpm"] is None and row["fuel_level_percentage"] is None
    assert row["speed_kmph"] != row["speed_kmph"]
    assert row["vehicle_id"] == "V1" and row["oil_pressure"] == "Normal"
    assert json.loads(row[CORRUPT]) == rec


def test_bad_timestamp_is_null(spark, tmp_path):
    path = write_lines(tmp_path / "a.json", [record(timestamp="not a time")])
    row = flat_row(spark, path, multiline=False)
    assert row["timestamp"] is None and row["date"] is None


def test_truncated_document_is_one_row_with_its_text(spark, tmp_path):
    cut = json.dumps([record(), record()])[:40]
    (tmp_path / "a.json").write_text(cut)
    rows = read_telemetry(spark, str(tmp_path / "a.json")).collect()
    assert len(rows) == 1 and rows[0][CORRUPT] == cut and rows[0]["vehicle_id"] is None


def test_empty_file_has_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    assert read_telemetry(spark, str(tmp_path / "a.json")).count() == 0


def test_glob_and_name_filter(spark, tmp_path):
    for day in ("d1", "d2"):
        (tmp_path / day).mkdir()
        write_document(tmp_path / day / "x.json", [record(vehicle_id=day)])
    (tmp_path / "d1" / "notes.txt").write_text("{}")
    by_glob = read_telemetry(spark, f"{tmp_path}/*/*.json")
    by_filter = read_telemetry(spark, f"{tmp_path}/*", name_filter="*.json")
    for raw in (by_glob, by_filter):
        assert sorted(r.vehicle_id for r in raw.collect()) == ["d1", "d2"]
        assert raw.select(F.regexp_extract("source_file", r"([^/]+)$", 1)).distinct().count() == 1


def test_inferred_schema_finds_nested_fields(spark, tmp_path):
    path = write_document(tmp_path / "a.json", [record(), record(passenger_count=3)])
    raw = read_inferred(spark, path)
    assert dict(raw.dtypes)["passenger_count"] == "bigint"
    assert raw.select("owner.contact_info.phone").first()[0] == "090"


def test_lines_split_and_documents_do_not(spark, tmp_path, settings):
    records = [record(vehicle_id=f"V{i}") for i in range(400)]
    lines = write_lines(tmp_path / "lines.json", records)
    document = write_document(tmp_path / "document.json", records)
    settings(spark__sql__files__maxPartitionBytes="32768", spark__sql__files__openCostInBytes="1024")
    assert read_telemetry(spark, lines, multiline=False).rdd.getNumPartitions() > 4
    assert read_telemetry(spark, document).rdd.getNumPartitions() == 1
    same = lambda p, m: {r.vehicle_id for r in read_telemetry(spark, p, m).collect()}
    assert same(lines, False) == same(document, True)


def test_listing_ledger_and_pending(spark, tmp_path):
    inbox, ledger = tmp_path / "in box", str(tmp_path / "ledger")
    inbox.mkdir()
    write_lines(inbox / "a.json", [record()])
    (inbox / "skip.csv").write_text("x")
    listing = list_inputs(spark, str(inbox))
    row = listing.first()
    assert listing.count() == 1 and row.file_name == "a.json"
    assert row.size_bytes == (inbox / "a.json").stat().st_size

    assert read_ledger(spark, ledger).count() == 0
    assert read_ledger(spark, ledger).columns == ["file_path", "processed_at"]
    append_ledger(listing, ledger, "2024-01-01")
    write_lines(inbox / "b.json", [record()])
    pending = pending_files(list_inputs(spark, str(inbox)), read_ledger(spark, ledger))
    assert [r.file_name for r in pending.collect()] == ["b.json"]
    # The same spelling as in a scan, and a path that a reader can open.
    read = read_telemetry(spark, [r.read_path for r in pending.collect()], multiline=False)
    assert read.join(pending, read.source_file == pending.file_path).count() == 1


def test_listing_reads_no_content(spark, tmp_path):
    write_lines(tmp_path / "a.json", [record()])
    plan = list_inputs(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_ledger_hides_only_a_missing_path(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_ledger(spark, str(tmp_path / "broken")).count()
    with pytest.raises(AnalysisException):
        read_silver(spark, str(tmp_path / "missing"))


def test_batch_id_ignores_order(spark):
    a = spark.createDataFrame([("x",), ("y",)], "file_path string")
    b = spark.createDataFrame([("y",), ("x",)], "file_path string")
    c = spark.createDataFrame([("x",)], "file_path string")
    assert batch_id(a) == batch_id(b) != batch_id(c)


def test_records_per_line_in_any_bracketing(spark, tmp_path):
    good = '{"vehicle_id": "%s", "owner": {"name": "n", "tier": 3}, "new_sensor": [1, 2]}'
    (tmp_path / "a.json").write_text("[\n" + ",\n".join(good % v for v in "ab") + "\n]\n")
    (tmp_path / "b.json").write_text(f"[{good % 'c'},\n  {good % 'd'} ,\n\n{good % 'e'}]")
    (tmp_path / "c.json").write_text("\n".join(good % v for v in "fg"))
    (tmp_path / "cut.json").write_text(f"[{good % 'h'},\n" + (good % "i")[:30])
    got = read_records(spark, str(tmp_path)).collect()
    assert sorted(r.vehicle_id for r in got if r._corrupt_record is None) == list("abcdefgh")
    bad = [r for r in got if r._corrupt_record is not None]
    assert [r.source_file.split("/")[-1] for r in bad] == ["cut.json"]
    assert all(json.loads(r.payload)["owner"]["tier"] == 3 for r in got if r._corrupt_record is None)


def test_a_document_of_lines_is_split(spark, tmp_path, settings):
    line = '{"vehicle_id": "a", "speed_kmph": 1.0}'
    (tmp_path / "big.json").write_text("[\n" + ",\n".join([line] * 20_000) + "\n]")
    settings(spark__sql__files__maxPartitionBytes="65536")
    df = read_records(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 4
    assert df.filter("vehicle_id = 'a' and _corrupt_record is null").count() == df.count() == 20_000


def test_lines_lose_only_what_stands_around_a_record_and_few_meet_an_expression(spark, tmp_path):
    ends = ["", ",", "]", "],", ", ]", "]\t,", ",\u2028", "\x85", " \x0b", "}", "},", "}]", "x,", "x]"]
    starts = ["", "[", "[ ", "[[", "\t[", "[x", ","]
    lines = [start + body + end for start in starts for body in ("", '{"vehicle_id": "[}]"}', "{", "é") for end in ends]
    (tmp_path / "in.json").write_text("\n".join(lines), newline="")
    line = F.trim("value")
    bare = F.regexp_replace(F.regexp_replace(line, r"^\[\s*(?=\{|$)", ""), r"(?:^|(?<=\}))\s*[,\]]+\s*$", "")
    wanted = spark.read.text(str(tmp_path)).select(bare.alias("payload")).filter("payload <> ''")
    read = read_records(spark, str(tmp_path)).select("payload")
    assert sorted(r.payload for r in read.collect()) == sorted(r.payload for r in wanted.collect())
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "THEN regexp_replace" in plan and "regexp_replace" not in plan.replace("THEN regexp_replace", "")
