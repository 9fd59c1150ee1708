"""The command line, run in the session of the tests."""

import datetime as dt

import pytest

from roadstrata.__main__ import arguments, run, serving_target
from tests.records import record, write_document


def test_three_jobs_in_a_row(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "lake")
    inbox.mkdir()
    write_document(inbox / "a.json", [record(), record(speed_kmph=-1.0)])
    do = lambda *argv: run(spark, arguments(["--root", root, *argv])).rows()
    assert do("bronze", "--source", str(inbox), "--ingest-date", "2024-03-05")["manifest"] == 1
    silver = do("silver", "--cluster-by", "road_district", "timestamp", "--cache")
    assert (silver["rows_invalid"], silver["silver"]) == (1, 1)
    gold = do("gold", "--calendar", "2024-03-01T00:00", "2024-03-01T23:59", "--cache", "--flat-fact")
    assert gold["dim_time"] == 1440 and gold["fact_traffic"] == gold["dim_vehicle"] == 1
    stages = {r.stage for r in spark.read.parquet(f"{root}/metrics").collect()}
    assert {"land", "quarantine", "silver", "dim_time", "fact_traffic_minute_agg"} <= stages


def test_arguments():
    args = arguments(["--root", "s3a://lake", "gold", "--dates", "2024-03-01", "--grain", "minute"])
    assert args.dates == [dt.date(2024, 3, 1)] and args.grain == "minute" and args.resolve == "derive"
    with pytest.raises(SystemExit):
        arguments(["gold"])


def test_serving_target_from_the_environment():
    assert serving_target({}) is None
    target = serving_target({"ROADSTRATA_JDBC_URL": "jdbc:x", "ROADSTRATA_JDBC_DRIVER": "d"})
    assert target.options("t")["driver"] == "d" and "user" not in target.options("t")
