import math

import pytest
from pyspark.sql import functions as F

from roadstrata.operators.flatten import flatten
from roadstrata.operators.rules import FAILED, RuleSet, split, telemetry_rules, validation_summary
from roadstrata.sources.telemetry import read_telemetry
from tests.records import record, write_lines

NAN = math.nan


@pytest.fixture(scope="module")
def good(spark, tmp_path_factory):
    path = write_lines(tmp_path_factory.mktemp("good") / "a.json", [record()])
    return flatten(read_telemetry(spark, path, multiline=False)).cache()


def broken(good, **values):
    """Rules broken by the good row with some columns replaced."""
    changed = good.withColumns(
        {name: F.lit(v).cast(good.schema[name].dataType) for name, v in values.items()}
    )
    return changed.select(telemetry_rules().failed()).first()[0]


@pytest.mark.parametrize(
    "column, value, rule",
    [
        ("vehicle_id", None, "vehicle_id"),
        ("road_street", None, "road_street"),
        ("road_district", None, "road_district"),
        ("road_city", None, None),
        ("speed_kmph", None, None),
        ("speed_kmph", 0.0, None),
        ("speed_kmph", -0.1, "speed"),
        ("speed_kmph", 299.9, None),
        ("speed_kmph", 300.0, "speed"),
        ("speed_kmph", NAN, "speed"),
        ("vehicle_length", None, None),
        ("vehicle_length", 0.0, None),
        ("vehicle_length", -1.0, "length"),
        ("vehicle_length", NAN, None),
        ("vehicle_width", -1.0, "width"),
        ("vehicle_width", NAN, None),
        ("vehicle_height", -1.0, "height"),
        ("vehicle_height", None, None),
        ("fuel_level_percentage", None, None),
        ("fuel_level_percentage", 0, None),
        ("fuel_level_percentage", 100, None),
        ("fuel_level_percentage", 101, "fuel"),
        ("fuel_level_percentage", -1, "fuel"),
        ("passenger_count", None, None),
        ("passenger_count", 0, None),
        ("passenger_count", -1, "passengers"),
        ("rpm", None, None),
        ("rpm", -1, "rpm"),
        ("eta", None, "eta"),
        ("eta", "2024-03-01 08:15:30", None),
        ("eta", "2024-03-01 08:15:29", "eta"),
        ("latitude", None, None),
        ("latitude", 90.0, None),
        ("latitude", 90.1, "coordinates"),
        ("latitude", NAN, "coordinates"),
        ("longitude", -180.0, None),
        ("longitude", -180.1, "coordinates"),
        ("longitude", NAN, "coordinates"),
    ],
)
def test_rule_edges(good, column, value, rule):
    assert broken(good, **{column: value}) == ([rule] if rule else [])


def test_null_timestamp_breaks_eta_too(good):
    assert broken(good, timestamp=None) == ["timestamp", "eta"]


def test_halves_partition_the_input_for_any_rule(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    rules = RuleSet({"small": F.col("x") < 2})
    valid, invalid = split(df, rules)
    assert [r.x for r in valid.collect()] == [1]
    assert sorted((r.x, r[FAILED]) for r in invalid.collect() if r.x) == [(3, ["small"])]
    assert invalid.count() == 2
    summary = {r["measure"]: r["rows"] for r in validation_summary(df, rules).collect()}
    assert summary == {"total": 3, "valid": 1, "invalid": 2, "small": 2}


def test_summary_of_nothing(good):
    summary = {r["measure"]: r["rows"] for r in validation_summary(good.limit(0), telemetry_rules()).collect()}
    assert summary["total"] == summary["invalid"] == summary["eta"] == 0


def test_rules_reach_the_scan(spark, good, tmp_path):
    good.write.parquet(str(tmp_path / "flat"))
    valid, _ = split(spark.read.parquet(str(tmp_path / "flat")), telemetry_rules())
    plan = valid.select("speed_kmph")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(vehicle_id)" in plan or "isnotnull(vehicle_id" in plan
    assert "alerts" not in plan.split("ReadSchema")[1]


def test_empty_rule_set_is_refused():
    with pytest.raises(ValueError):
        RuleSet({})
