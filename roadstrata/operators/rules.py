"""Validation rules: named conditions, all of which a good row meets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

FAILED = "failed_rules"


class RuleSet:
    """Ordered name -> condition. A condition that comes out null counts as broken."""

    def __init__(self, rules: Mapping[str, Column]):
        if not rules:
            raise ValueError("a rule set needs at least one rule")
        self._rules = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}

    @property
    def names(self) -> list[str]:
        return list(self._rules)

    def __getitem__(self, name: str) -> Column:
        return self._rules[name]

    def passed(self) -> Column:
        return reduce(lambda a, b: a & b, self._rules.values())

    def failed(self) -> Column:
        """Names of the broken rules, in rule order; empty for a good row."""
        return F.array_compact(
            F.array(*[F.when(~rule, F.lit(name)) for name, rule in self._rules.items()])
        )

    def totals(self) -> list[Column]:
        """Aggregates: rows seen, rows valid and invalid, and rows breaking each rule."""
        return [
            F.count(F.lit(1)).alias("total"),
            F.count_if(self.passed()).alias("valid"),
            F.count_if(~self.passed()).alias("invalid"),
            *[F.count_if(~rule).alias(name) for name, rule in self._rules.items()],
        ]


def present(name: str) -> Column:
    return F.col(name).isNotNull()


def absent_or(name: str, condition: Column) -> Column:
    return F.col(name).isNull() | condition


def at_least_zero(name: str) -> Column:
    # NaN sorts above every number, so it passes a lower bound and fails an upper one.
    return absent_or(name, F.col(name) >= 0)


def within(name: str, low: float, high: float) -> Column:
    return absent_or(name, F.col(name).between(low, high))


def telemetry_rules() -> RuleSet:
    """The thirteen rules of the flat telemetry table."""
    speed = F.col("speed_kmph")
    # The limits of the rules.
    return RuleSet(
        {
            "vehicle_id": present("vehicle_id"),
            "timestamp": present("timestamp"),
            "road_street": present("road_street"),
            "road_district": present("road_district"),
            "speed": absent_or("speed_kmph", (speed >= 0) & (speed < 300)),
            "length": at_least_zero("vehicle_length"),
            "width": at_least_zero("vehicle_width"),
            "height": at_least_zero("vehicle_height"),
            "fuel": within("fuel_level_percentage", 0, 100),
            "passengers": at_least_zero("passenger_count"),
            "rpm": at_least_zero("rpm"),
            # Unlike the measures, the arrival time is required.
            "eta": present("eta") & (F.col("eta") >= F.col("timestamp")),
            "coordinates": within("latitude", -90, 90) & within("longitude", -180, 180),
        }
    )


def split(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): every row is in exactly one; invalid rows name the rules they broke."""
    valid = df.filter(rules.passed())
    invalid = df.filter(~rules.passed()).withColumn(FAILED, rules.failed())
    return valid, invalid


def validation_summary(df: DataFrame, rules: RuleSet) -> DataFrame:
    """(measure, rows): totals and the rows breaking each rule, from one pass."""
    wide = df.agg(*rules.totals())
    return wide.unpivot([], wide.columns, "measure", "rows")
