"""The fact table and its rollup."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from roadstrata.functions.keys import derived_key, same_zero
from roadstrata.functions.measures import CONGESTION_SCORES, narrow, ordinal
from roadstrata.functions.times import floor_time_key, time_key
from roadstrata.operators.lookup import hot_keys, lookup_key
from roadstrata.schema import SILVER_KEYS


@dataclass(frozen=True)
class Role:
    """A foreign key of the fact: which dimension, under what name, matched on what.

    `on` maps the dimension's business key, in its order, to flat columns.
    """

    dim: str
    key: str
    alias: str
    on: Mapping[str, str]
    as_float: tuple[str, ...] = ()

    def values(self) -> dict[str, Column]:
        return {
            member: same_zero(F.col(column)) if member in self.as_float else F.col(column)
            for member, column in self.on.items()
        }


# The foreign keys of the fact and the columns they are matched on.
ROLES = (
    Role("dim_vehicle", "vehicle_sk", "vehicle_sk", {"license_number": "license_number"}),
    Role(
        "dim_owner",
        "owner_sk",
        "owner_sk",
        {"owner_name": "owner_name", "phone": "phone", "email": "email"},
    ),
    Role(
        "dim_location",
        "location_sk",
        "cur_location_sk",
        {"street": "road_street", "district": "road_district", "city": "road_city"},
    ),
    Role(
        "dim_location",
        "location_sk",
        "dest_location_sk",
        {
            "street": "destination_street",
            "district": "destination_district",
            "city": "destination_city",
        },
    ),
    Role(
        "dim_weather",
        "weather_sk",
        "weather_sk",
        {
            "weather_condition": "weather_condition",
            "temperature": "temperature",
            "humidity": "humidity",
        },
        as_float=("temperature", "humidity"),
    ),
)

# Flat columns that the dimensions and the fact read; the rest never leaves the files.
GOLD_INPUT = [
    *SILVER_KEYS,
    "date",
    *[column for role in ROLES for column in role.on.values()],
    "vehicle_type", "vehicle_classification", "vehicle_length", "vehicle_width", "vehicle_height",
    "speed_kmph", "rpm", "fuel_level_percentage", "passenger_count",
    "congestion_level", "estimated_delay_minutes", "eta",
]


def measures() -> list[Column]:
    return [
        narrow("speed_kmph", "float"),
        narrow("rpm", "int"),
        narrow("fuel_level_percentage", "float"),
        narrow("passenger_count", "int"),
        ordinal("congestion_level", CONGESTION_SCORES).alias("congestion_score"),
        narrow("estimated_delay_minutes", "int"),
        F.col("eta").alias("destination_eta"),
    ]


def hot_members(silver: DataFrame, tasks: int) -> dict[str, dict[int, int]]:
    """The hot keys of all foreign keys of the fact, found in one pass over their columns."""
    return hot_keys(silver, {r.alias: list(r.values().values()) for r in ROLES}, tasks)


def fact_traffic(
    silver: DataFrame,
    dims: Mapping[str, DataFrame] | None = None,
    null_safe: bool = False,
    keep: tuple[str, ...] = (),
    hot: Mapping[str, Mapping[int, int]] | None = None,
) -> DataFrame:
    """One fact per flat row, with the keys of its dimension members.

    With `dims`, keys are looked up: five left joins, whatever keys the dimensions
    hold. Without, they are computed from the row itself, which gives the same
    fact for hash-keyed dimensions built from this flat table, as a map-only plan:
    at scale that saves five shuffles of the widest table.
    `hot`, as `hot_members` gives it, has the lookups cut hot keys into pieces.
    """
    fact = silver
    if dims is None:
        fact = fact.withColumns(
            {r.alias: derived_key(list(r.values().values()), null_safe) for r in ROLES}
        )
    else:
        for role in ROLES:
            fact = lookup_key(
                fact, dims[role.dim], role.values(), role.key, role.alias, null_safe,
                spread_by=SILVER_KEYS, hot=(hot or {}).get(role.alias),
            )
    return fact.select(
        F.col("vehicle_id").alias("traffic_vehicle_id"),
        *[role.alias for role in ROLES],
        time_key("timestamp").alias("time_sk"),
        *measures(),
        *keep,
    )


def traffic_rollup(fact: DataFrame, grain: str = "second") -> DataFrame:
    """Mean speed and congestion and the number of records per current location and time.

    A null location is a group of its own. Only partial sums are shuffled, so a
    busy location costs no more than a quiet one.
    """
    return (
        fact.select(
            "cur_location_sk",
            floor_time_key("time_sk", grain).alias("time_sk"),
            "speed_kmph",
            "congestion_score",
            "traffic_vehicle_id",
        )
        .groupBy("cur_location_sk", "time_sk")
        .agg(
            F.avg("speed_kmph").alias("avg_speed"),
            F.avg("congestion_score").alias("avg_congestion"),
            F.count("traffic_vehicle_id").alias("traffic_count"),
        )
    )
