"""The dimensions of the star schema, each from the flat table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstrata.functions.keys import dense_key, hash_key, same_zero
from roadstrata.functions.times import CALENDAR_END, CALENDAR_START, minute_calendar
from roadstrata.operators.survivors import latest_per_key

# Constants of the location dimension.
POSTAL_CODE = "00700"
COUNTRY = "Vietnam"

OWNER_KEY = ["owner_name", "phone", "email"]
LOCATION_KEY = ["street", "district", "city"]
WEATHER_KEY = ["weather_condition", "temperature", "humidity"]
VEHICLE_KEY = ["license_number"]


def keyed(members: DataFrame, business_key: list[str], key: str, dense: bool = False) -> DataFrame:
    """Add the surrogate key: a hash of the business key, or 0..n-1 in its order."""
    if dense:
        return dense_key(members, business_key, key)
    return members.withColumn(key, hash_key([F.col(c) for c in business_key]))


def dim_time(
    spark: SparkSession, start: dt.datetime = CALENDAR_START, end: dt.datetime = CALENDAR_END
) -> DataFrame:
    return minute_calendar(spark, start, end)


def dim_owner(silver: DataFrame, dense: bool = False) -> DataFrame:
    return keyed(silver.select(*OWNER_KEY).distinct(), OWNER_KEY, "owner_sk", dense)


def latest_vehicles(silver: DataFrame, *within: str) -> DataFrame:
    """Latest attributes per license, with the time and id they are from. Rows of equal time are told apart
    by vehicle_id, which with the timestamp is unique in the flat table."""
    rows = silver.select(
        *within,
        "license_number",
        "vehicle_type",
        "vehicle_classification",
        *[F.col(c).cast("float").alias(c) for c in ("vehicle_length", "vehicle_width", "vehicle_height")],
        "timestamp",
        "vehicle_id",
    )
    return latest_per_key(rows, [*within, *VEHICLE_KEY], "timestamp", ties=["vehicle_id"])


def dim_vehicle(silver: DataFrame, dense: bool = False) -> DataFrame:
    newest = latest_vehicles(silver).drop("timestamp", "vehicle_id")
    return keyed(newest, VEHICLE_KEY, "vehicle_sk", dense)


def current_and_destination(silver: DataFrame, *within: str) -> DataFrame:
    """Current and destination places in one column set, repeats kept; one scan."""
    roles = [
        F.struct(*[F.col(f"{role}_{c}").alias(c) for c in LOCATION_KEY]) for role in ("road", "destination")
    ]
    return silver.select(*within, F.inline(F.array(*roles)))


def dim_location(
    silver: DataFrame, postal_code: str = POSTAL_CODE, country: str = COUNTRY, dense: bool = False
) -> DataFrame:
    """Places seen in either role. The constants are added after the distinct, not shuffled."""
    places = keyed(current_and_destination(silver).distinct(), LOCATION_KEY, "location_sk", dense)
    return places.select(
        *LOCATION_KEY,
        F.lit(postal_code).alias("postal_code"),
        F.lit(country).alias("country"),
        "location_sk",
    )


def weather_states(silver: DataFrame, *within: str) -> DataFrame:
    return silver.select(
        *within,
        "weather_condition",
        same_zero("temperature").alias("temperature"),
        same_zero("humidity").alias("humidity"),
    ).distinct()


def dim_weather(silver: DataFrame, dense: bool = False) -> DataFrame:
    return keyed(weather_states(silver), WEATHER_KEY, "weather_sk", dense)


DIMENSIONS = {
    "dim_owner": (dim_owner, "owner_sk"),
    "dim_vehicle": (dim_vehicle, "vehicle_sk"),
    "dim_location": (dim_location, "location_sk"),
    "dim_weather": (dim_weather, "weather_sk"),
}


def places_of_day(silver: DataFrame) -> DataFrame:
    """Each day's places, every one in both roles, so that they read like rows of the flat table."""
    places = current_and_destination(silver, "date").distinct()
    roles = [F.col(c).alias(f"{role}_{c}") for role in ("road", "destination") for c in LOCATION_KEY]
    return places.select("date", *roles)


#: The business key of each dimension.
BUSINESS_KEYS = {"dim_owner": OWNER_KEY, "dim_vehicle": VEHICLE_KEY, "dim_location": LOCATION_KEY, "dim_weather": WEATHER_KEY}

#: Each day's members, as rows of which the dimension is built as it is of the flat table: building from all days' members gives the same, so
#: when a day's rows change only its own members are found anew. Latest attributes carry the time they are from.
MEMBERS_OF_DAY = {
    "dim_owner": lambda rows: rows.select("date", *OWNER_KEY).distinct(),
    "dim_vehicle": lambda rows: latest_vehicles(rows, "date"),
    "dim_location": places_of_day,
    "dim_weather": lambda rows: weather_states(rows, "date"),
}
