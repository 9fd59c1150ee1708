"""Time keys and calendar columns, all in the session zone (UTC by default)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The calendar range used when none is given.
CALENDAR_START = dt.datetime(2024, 1, 1, 0, 0, tzinfo=dt.timezone.utc)
CALENDAR_END = dt.datetime(2024, 6, 30, 23, 59, tzinfo=dt.timezone.utc)

GRAIN_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def time_key(ts: Column | str) -> Column:
    """Unix seconds as INT; null past 2038 rather than a failed job."""
    return F.unix_timestamp(_col(ts)).try_cast("int")


def hour_key(ts: Column | str) -> Column:
    """yyyyMMddHH as INT."""
    return F.date_format(_col(ts), "yyyyMMddHH").cast("int")


def floor_time_key(key: Column | str, grain: str) -> Column:
    """Round a unix-seconds key down to a second, minute or hour."""
    key = _col(key)
    size = GRAIN_SECONDS[grain]
    return key if size == 1 else key - F.pmod(key, F.lit(size))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """Columns of the time dimension for one timestamp column."""
    ts = _col(ts)
    # Names and formats of the calendar columns.
    return {
        "time_sk": time_key(ts),
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "year": F.year(ts),
        "month": F.month(ts),
        "month_name": F.date_format(ts, "MMMM"),
        "day": F.dayofmonth(ts),
        "day_of_week": F.dayofweek(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
    }


def minute_calendar(
    spark: SparkSession,
    start: dt.datetime = CALENDAR_START,
    end: dt.datetime = CALENDAR_END,
) -> DataFrame:
    """One row per minute from `start` to `end`, both included, generated by the executors.

    Naive datetimes are read as UTC.
    """
    first, last = (_epoch_minute(t) for t in (start, end))
    minutes = spark.range(first, last + 1).select(
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp")
    )
    return minutes.select("timestamp", *_named(calendar_columns("timestamp")))


def calendar_between(df: DataFrame, ts: str) -> DataFrame:
    """Minute calendar over the range of `ts`: two scalars set the bounds."""
    first, last = df.agg(
        F.unix_timestamp(F.min(ts)), F.unix_timestamp(F.max(ts))
    ).first()
    spark = df.sparkSession
    if first is None:
        return minute_calendar(spark).limit(0)
    utc = dt.timezone.utc
    return minute_calendar(
        spark, dt.datetime.fromtimestamp(first, utc), dt.datetime.fromtimestamp(last, utc)
    )


def observed_hours(df: DataFrame, ts: str) -> DataFrame:
    """Hour-grain time dimension holding just the hours that occur in `df`."""
    hours = df.select(F.date_trunc("hour", F.col(ts)).alias("h")).distinct()
    columns = calendar_columns("h")
    return hours.select(
        hour_key("h").alias("time_sk"),
        *_named({n: columns[n] for n in ("year", "month", "day", "hour", "day_of_week")}),
    )


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _epoch_minute(t: dt.datetime) -> int:
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() // 60)
