"""The given tables seen as telemetry: one reading per line item.

The column texts are plain SQL that Spark and DuckDB both read, so the query side and
the checking side start from the same input; everything after it is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstrata.workspace import SHUFFLE_WIDTH, bytes_under, shuffle_width

#: Bytes of the two big tables to a shuffle partition: its rows take some thirty times that where they are sorted.
BYTES_PER_TASK = 4 << 20
#: Bytes of a table's files up to which it is sent whole to every executor, where it takes some six times that.
LOOKUP_BYTES = 20 << 20
#: Bytes of the two big tables whose readings are written at a time, and the most times that their files are gone through.
SLICE_BYTES, SLICES = 16 << 20, 8

TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region")

# Flat column -> expression over the joined tables.
COLUMNS = {
    "vehicle_id": "concat('V', cast(l_partkey % 20 as varchar(20)))",
    "owner_name": "c_name",
    "license_number": "concat('L', cast(l_partkey % 200 as varchar(20)))",
    "phone": "nullif(cast(c_nationkey as varchar(20)), '0')",
    "email": "lower(c_mktsegment)",
    "vehicle_type": "p_type",
    "vehicle_classification": "p_brand",
    "speed_kmph": "l_quantity * cast(6.5 as double)",
    "road_street": "nullif(concat('S', cast(c_custkey % 3 as varchar(20))), 'S2')",
    "road_district": "c_nation",
    "road_city": "c_region",
    "timestamp": "o_orderdate + l_linenumber * interval '17' second",
    "date": "cast(o_orderdate as date)",
    "vehicle_length": "cast(case when p_size = 50 then -1 else p_size end as double)",
    "vehicle_width": "cast(p_size as double) / 2",
    "vehicle_height": "cast(p_size as double) / 4",
    "latitude": "s_acctbal / 100",
    "longitude": "c_acctbal / 50",
    "rpm": "cast(floor(o_totalprice / 100) as bigint)",
    "oil_pressure": "l_linestatus",
    "is_running": "l_linestatus = 'O'",
    "fuel_level_percentage": "cast(round(abs(l_discount) * 1000) as bigint)"
    " + case when l_linenumber = 7 then 5 else 0 end",
    "weather_condition": "l_returnflag",
    "temperature": "abs(l_tax) * 500",
    "humidity": "abs(l_discount) * 1000",
    "destination_street": "nullif(concat('S', cast(s_suppkey % 3 as varchar(20))), 'S2')",
    "destination_district": "s_nation",
    "destination_city": "s_region",
    "eta": "l_shipdate",
    "congestion_level": "case o_orderpriority when '1-URGENT' then 'Heavy' when '2-HIGH' then 'High'"
    " when '3-MEDIUM' then 'Moderate' when '5-LOW' then 'Low' end",
    "estimated_delay_minutes": "cast(l_linenumber * 3 as bigint)",
    "passenger_count": "cast(l_linenumber - 1 as bigint)",
    "internal_temperature_celsius": "cast(p_size as double) + 10",
}

# Orders rows of equal (vehicle_id, timestamp), together a total order.
TIE_BREAK = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
)

TIMESTAMPS = ("timestamp", "eta")

# One alert for returned items, none for the rest; Spark only.
ALERTS = """
    case when l_returnflag = 'R'
         then array(named_struct('type', 'return', 'description', l_linestatus,
                                 'severity', 'low', 'timestamp', cast(l_shipdate as string)))
         else cast(array() as array<struct<type: string, description: string,
                                           severity: string, timestamp: string>>)
    end
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings plus the tie-break columns.

    Only lineitem and orders must be shuffled, and what is looked up in the smaller tables is added after that, so that it is not shuffled
    too; a table that is too big to be sent to every executor is joined before, while the rows are narrow. Nations are sent in any
    case: Spark takes the product of both sizes for that of their join with the regions. The width of the
    shuffles follows the big tables' files, as that of the jobs does: with a fixed one tasks grow with the tables, and sorts spill.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    big = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders")]
    spark.conf.set(SHUFFLE_WIDTH, str(shuffle_width(spark, *big, bytes_per_task=BYTES_PER_TASK)))
    read = {name: table(spark, sf_dir, name) for name in TABLES}
    places = read["nation"].join(F.broadcast(read["region"]), F.col("n_regionkey") == F.col("r_regionkey"))

    def with_place(df: DataFrame, nation_key: str, prefix: str) -> DataFrame:
        named = places.select(
            F.col("n_nationkey").alias(f"{prefix}_place"),
            F.col("n_name").alias(f"{prefix}_nation"),
            F.col("r_name").alias(f"{prefix}_region"),
        )
        return df.join(F.broadcast(named), F.col(nation_key) == F.col(f"{prefix}_place"))

    small = {n for n in ("part", "supplier", "customer") if bytes_under(spark, f"{sf_dir}/{n}.parquet") <= LOOKUP_BYTES}

    def looked_up(df: DataFrame, name: str, key: str, own: str, wanted: bool) -> DataFrame:
        if (name in small) != wanted:
            return df
        other = F.broadcast(read[name]) if name in small else read[name]
        return df.join(other, F.col(key) == F.col(own))

    lines = looked_up(read["lineitem"], "part", "l_partkey", "p_partkey", False)
    lines = looked_up(lines, "supplier", "l_suppkey", "s_suppkey", False)
    bought = looked_up(read["orders"], "customer", "o_custkey", "c_custkey", False)
    joined = lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    for name, key, own in (("part", "l_partkey", "p_partkey"), ("supplier", "l_suppkey", "s_suppkey"), ("customer", "o_custkey", "c_custkey")):
        joined = looked_up(joined, name, key, own, True)
    joined = with_place(with_place(joined, "c_nationkey", "c"), "s_nationkey", "s")
    columns = [
        (F.expr(text).cast("timestamp") if name in TIMESTAMPS else F.expr(text)).alias(name)
        for name, text in COLUMNS.items()
    ]
    return joined.select(*columns, F.expr(ALERTS).alias("alerts"), *TIE_BREAK)


def telemetry_in_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All readings in parts by a hash of their order, for writes that go over one after the other.

    Each reading is in one part. A write's shuffle files are deleted as it ends, so beside what is written there are
    those of one part only. Every part scans the big tables again, which is little beside what is written, and at most SLICES times.
    """
    big = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders")]
    parts = min(SLICES, -(-bytes_under(spark, *big) // SLICE_BYTES))
    readings = telemetry(spark, sf_dir)
    if parts <= 1:
        return [readings]
    # Equal keys give the filter to orders too.
    own = F.pmod(F.xxhash64("l_orderkey"), F.lit(parts))
    return [readings.filter(own == part) for part in range(parts)]


NESTED = """
    struct(owner_name as name, license_number, struct(phone, email) as contact_info) as owner;
    struct(road_street as street, road_district as district, road_city as city) as road;
    struct(vehicle_length as length_meters, vehicle_width as width_meters,
           vehicle_height as height_meters) as vehicle_size;
    struct(latitude, longitude) as coordinates;
    struct(is_running, rpm, oil_pressure) as engine_status;
    struct(temperature as temperature_celsius, humidity as humidity_percentage,
           weather_condition as condition) as weather_condition;
    struct(struct(destination_street as street, destination_district as district,
                  destination_city as city) as destination, eta) as estimated_time_of_arrival;
    struct(congestion_level, estimated_delay_minutes) as traffic_status
"""

UNNESTED = (
    "vehicle_id", "speed_kmph", "timestamp", "vehicle_type", "vehicle_classification",
    "fuel_level_percentage", "passenger_count", "internal_temperature_celsius", "alerts",
)


def nested(flat: DataFrame, *extra: str) -> DataFrame:
    """Flat readings as nested records, the shape of the raw files."""
    return flat.selectExpr(*UNNESTED, *[part.strip() for part in NESTED.split(";")], *extra)


FROM_SQL = """
    from (select l.*, p.*, o.*, c.*, s.*, cn.n_name as c_nation, cr.r_name as c_region,
                 sn.n_name as s_nation, sr.r_name as s_region
          from lineitem l
          join part p on l_partkey = p_partkey
          join orders o on l_orderkey = o_orderkey
          join customer c on o_custkey = c_custkey
          join supplier s on l_suppkey = s_suppkey
          join nation cn on c_nationkey = cn.n_nationkey
          join region cr on cn.n_regionkey = cr.r_regionkey
          join nation sn on s_nationkey = sn.n_nationkey
          join region sr on sn.n_regionkey = sr.r_regionkey)
"""


def telemetry_sql() -> str:
    """The same view for DuckDB; the alerts by their number."""
    columns = ",\n       ".join(f"{text} as {name}" for name, text in COLUMNS.items())
    return (
        f"select {columns},\n       case when l_returnflag = 'R' then 1 else 0 end as n_alerts,\n"
        f"       p_size, {', '.join(TIE_BREAK)}\n{FROM_SQL}"
    )
