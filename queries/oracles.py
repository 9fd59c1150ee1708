"""The same results in DuckDB SQL, written from the definitions and not from the Spark code."""

from __future__ import annotations

from queries.telemetry_view import COLUMNS, TIE_BREAK, telemetry_sql

FLAT = ", ".join(f'"{name}"' for name in COLUMNS) + ", n_alerts"

RULES = {
    "vehicle_id": "vehicle_id is not null",
    "timestamp": '"timestamp" is not null',
    "road_street": "road_street is not null",
    "road_district": "road_district is not null",
    "speed": "speed_kmph is null or (speed_kmph >= 0 and speed_kmph < 300)",
    "length": "vehicle_length is null or vehicle_length >= 0",
    "width": "vehicle_width is null or vehicle_width >= 0",
    "height": "vehicle_height is null or vehicle_height >= 0",
    "fuel": "fuel_level_percentage is null or fuel_level_percentage between 0 and 100",
    "passengers": "passenger_count is null or passenger_count >= 0",
    "rpm": "rpm is null or rpm >= 0",
    "eta": 'eta is not null and eta >= "timestamp"',
    "coordinates": "(latitude is null or latitude between -90 and 90)"
    " and (longitude is null or longitude between -180 and 180)",
}
ALL_RULES = " and ".join(f"({rule})" for rule in RULES.values())
FAILED_LIST = (
    "concat_ws(',', "
    + ", ".join(f"case when not ({rule}) then '{name}' end" for name, rule in RULES.items())
    + ")"
)
FAILED_COUNT = " + ".join(f"(case when not ({rule}) then 1 else 0 end)" for rule in RULES.values())


def key_sql(*parts: str) -> str:
    texts = [f"cast({part} as varchar)" for part in parts]
    lengths = [f"cast(coalesce(length({text}), -1) as varchar)" for text in texts]
    return f"cast('0x' || substr(md5(concat_ws('|', {', '.join(lengths + texts)})), 1, 15) as bigint)"


T = f"with t as ({telemetry_sql()})"
V = f"{T}, v as (select * from t where {ALL_RULES})"
C = f"""{V}, c as (
    select * from v
    qualify row_number() over (partition by vehicle_id, "timestamp" order by {', '.join(TIE_BREAK)}) = 1)"""

EARLY = C.replace("select * from v\n", "select * from v where weather_condition in ('A', 'N')\n")
OWNER = f"select distinct owner_name, phone, email, {key_sql('owner_name', 'phone', 'email')} as owner_sk from c"
PLACES = """
    select road_street as street, road_district as district, road_city as city from c
    union all
    select destination_street, destination_district, destination_city from c"""
LOCATION = f"""
    select street, district, city, '00700' as postal_code, 'Vietnam' as country,
           {key_sql('street', 'district', 'city')} as location_sk
    from (select distinct * from ({PLACES}))"""
WEATHER = f"""
    select weather_condition, temperature, humidity,
           {key_sql('weather_condition', 'temperature', 'humidity')} as weather_sk
    from (select distinct weather_condition, cast(temperature as float) as temperature,
                          cast(humidity as float) as humidity from c)"""
VEHICLE = f"""
    select license_number, vehicle_type, vehicle_classification,
           cast(vehicle_length as float) as vehicle_length,
           cast(vehicle_width as float) as vehicle_width,
           cast(vehicle_height as float) as vehicle_height,
           {key_sql('license_number')} as vehicle_sk
    from c
    qualify row_number() over (partition by license_number order by "timestamp" desc, vehicle_id) = 1"""


# The jobs read files, which hold no order numbers: there all columns settle a repeated key.
JOB_C = f"""{V}, c as (
    select * from v
    qualify row_number() over (partition by vehicle_id, "timestamp"
        order by {', '.join(f'"{name}" nulls first' for name in sorted(COLUMNS))}) = 1)"""


def fact_sql(equals: str) -> str:
    def match(pairs: dict[str, str]) -> str:
        return " and ".join(f"{left} {equals} {right}" for left, right in pairs.items())

    owner = match({f"c.{k}": f"o.{k}" for k in ("owner_name", "phone", "email")})
    current = match({f"c.road_{k}": f"cur.{k}" for k in ("street", "district", "city")})
    destination = match({f"c.destination_{k}": f"dest.{k}" for k in ("street", "district", "city")})
    weather = match(
        {
            "c.weather_condition": "w.weather_condition",
            "cast(c.temperature as float)": "w.temperature",
            "cast(c.humidity as float)": "w.humidity",
        }
    )
    vehicle = match({"c.license_number": "ve.license_number"})
    return f"""
    select c.vehicle_id as traffic_vehicle_id, ve.vehicle_sk, o.owner_sk,
           cur.location_sk as cur_location_sk, dest.location_sk as dest_location_sk, w.weather_sk,
           cast(floor(epoch(c."timestamp")) as integer) as time_sk,
           cast(cast(speed_kmph as float) as double) as speed_kmph,
           cast(rpm as integer) as rpm,
           cast(cast(fuel_level_percentage as float) as double) as fuel_level_percentage,
           cast(passenger_count as integer) as passenger_count,
           cast(case congestion_level when 'Low' then 1 when 'Moderate' then 2
                when 'High' then 3 when 'Heavy' then 4 else 0 end as integer) as congestion_score,
           cast(estimated_delay_minutes as integer) as estimated_delay_minutes,
           eta as destination_eta
    from c
    left join (select distinct * from dim_owner) o on {owner}
    left join dim_location cur on {current}
    left join dim_location dest on {destination}
    left join dim_weather w on {weather}
    left join dim_vehicle ve on {vehicle}"""


GOLD = (
    f"{C}, dim_owner as ({OWNER}), dim_location as ({LOCATION}), "
    f"dim_weather as ({WEATHER}), dim_vehicle as ({VEHICLE})"
)
POOLED = C.replace(", c as (", ", apart as (") + """, c as (
    select * replace (case when l_orderkey % 3 = 0 then 'Pool' else owner_name end as owner_name,
                      case when l_orderkey % 3 = 0 then '1' else phone end as phone,
                      case when l_orderkey % 3 = 0 then 'fleet' else email end as email) from apart)"""
FACT = f"{GOLD}, fact as ({fact_sql('=')})"
JOB_FACT = FACT.replace(C, JOB_C)


def rollup_sql(time_sk: str) -> str:
    return f"""
    select cur_location_sk, {time_sk} as time_sk, round(avg(speed_kmph), 6) as avg_speed,
           round(avg(congestion_score), 6) as avg_congestion,
           count(traffic_vehicle_id) as traffic_count
    from fact group by 1, 2"""


#: The day of a time key, which counts seconds in UTC.
FACT_DAY = "cast(make_timestamp(cast(time_sk as bigint) * 1000000) as date)"

SUMMARY = " union all ".join(
    f"select '{measure}' as measure, count(*) as rows from t where {condition}"
    for measure, condition in {
        "total": "true",
        "valid": ALL_RULES,
        "invalid": f"not ({ALL_RULES})",
        **{name: f"not ({rule})" for name, rule in RULES.items()},
    }.items()
)

COUNTS = " union all ".join(
    f"select '{name}' as table_name, count(*) as rows from {source}"
    for name, source in {
        "dim_owner": "dim_owner",
        "dim_vehicle": "dim_vehicle",
        "dim_location": "dim_location",
        "dim_weather": "dim_weather",
        "fact_traffic": "fact",
        "fact_traffic_minute_agg": f"({rollup_sql('time_sk')})",
    }.items()
)

JOB_STAGES = " union all ".join(
    f"select '{stage}' as stage, count(*) as rows from {source}"
    for stage, source in {
        "quarantine": f"t where not ({ALL_RULES})",
        "silver": "c",
        "rows_total": "t",
        "rows_valid": "v",
        "rows_invalid": f"t where not ({ALL_RULES})",
        **{f"rows_{name}": f"t where not ({rule})" for name, rule in RULES.items()},
        "dim_time": "(select unnest(generate_series(timestamp '2024-01-01 00:00',"
        " timestamp '2024-06-30 23:59', interval 1 minute)))",
        "dim_owner": "dim_owner",
        "dim_vehicle": "dim_vehicle",
        "dim_location": "dim_location",
        "dim_weather": "dim_weather",
        "fact_traffic": "fact",
        "fact_traffic_minute_agg": f"({rollup_sql('time_sk')})",
    }.items()
)

CALENDAR = """
    select ts as "timestamp", cast(epoch(ts) as integer) as time_sk,
           strftime(ts, '%Y-%m-%d') as "date", cast(year(ts) as integer) as "year",
           cast(month(ts) as integer) as "month", strftime(ts, '%B') as month_name,
           cast(day(ts) as integer) as "day", cast(dayofweek(ts) + 1 as integer) as day_of_week,
           cast(hour(ts) as integer) as "hour", cast(minute(ts) as integer) as "minute"
    from (select unnest(generate_series(date_trunc('minute', min(ts)), date_trunc('minute', max(ts)),
                                        interval 1 minute)) as ts from events)"""

HOURS = """
    select distinct cast(strftime("timestamp", '%Y%m%d%H') as integer) as time_sk,
           cast(year("timestamp") as integer) as "year",
           cast(month("timestamp") as integer) as "month",
           cast(day("timestamp") as integer) as "day",
           cast(hour("timestamp") as integer) as "hour",
           cast(dayofweek("timestamp") + 1 as integer) as day_of_week
    from c"""


def widened(table: str, floats: tuple[str, ...]) -> str:
    replaced = ", ".join(f"cast({name} as double) as {name}" for name in floats)
    return f"select * replace ({replaced}) from {table}"


ORACLES: dict[str, str] = {
    "flatten_nested": f"{T} select {FLAT} from t",
    "flatten_multiline": f"{T} select {FLAT} from t",
    "flatten_documents": f"{T} select {FLAT} from t",
    "flatten_alerts": f"{T} select vehicle_id, 'return' as type, oil_pressure as description, 'low' as severity,"
    " strftime(eta, '%Y-%m-%d %H:%M:%S') as raised from t where weather_condition = 'R'",
    "flatten_inferred": f"{T} select owner_name, email, road_district, destination_district, rpm,"
    " is_running, temperature from t",
    "props_parse": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "bronze_landing": f"{T} select p_size = 50 as malformed, count(*) as records,"
    " count(case when p_size <> 50 then vehicle_id end) as with_vehicle from t group by 1",
    "ingest_manifest": f"{T} select count(*) as malformed_records, cast(0 as bigint) as wrong_status,"
    " cast(0 as bigint) as wrong_size, cast(0 as bigint) as wrong_path from t where p_size = 50",
    "ingest_manifest_faults": f"{T} select 'good' as file, 'success' as status, false as with_error, count(*) as records from t"
    " union all select 'not-compressed.json.gz', 'failed', true, 0 union all select 'cut-off.json.gz', 'failed', true, 0",
    "bronze_payload_documents": f"{T} select passenger_count * 2 as reading, count(*) as records,"
    " cast(0 as bigint) as malformed from t group by 1",
    "bronze_payload": f"{T} select passenger_count * 2 as new_sensor, count(*) as records,"
    " cast(0 as bigint) as malformed from t group by 1",
    "pending_records": f"{T} select weather_condition, count(*) as records from t"
    " where weather_condition <> 'R' group by 1",
    "valid_rows": f"{V} select {FLAT} from v",
    "invalid_rows": f"{T} select {FLAT}, {FAILED_LIST} as failed_rules from t where not ({ALL_RULES})",
    "validation_summary": f"{T} {SUMMARY}",
    "quarantine_roundtrip": f"""{T}
        select "date", count(*) as rejected, cast(sum({FAILED_COUNT}) as bigint) as broken_rules,
               count(case when not ({RULES['eta']}) then 1 end) as eta_broken
        from t where not ({ALL_RULES}) group by 1""",
    "dedupe_latest": f"{C} select {FLAT} from c",
    "dedupe_documents": "select doc_id, text, lang, source, n_chars from documents"
    " qualify row_number() over (partition by text order by doc_id) = 1",
    "latest_order_per_customer": "select * from orders qualify row_number() over"
    " (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1",
    "loaded_dates": f'{C} select distinct "date" from c',
    "cluster_layout": f'{C} select "date", count(*) as rows, max("timestamp") as latest,'
    " cast(0 as bigint) as out_of_order from c group by 1",
    "silver_merge": f"{C} select {FLAT} from c",
    "silver_merge_null_day": f"""{C} select {FLAT}, case when day("timestamp") > 10
        then strftime("timestamp", '%Y%m') end as month from c""",
    "silver_merge_late": f"{C} select {FLAT} from c",
    "silver_as_of": f"{EARLY} select {FLAT} from c",
    "silver_versions": f"""{C}, early as (
        select * from v where weather_condition in ('A', 'N')
        qualify row_number() over (partition by vehicle_id, "timestamp" order by {', '.join(TIE_BREAK)}) = 1)
        select version, month, count(*) as rows from (
            select cast(0 as bigint) as version, strftime("timestamp", '%Y%m') as month from early
            union all select unnest([cast(1 as bigint), 2]), strftime("timestamp", '%Y%m') from c)
        group by 1, 2""",
    "dim_time": CALENDAR,
    "dim_time_hour": f"{C} {HOURS}",
    "dim_owner": f"{GOLD} select * from dim_owner",
    "dim_owner_dense": f"""{C}
        select *, row_number() over (order by owner_name nulls first, phone nulls first,
                                     email nulls first) - 1 as owner_sk
        from (select distinct owner_name, phone, email from c)""",
    "dense_key_stable": f"""{C}, o as (
        select owner_name, phone, email, bool_or(weather_condition = 'A') as early from c group by 1, 2, 3)
        select owner_name, phone, email, case when early then number end as first_sk, number as owner_sk
        from (select *, row_number() over (order by not early, owner_name nulls first, phone nulls first,
                                           email nulls first) - 1 as number from o)""",
    "dim_vehicle": f"{GOLD} "
    + widened("dim_vehicle", ("vehicle_length", "vehicle_width", "vehicle_height")),
    "dim_location": f"{GOLD} select * from dim_location",
    "dim_weather": f"{GOLD} " + widened("dim_weather", ("temperature", "humidity")),
    "union_by_name": f"{C} {PLACES}",
    "fact_traffic": f"{FACT} select * from fact",
    "fact_traffic_derived": f"{FACT} select * from fact",
    "fact_traffic_nullsafe": f"{GOLD} {fact_sql('is not distinct from')}",
    "fact_traffic_skewed": f"{GOLD.replace(C, POOLED)} {fact_sql('is not distinct from')}",
    "traffic_rollup": f"{FACT} {rollup_sql('time_sk')}",
    "traffic_rollup_minute": f"{FACT} {rollup_sql('cast(time_sk - time_sk % 60 as integer)')}",
    "table_row_counts": f"{FACT} {COUNTS}",
    "job_silver": f"{JOB_C} select {FLAT} from c",
    "job_fact": f"{JOB_FACT} select * from fact",
    "job_rollup": f"{JOB_FACT} {rollup_sql('time_sk')}",
    "job_metrics": f"{JOB_FACT} {JOB_STAGES}",
    "job_rerun": f"""{JOB_C} select 'landed' as what, count(*) as rows from t
        union all select 'quarantined', count(*) from t where not ({ALL_RULES})
        union all select 'silver', count(*) from c
        union all select 'manifest_repeats', 0 union all select 'open_batches', 0""",
    "job_fact_joined": f"{JOB_FACT} select * from fact",
    "job_gold_by_day": f"{JOB_FACT} select *, {FACT_DAY} as \"date\" from fact",
    "job_gold_one_day": f"{JOB_FACT} select *, {FACT_DAY} as \"date\" from ({rollup_sql('time_sk')})",
    "job_gold_one_day_dims": f"""{JOB_FACT}
        select 'dim_owner' as dimension, owner_sk as key, owner_name as text_1, phone as text_2, email as text_3,
               cast(null as double) as number_1, cast(null as double) as number_2, cast(null as double) as number_3 from dim_owner
        union all select 'dim_vehicle', vehicle_sk, license_number, vehicle_type, vehicle_classification,
               cast(vehicle_length as double), cast(vehicle_width as double), cast(vehicle_height as double) from dim_vehicle
        union all select 'dim_location', location_sk, street, district, city, null, null, null from dim_location
        union all select 'dim_weather', weather_sk, weather_condition, null, null,
               cast(temperature as double), cast(humidity as double), null from dim_weather""",
}
