"""Record layouts of the three layers."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

# --- Fixed values: field names and types every reader and writer must agree on. ---

TELEMETRY_DDL = """
    vehicle_id STRING,
    owner STRUCT<name: STRING, license_number: STRING,
                 contact_info: STRUCT<phone: STRING, email: STRING>>,
    speed_kmph DOUBLE,
    road STRUCT<street: STRING, district: STRING, city: STRING>,
    timestamp TIMESTAMP,
    vehicle_size STRUCT<length_meters: DOUBLE, width_meters: DOUBLE, height_meters: DOUBLE>,
    vehicle_type STRING,
    vehicle_classification STRING,
    coordinates STRUCT<latitude: DOUBLE, longitude: DOUBLE>,
    engine_status STRUCT<is_running: BOOLEAN, rpm: BIGINT, oil_pressure: STRING>,
    fuel_level_percentage BIGINT,
    passenger_count BIGINT,
    internal_temperature_celsius DOUBLE,
    weather_condition STRUCT<temperature_celsius: DOUBLE, humidity_percentage: DOUBLE,
                             condition: STRING>,
    estimated_time_of_arrival STRUCT<destination: STRUCT<street: STRING, district: STRING,
                                                         city: STRING>,
                                     eta: TIMESTAMP>,
    traffic_status STRUCT<congestion_level: STRING, estimated_delay_minutes: BIGINT>,
    alerts ARRAY<STRUCT<type: STRING, description: STRING, severity: STRING, timestamp: STRING>>
"""

# Flat column -> where it sits in the nested record. `date` is derived from `timestamp`.
FLAT_COLUMNS = {
    "vehicle_id": "vehicle_id",
    "owner_name": "owner.name",
    "license_number": "owner.license_number",
    "phone": "owner.contact_info.phone",
    "email": "owner.contact_info.email",
    "vehicle_type": "vehicle_type",
    "vehicle_classification": "vehicle_classification",
    "speed_kmph": "speed_kmph",
    "road_street": "road.street",
    "road_district": "road.district",
    "road_city": "road.city",
    "timestamp": "timestamp",
    "date": None,
    "vehicle_length": "vehicle_size.length_meters",
    "vehicle_width": "vehicle_size.width_meters",
    "vehicle_height": "vehicle_size.height_meters",
    "latitude": "coordinates.latitude",
    "longitude": "coordinates.longitude",
    "rpm": "engine_status.rpm",
    "oil_pressure": "engine_status.oil_pressure",
    "is_running": "engine_status.is_running",
    "fuel_level_percentage": "fuel_level_percentage",
    "weather_condition": "weather_condition.condition",
    "temperature": "weather_condition.temperature_celsius",
    "humidity": "weather_condition.humidity_percentage",
    "destination_street": "estimated_time_of_arrival.destination.street",
    "destination_district": "estimated_time_of_arrival.destination.district",
    "destination_city": "estimated_time_of_arrival.destination.city",
    "eta": "estimated_time_of_arrival.eta",
    "congestion_level": "traffic_status.congestion_level",
    "estimated_delay_minutes": "traffic_status.estimated_delay_minutes",
    "passenger_count": "passenger_count",
    "internal_temperature_celsius": "internal_temperature_celsius",
    "alerts": "alerts",
}

MANIFEST_COLUMNS = [
    "file_name", "s3_path", "size_bytes", "status", "ingest_date", "timestamp", "error_msg",
]

LEDGER_DDL = "file_path STRING, processed_at STRING"

SILVER_KEYS = ["vehicle_id", "timestamp"]

# --- End of fixed values. ---


def telemetry_schema(corrupt_column: bool = True) -> str:
    """Nested record schema; with `corrupt_column`, malformed input is kept instead of lost."""
    return f"{TELEMETRY_DDL}, {CORRUPT} STRING" if corrupt_column else TELEMETRY_DDL
