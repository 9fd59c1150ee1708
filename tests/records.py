"""Telemetry records built by hand."""

from __future__ import annotations

import copy
import json

GOOD = {
    "vehicle_id": "V1",
    "owner": {
        "name": "An",
        "license_number": "L1",
        "contact_info": {"phone": "090", "email": "an@example.org"},
    },
    "speed_kmph": 42.5,
    "road": {"street": "A", "district": "D1", "city": "C"},
    "timestamp": "2024-03-01T08:15:30Z",
    "vehicle_size": {"length_meters": 4.2, "width_meters": 1.8, "height_meters": 1.5},
    "vehicle_type": "Car",
    "vehicle_classification": "Private",
    "coordinates": {"latitude": 10.7, "longitude": 106.6},
    "engine_status": {"is_running": True, "rpm": 2100, "oil_pressure": "Normal"},
    "fuel_level_percentage": 60,
    "passenger_count": 2,
    "internal_temperature_celsius": 24.0,
    "weather_condition": {
        "temperature_celsius": 31.5,
        "humidity_percentage": 70.0,
        "condition": "Clear",
    },
    "estimated_time_of_arrival": {
        "destination": {"street": "B", "district": "D2", "city": "C"},
        "eta": "2024-03-01T08:45:00Z",
    },
    "traffic_status": {"congestion_level": "High", "estimated_delay_minutes": 7},
    "alerts": [
        {"type": "speed", "description": "fast", "severity": "low", "timestamp": "08:15"}
    ],
}


def record(**changes):
    """A good record with changes; `a__b__c=x` sets a nested field."""
    rec = copy.deepcopy(GOOD)
    for path, value in changes.items():
        *parents, leaf = path.split("__")
        target = rec
        for name in parents:
            target = target[name]
        target[leaf] = value
    return rec


def write_lines(path, records) -> str:
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(path)


def write_document(path, records) -> str:
    path.write_text(json.dumps(records, indent=2))
    return str(path)
