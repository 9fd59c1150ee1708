"""Layered vehicle telemetry on Spark: landed files, a validated flat table, a star schema."""
