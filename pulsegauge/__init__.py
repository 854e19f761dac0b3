"""Sensor-telemetry analytics as Spark DataFrames, for tables and for streams."""
