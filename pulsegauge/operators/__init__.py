"""Operators over DataFrames of readings, alerts, send attempts and offsets."""
