"""Transforms of the telemetry tables, one module per concern."""
