"""Device telemetry on Spark: ingest, refine, correct, aggregate, learn and explain."""

__version__ = "0.1.0"
