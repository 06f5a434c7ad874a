"""Named queries over the shared test tables, with the SQL that must give the same rows."""

from sensorloom.workload.registry import QUERIES, SQL

# Importing the modules fills the registry.
from sensorloom.workload import (  # noqa: E402, F401
    aggregation, correction, ingestion, learning, quality, refinement, storage, streams,
)

__all__ = ["QUERIES", "SQL"]
