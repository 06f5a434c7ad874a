"""The layered flow: raw records, decoded readings, labelled readings.

The functions take batches and streams alike, so a flow is three calls in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T

from sensorloom.functions.records import decode
from sensorloom.operators.bronze import union_sources
from sensorloom.operators.gold import label
from sensorloom.operators.quality import Rule, apply_rules
from sensorloom.schemas import reading_schema

READING_RULES = (
    Rule("timestamp", "TIMESTAMP IS NOT NULL", "fail"),
    Rule("speed", "SPEED >= 0", "warn"),
    Rule("id", "ID > 0", "drop"),
)


def bronze(*sources: DataFrame) -> DataFrame:
    """Raw ``(key, value)`` records of all sources."""
    return union_sources(*[s.select("key", "value") for s in sources])


def silver(
    raw: DataFrame,
    schema: T.StructType | None = None,
    rules: Sequence[Rule] = READING_RULES,
    observation: Observation | str | None = "silver",
) -> DataFrame:
    """Decoded readings that pass the rules."""
    return apply_rules(decode(raw, schema or reading_schema()), rules, observation)


def gold(readings: DataFrame, status: DataFrame, on: str = "id", salt: int | None = None) -> DataFrame:
    """Readings with the status of their device."""
    return label(readings, status, on, salt)
