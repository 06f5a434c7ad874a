"""Row shapes of the telemetry tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the incoming device records.
VIBRATION_COLUMNS = ["AN3", "AN4", "AN5", "AN6", "AN7", "AN8", "AN9", "AN10"]
EVOLVING_HINTS = "TIMESTAMP TIMESTAMP, infos STRUCT<wind_speed: FLOAT, wind_direction: STRING>"


def reading_schema(torque: bool = True) -> T.StructType:
    """Decoded reading. Producers that send no torque use ``torque=False``.

    Every field is nullable: JSON text can always lack a field.
    """
    numbers = VIBRATION_COLUMNS + ["SPEED"] + (["TORQUE"] if torque else []) + ["ID"]
    fields = [T.StructField(name, T.DoubleType()) for name in numbers]
    return T.StructType(fields + [T.StructField("TIMESTAMP", T.TimestampType())])

