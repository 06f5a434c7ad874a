"""JSON records to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The JSON writer cuts timestamps to milliseconds unless told otherwise. Instants are written in UTC,
# so the text does not depend on the session's zone.
MICROS = {"timeZone": "UTC",
          "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def decode(
    df: DataFrame, schema: T.StructType | str, col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """JSON text in ``col`` to one column per schema field, after the ``keep`` columns.

    No row is lost: malformed text, an empty text and NULL all give NULL fields, and a value of the
    wrong type gives NULL for that field only.
    """
    return df.select(*keep, F.from_json(F.col(col), schema).alias("_record")).select(*keep, "_record.*")


def encode(df: DataFrame, key: str | Column, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows to ``(key, value)`` records with the JSON text of ``cols`` (all columns if not given)."""
    cols = list(cols or df.columns)
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.alias("key"), F.to_json(F.struct(*cols), MICROS).alias("value"))


def json_field(col: str, ddl: str, path: str) -> Column:
    """One field of JSON text, typed by ``ddl``; ``path`` may reach into nested structs."""
    value = F.from_json(F.col(col), ddl)
    for part in path.split("."):
        value = value.getField(part)
    return value


def to_date_col(ts: str | Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("date")


def try_number(col: str | Column) -> Column:
    """Text or UTF-8 bytes to a double; NULL when it is not a number."""
    return (F.col(col) if isinstance(col, str) else col).cast("string").try_cast("double")
