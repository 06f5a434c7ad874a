"""Column expressions and narrow row transforms."""

from sensorloom.functions.hashing import every_salt, row_hash, row_salt, unit_bucket
from sensorloom.functions.predicates import as_column, instant_literal, is_true
from sensorloom.functions.records import decode, encode, json_field, to_date_col, try_number

__all__ = [
    "as_column", "decode", "encode", "every_salt", "instant_literal", "is_true", "json_field", "row_hash",
    "row_salt", "to_date_col", "try_number", "unit_bucket",
]
