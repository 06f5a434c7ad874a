"""Batch readers and writers."""

from sensorloom.sources.jdbc import read_jdbc, write_jdbc
from sensorloom.sources.readers import from_json_lines, scan, table
from sensorloom.sources.writers import create, insert, write

__all__ = [
    "create", "from_json_lines", "insert", "read_jdbc", "scan", "table", "write", "write_jdbc",
]
