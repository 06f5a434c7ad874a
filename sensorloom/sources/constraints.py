"""Constraints of tables, kept as table properties and applied by every writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.predicates import is_true

NOT_NULL_PROPERTY = "sensorloom.notnull"
CHECK_PROPERTY = "sensorloom.check."


def sql_text(value: str) -> str:
    """``value`` as it stands between the quotes of a SQL string."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


def guard(df: DataFrame, name: str, predicate: str | Column, null_passes: bool = False) -> DataFrame:
    """The rows, or an error at the first one for which the predicate is not TRUE; batch and stream.

    The test sits in a filter: an unread projected column would be pruned. The message names the rule
    only; quoting the row would make the scan read all its columns.
    """
    failed = F.raise_error(F.lit(f"rule {name!r} failed")).cast("boolean")
    return df.where(F.when(is_true(predicate, null_passes), F.lit(True)).otherwise(failed))


def constraints(spark: SparkSession, table: str) -> dict[str, str]:
    """The constraint properties of a table; none if there is no such table."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows if r["key"] == NOT_NULL_PROPERTY or r["key"].startswith(CHECK_PROPERTY)}


def enforce(df: DataFrame, table: str) -> DataFrame:
    """Guard ``df`` with all constraints of the table it is about to be written to."""
    for key, value in constraints(df.sparkSession, table).items():
        if key == NOT_NULL_PROPERTY:
            for column in value.split(","):
                df = guard(df, f"{column} not null", F.col(column).isNotNull())
        else:
            df = guard(df, key.removeprefix(CHECK_PROPERTY), value)
    return df


def set_properties(spark: SparkSession, table: str, props: dict[str, str]) -> None:
    if props:
        pairs = ", ".join(f"'{sql_text(k)}' = '{sql_text(v)}'" for k, v in props.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
