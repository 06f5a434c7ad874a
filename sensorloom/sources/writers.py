"""Batch writes and table creation."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import path_exists, remove, rename
from sensorloom.sources.constraints import NOT_NULL_PROPERTY, enforce, set_properties, sql_text


def create(
    spark: SparkSession,
    name: str,
    ddl: str,
    props: dict[str, str] | None = None,
    comment: str | None = None,
    path: str | None = None,
) -> None:
    """Create an empty parquet table if it is not there.

    File tables do not reject NULLs themselves. The NOT NULL columns are kept as a table property,
    which the writers of this package apply to every row, in batches and streams.
    """
    required = [f.name for f in T.StructType.fromDDL(ddl).fields if not f.nullable]
    props = dict(props or {})
    if required:
        props[NOT_NULL_PROPERTY] = ",".join(required)
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet"
    if path:
        statement += f" LOCATION '{path}'"
    if comment:
        statement += f" COMMENT '{sql_text(comment)}'"
    if props:
        pairs = ", ".join(f"'{sql_text(k)}' = '{sql_text(v)}'" for k, v in props.items())
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)


def write(
    df: DataFrame,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    n_files: int | None = None,
    merge_schema: bool = False,
    partition_by: Sequence[str] = (),
    **options: Any,
) -> None:
    """Write to a path (when ``target`` contains a slash) or to a table.

    ``n_files`` is for small results such as a sample: it makes that many tasks write everything.
    ``merge_schema`` lets an append bring new columns to a path; readers pass
    ``mergeSchema=True`` and see NULL where old files lack them. The constraints of a table hold for
    the new rows and outlive an overwrite, as do its other properties and its comment.

    An overwrite writes aside and takes the old rows' place when everything is there, so a write that
    fails or that a constraint refuses changes nothing, and ``df`` may read what it replaces. The files of
    a table that had a ``path`` of its own come to lie in a new folder beside it.
    """
    spark = df.sparkSession
    is_path = "/" in target
    if not is_path:
        recover(spark, target)
        df = enforce(df, target)
    if n_files is not None:
        df = df.repartition(n_files)

    def writer(how: str):
        out = df.write.mode(how).format(fmt).options(**options)
        return out.partitionBy(*partition_by) if partition_by else out

    swap = mode == "overwrite" and options.get("partitionOverwriteMode") != "dynamic"
    if is_path:
        if swap and path_exists(spark, target):
            _swap_folder(spark, target, lambda aside: writer("errorifexists").save(aside))
            return
        if mode == "append" and not merge_schema:
            _same_columns(df, target, fmt)
        writer(mode).save(target)
    elif swap and spark.catalog.tableExists(target):
        _swap_table(spark, target, lambda name, path: _at(writer("errorifexists"), path).saveAsTable(name),
                    options.get("path"))
    else:
        writer(mode).saveAsTable(target)


_ASIDE, _BEFORE = "__aside_", "__before_"


def _at(writer, path: str | None):
    return writer.option("path", path) if path else writer


def _swap_folder(spark: SparkSession, path: str, fill: Callable[[str], None]) -> None:
    """Fill a folder beside ``path`` and give it that name; the old one goes last.

    A crash between the two renames leaves both folders, complete, beside the path.
    """
    path, mark = path.rstrip("/"), uuid.uuid4().hex
    aside, before = f"{path}{_ASIDE}{mark}", f"{path}{_BEFORE}{mark}"
    try:
        fill(aside)
        rename(spark, path, before)
        try:
            rename(spark, aside, path)
        except Exception:
            rename(spark, before, path)
            raise
        remove(spark, before)
    finally:
        remove(spark, aside)


def _swap_table(spark: SparkSession, table: str, fill: Callable[[str, str | None], None], path: str | None) -> None:
    """Fill a table beside ``table`` and give it that name; :func:`recover` mends a crash between the renames."""
    mark = uuid.uuid4().hex
    aside, before = f"{table}{_ASIDE}{mark}", f"{table}{_BEFORE}{mark}"
    held = spark.catalog.getTable(table)
    props = [r for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if not r["key"].startswith("transient_")]
    old_files = _own_folder(spark, table)
    try:
        fill(aside, f"{path.rstrip('/')}{_ASIDE}{mark}" if path else None)
        set_properties(spark, aside, {r["key"]: r["value"] for r in props})
        if held.description:
            spark.sql(f"COMMENT ON TABLE {aside} IS '{sql_text(held.description)}'")
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
        try:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        if path:
            remove(spark, f"{path.rstrip('/')}{_ASIDE}{mark}")
        raise
    spark.sql(f"DROP TABLE {before}")
    if old_files and path:  # an external table's files outlive it
        remove(spark, old_files)


def _own_folder(spark: SparkSession, table: str) -> str | None:
    """The folder of an external table, None for one whose files go with it."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return told.get("Location") if told.get("Type") == "EXTERNAL" else None


def recover(spark: SparkSession, table: str) -> None:
    """Give a table its name back that an overwrite left under another one when it was cut off."""
    if spark.catalog.tableExists(table):
        return
    base, _, name = table.rpartition(".")
    there = spark.sql(f"SHOW TABLES{f' IN {base}' if base else ''} LIKE '{name}{_BEFORE}*'").collect()
    if there:
        held = f"{base}." if base else ""
        spark.sql(f"ALTER TABLE {held}{there[0]['tableName']} RENAME TO {table}")


def _same_columns(df: DataFrame, path: str, fmt: str) -> None:
    if fmt != "parquet" or not path_exists(df.sparkSession, path):
        return
    try:
        held = df.sparkSession.read.parquet(path).schema  # the footer of one file
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return
        raise
    kinds = {f.name: f.dataType for f in held.fields}
    if new := set(df.columns) - set(kinds):
        raise ValueError(f"columns {sorted(new)} are not in {path}; use merge_schema=True to add them")
    other = [f.name for f in df.schema.fields if f.dataType != kinds[f.name]]
    if other:
        raise ValueError(f"columns {sorted(other)} have another type in {path}; cast them before the write")


def insert(df: DataFrame, table: str, cols: Sequence[str]) -> None:
    """Append the columns ``cols``; the other columns of the table become NULL."""
    spark = df.sparkSession
    unknown = set(cols) - set(spark.read.table(table).columns)
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    ordered = [
        F.col(f.name).cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.read.table(table).schema.fields
    ]
    enforce(df.select(*ordered), table).write.insertInto(table)
