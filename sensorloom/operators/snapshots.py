"""Versions of a table on plain parquet: history, time travel, restore, clone.

Layout below ``root``: ``data/_segment=<id>/[<partition>/]*.parquet``, never changed once written, and
``commits/``, a small parquet table with one row per version naming the folders the version is made
of. A commit row is written last, so readers see whole versions only. A correction writes new
folders for the rows it touches and names the untouched ones again. One writer per table at a time
is assumed; concurrent writers are not supported.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.predicates import as_column
from sensorloom.operators import corrections
from sensorloom.operators.layout import in_fewer_files
from sensorloom.session import append_row, path_exists

SEGMENT = "_segment"
COMMIT = (
    "version BIGINT, committed_at TIMESTAMP, operation STRING, parameters STRING, rows_added BIGINT, "
    "rows_removed BIGINT, folders ARRAY<STRING>, partition_by ARRAY<STRING>, table_schema STRING"
)


def write(
    spark: SparkSession, root: str, df: DataFrame, partition_by: Sequence[str] = (),
    at: dt.datetime | None = None,
) -> int:
    """New version with exactly the rows of ``df``. Returns the version number."""
    before = _latest(spark, root)
    added = _segment(spark, root, df, partition_by)
    return _commit(spark, root, before, "WRITE", {}, df.schema, added, [], partition_by, at, replace=True)


def append(spark: SparkSession, root: str, df: DataFrame, at: dt.datetime | None = None,
           operation: str = "APPEND", parameters: dict | None = None) -> int:
    """New version with the rows of ``df`` added; no stored file is read or rewritten."""
    before = _required(spark, root)
    schema = _schema(before)
    df = corrections.append_null_columns(df, schema)
    extra = [f for f in df.schema.fields if f.name not in schema.names]
    added = _segment(spark, root, df, before["partition_by"])
    return _commit(spark, root, before, operation, parameters or {}, T.StructType(schema.fields + extra),
                   added, [], before["partition_by"], at)


def delete_where(spark: SparkSession, root: str, predicate: str | Column,
                 at: dt.datetime | None = None) -> int:
    """New version without the rows for which the predicate is TRUE.

    Only folders that hold such rows are rewritten, found by a scan that reads just the columns of
    the predicate. In a table partitioned by day, a delete by time touches those days only.
    """
    before = _required(spark, root)
    stored = _read_folders(spark, root, before, before["folders"])
    per_file = stored.where(as_column(predicate)).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    hits = (
        per_file.groupBy(_folder(_unescaped(F.col("file_path"))).alias("folder"))
        .agg(F.sum("n").alias("n")).collect()
    )
    touched = sorted(row["folder"] for row in hits)
    kept = corrections.delete_where(_read_folders(spark, root, before, touched).drop(SEGMENT), predicate)
    added = _segment(spark, root, kept, before["partition_by"]) if touched else []
    return _commit(spark, root, before, "DELETE", {"predicate": str(predicate)}, _schema(before), added,
                   touched, before["partition_by"], at, removed=sum(row["n"] for row in hits), moved=True)


def merge_insert(spark: SparkSession, root: str, source: DataFrame, on: Sequence[str],
                 at: dt.datetime | None = None) -> int:
    """New version with the source rows that have no partner on ``on`` added."""
    fresh = corrections.new_rows(read(spark, root), source, on)
    return append(spark, root, fresh, at, "MERGE", {"on": list(on)})


def merge_version(spark: SparkSession, root: str, version: int, on: Sequence[str],
                  at: dt.datetime | None = None) -> int:
    """:func:`merge_insert` with an old version of the same table as source.

    Rows of folders that the table still has match themselves, so of those only rows with a NULL key
    (which never match) are read; the work grows with what was removed, not with the table.
    """
    now, old = _required(spark, root), _required(spark, root, version)
    shared = set(now["folders"]) & set(old["folders"])
    source = _read_folders(spark, root, old, [f for f in old["folders"] if f not in shared]).drop(SEGMENT)
    if shared:
        kept = _read_folders(spark, root, old, sorted(shared)).drop(SEGMENT)
        source = source.unionByName(kept.where(reduce(or_, [F.col(c).isNull() for c in on])))
    fresh = corrections.new_rows(read(spark, root), source, on)
    return append(spark, root, fresh, at, "MERGE", {"on": list(on), "version": version})


def read(spark: SparkSession, root: str, version: int | None = None,
         as_of: dt.datetime | None = None) -> DataFrame:
    """The newest version, a given one, or the newest committed at or before ``as_of``."""
    commit = _required(spark, root, version, as_of)
    return _read_folders(spark, root, commit, commit["folders"]).drop(SEGMENT)


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per version, newest first."""
    return (
        spark.read.schema(COMMIT).parquet(f"{root}/commits")
        .select("version", "committed_at", "operation", "parameters", "rows_added", "rows_removed",
                F.size("folders").alias("folders"))
        .orderBy(F.desc("version"))
    )


def detail(spark: SparkSession, root: str) -> DataFrame:
    """One row: location, version, files, bytes, partition columns, folders. Reads no table data."""
    commit = _required(spark, root)
    files = _files(spark, root, commit["folders"])
    return files.agg(F.count("*").alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes")).select(
        F.lit(root).alias("location"), F.lit(commit["version"]).cast("bigint").alias("version"),
        F.lit(commit["committed_at"]).alias("last_modified"), "num_files", "size_in_bytes",
        F.array(*[F.lit(c) for c in commit["partition_by"]]).cast("array<string>").alias("partition_columns"),
        F.lit(len(commit["folders"])).cast("bigint").alias("folders"),
    )


def changes(spark: SparkSession, root: str, v1: int, v2: int, keys: Sequence[str]) -> DataFrame:
    """Row changes from version ``v1`` to ``v2``; folders that both versions share are not read."""
    old, new = _required(spark, root, v1), _required(spark, root, v2)
    shared = set(old["folders"]) & set(new["folders"])
    before = _read_folders(spark, root, old, [f for f in old["folders"] if f not in shared]).drop(SEGMENT)
    after = _read_folders(spark, root, new, [f for f in new["folders"] if f not in shared]).drop(SEGMENT)
    before = corrections.append_null_columns(before, after.schema)
    after = corrections.append_null_columns(after, before.schema)
    return corrections.row_changes(before, after, keys)


def restore(spark: SparkSession, root: str, version: int | None = None, as_of: dt.datetime | None = None,
            at: dt.datetime | None = None) -> int:
    """New version equal to an old one. No data is copied."""
    before, old = _required(spark, root), _required(spark, root, version, as_of)
    row = {**old, "version": before["version"] + 1, "operation": "RESTORE",
           "parameters": json.dumps({"version": old["version"]}), "rows_added": None, "rows_removed": None}
    return _append_commit(spark, root, row, at)


def clone(spark: SparkSession, root: str, target: str, version: int | None = None,
          as_of: dt.datetime | None = None) -> int:
    """Deep copy of a version as version 0 of a new table."""
    commit = _required(spark, root, version, as_of)
    df = _read_folders(spark, root, commit, commit["folders"]).drop(SEGMENT)
    return write(spark, target, df, commit["partition_by"])


def compact(spark: SparkSession, root: str, target_files: int | None = None,
            at: dt.datetime | None = None, target_bytes: int = 256 << 20) -> int:
    """New version with the same rows in fewer files; see :func:`sensorloom.operators.layout.compact`."""
    before = _required(spark, root)
    df = _read_folders(spark, root, before, before["folders"]).drop(SEGMENT)
    size = _files(spark, root, before["folders"]).agg(F.sum("length")).first()[0] or 0
    df = in_fewer_files(df, size, target_files, target_bytes, before["partition_by"])
    added = _segment(spark, root, df, before["partition_by"])
    return _commit(spark, root, before, "COMPACT", {"target_files": target_files}, _schema(before), added,
                   before["folders"], before["partition_by"], at, moved=True)


def _segment(spark, root, df, partition_by) -> list[str]:
    """Write rows to a fresh segment and return its leaf folders."""
    name = f"{SEGMENT}={uuid.uuid4().hex}"
    if partition_by:
        df.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(*partition_by).parquet(
            f"{root}/data/{name}")
    else:
        df.write.parquet(f"{root}/data/{name}")
    found = _files(spark, root, [name]).select(_folder(F.col("path")).alias("folder")).distinct()
    return sorted(row["folder"] for row in found.collect())


def _files(spark, root, folders) -> DataFrame:
    """Path and length of the data files. The content column is not selected, so nothing is opened."""
    if not folders:
        return spark.createDataFrame([], "path string, length bigint")
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load([f"{root}/data/{f}" for f in folders]).select("path", "length")
    )


def _folder(path: Column) -> Column:
    """Folder of a data file, below ``data/``."""
    return F.regexp_extract(path, rf"/data/({SEGMENT}=[^/]+(?:/.*)?)/[^/]+$", 1)


def _unescaped(url: Column) -> Column:
    return F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))


def _read_folders(spark, root, commit, folders) -> DataFrame:
    schema = _schema(commit)
    if not folders:
        return spark.createDataFrame([], T.StructType(schema.fields + [T.StructField(SEGMENT, T.StringType())]))
    ordered = schema.names
    return (
        spark.read.schema(T.StructType(schema.fields + [T.StructField(SEGMENT, T.StringType())]))
        .option("basePath", f"{root}/data").parquet(*[f"{root}/data/{f}" for f in folders])
        .select(*ordered, SEGMENT)
    )


def _schema(commit) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit["table_schema"]))


def _commit(spark, root, before, operation, parameters, schema, added, dropped, partition_by, at,
            removed=0, moved=False, replace=False) -> int:
    old = [] if before is None else before["folders"]
    gone = set(old) if replace else set(dropped)
    row = {
        "version": 0 if before is None else before["version"] + 1,
        "operation": operation,
        "parameters": json.dumps(parameters),
        "rows_added": 0 if moved else _count(spark, root, schema, added),
        "rows_removed": _count(spark, root, schema, old) if replace else removed,
        "folders": [f for f in old if f not in gone] + added,
        "partition_by": list(partition_by),
        "table_schema": _nullable(schema).json(),
    }
    return _append_commit(spark, root, row, at)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _count(spark, root, schema, folders) -> int:
    """Row count from the file footers."""
    commit = {"table_schema": schema.json()}
    return _read_folders(spark, root, commit, folders).count() if folders else 0


def _append_commit(spark, root, row, at) -> int:
    row = {**row, "committed_at": at or dt.datetime.now(dt.timezone.utc)}
    append_row(spark, f"{root}/commits", row, COMMIT)
    return row["version"]


def _latest(spark, root) -> dict | None:
    return _required(spark, root) if path_exists(spark, f"{root}/commits") else None


def _required(spark, root, version=None, as_of=None) -> dict:
    """The one commit row asked for; an error if there is none."""
    commits = spark.read.schema(COMMIT).parquet(f"{root}/commits")
    if version is not None:
        commits = commits.where(F.col("version") == version)
    if as_of is not None:
        commits = commits.where(F.col("committed_at") <= F.lit(as_of))
    found = commits.orderBy(F.desc("version")).limit(1).collect()
    if not found:
        raise ValueError(f"{root} has no version {version if version is not None else f'at {as_of}'}")
    return found[0].asDict()
