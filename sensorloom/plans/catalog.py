"""Databases, tables and views of a flow."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from sensorloom.sources.constraints import set_properties, sql_text
from sensorloom.sources.writers import write


def register(spark: SparkSession, db: str, name: str, path: str, fmt: str = "parquet") -> str:
    """Make the files at ``path`` a table of ``db``, creating the database if needed."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} USING {fmt} LOCATION '{path}'")
    return f"{db}.{name}"


def use(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create a database if needed and make it the current one."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")
    spark.catalog.setCurrentDatabase(db)


def view(df: DataFrame, name: str) -> DataFrame:
    """Name a batch or a stream for SQL. SQL over a streaming view is a stream again."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep the rows of ``df`` at hand while the block runs; what does not fit in memory goes to disk.

    Blocks that are lost with an executor are computed again. Nothing is computed until the first action.
    """
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()


def define_table(
    name: str, df: DataFrame, comment: str | None = None, path: str | None = None,
    props: dict[str, str] | None = None,
) -> DataFrame:
    """Save a query result as a table with a comment and properties. A table of that name is replaced when the
    new rows are there."""
    spark = df.sparkSession
    write(df, name, "overwrite", **({"path": path} if path else {}))
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{sql_text(comment)}'")
    set_properties(spark, name, props or {})
    return spark.table(name)


def reset(
    spark: SparkSession, tables: Sequence[str], paths: Sequence[str] = (), root: str | None = None,
    database: str | None = None,
) -> None:
    """Drop tables, clear folders and drop a database.

    A folder is deleted only if it lies below ``root``.
    """
    for path in paths:
        inside = root is not None and path.rstrip("/").startswith(root.rstrip("/") + "/")
        if not inside or ".." in path.split("/"):
            raise ValueError(f"{path} is not below the managed folder {root}")
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    if database:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
