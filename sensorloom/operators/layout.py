"""Derived partitions, buckets and compaction of stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.hashing import every_salt, row_hash, row_salt
from sensorloom.functions.predicates import instant_literal

SALT = "_salt"


def write_partitioned(
    df: DataFrame, table: str, ts: str, day: str = "yymmdd", path: str | None = None, mode: str = "overwrite"
) -> None:
    """Save with the derived column ``day`` (the date of ``ts``) as partition column.

    Rows are rebalanced by day first: one task per small day, several for a large one, so neither
    many tiny files nor one huge task appears.
    """
    dated = df.withColumn(day, F.col(ts).cast("date")).hint("rebalance", F.col(day))
    writer = dated.write.mode(mode).format("parquet").partitionBy(day)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def prune(
    df: DataFrame,
    ts: str,
    day: str = "yymmdd",
    lower: dt.datetime | str | None = None,
    upper: dt.datetime | str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rows with ``lower <= ts <= upper`` (``<`` and ``>`` excluded bounds if ``strict``).

    The same bounds are put on the derived partition column, so only those partitions are listed.
    """
    column = F.col(ts)
    if lower is not None:
        low = instant_literal(df, ts, lower)
        df = df.where(column > low if strict else column >= low).where(F.col(day) >= low.cast("date"))
    if upper is not None:
        high = instant_literal(df, ts, upper)
        df = df.where(column < high if strict else column <= high).where(F.col(day) <= high.cast("date"))
    return df


def bucket_count(spark: SparkSession, path: str, target_bytes: int = 1 << 30, least: int = 16) -> int:
    """Number of buckets that makes each about ``target_bytes`` of the parquet files at ``path``.

    A bucket is written and read by one task, so the number has to grow with the table.
    """
    return max(least, -(-folder_bytes(spark, path) // target_bytes))


TRACKED = 100_000  # keys that a heavy-hitter sketch holds


def hot_keys(df: DataFrame, key: str, target_rows: int, most: int = 1000) -> dict[int | None, int]:
    """Salts per hot key: how many shares of about ``target_rows`` its rows make. Keys below two shares are not named.

    One heavy-hitter sketch over the key finds them, so no row and no key is shuffled. At most ``most`` keys can
    come to the driver; they are the largest, and there are no more than rows / (2 * target_rows) of them. A missing
    key is a key like any other.
    """
    whole = df.select(_whole_number(key).alias("k"))
    top = F.expr(f"approx_top_k(k, {int(most)}, {TRACKED}) FILTER (WHERE k IS NOT NULL)")
    told = whole.agg(top.alias("top"), F.count_if(F.col("k").isNull()).alias("none")).first()
    counts = [(row["item"], row["count"]) for row in told["top"] or []] + [(None, told["none"])]
    return {item: -(-n // target_rows) for item, n in counts if n >= 2 * target_rows}


def _salts(key: str, hot: dict[int | None, int], missing: int = 1) -> Column:
    """Number of salts of a row's key, 1 for keys that are not hot; the keys stand in the plan, so nothing is joined."""
    pairs = [F.lit(x).cast("bigint") for k, n in hot.items() if k is not None for x in (k, n)]
    named = F.try_element_at(F.create_map(*pairs), F.col(key)) if pairs else F.lit(None)
    return F.coalesce(named, F.when(F.col(key).isNull(), missing).otherwise(1).cast("bigint"))


def write_bucketed(
    df: DataFrame, table: str, key: str, n: int = 16, salt: int | dict[int | None, int] = 1, path: str | None = None,
    sort: Sequence[str] = (),
) -> None:
    """Save in ``n`` buckets by ``key``, one sorted file each, for joins and counts without exchange.

    The key is stored as BIGINT, because only equal integer types join without exchange; a key that
    is no whole number is an error. All rows of a key share a bucket, so a hot key makes a hot task.
    ``salt`` from :func:`hot_keys` spreads the rows of each hot key over as many buckets as it needs, by a hash
    of the row, and leaves all other keys alone; a number spreads every key. The other table of a join is
    then written by :func:`write_replicated` with the same ``salt``.
    """
    df = df.withColumn(key, _whole_number(key))
    if isinstance(salt, dict):
        df = df.withColumn(SALT, F.pmod(row_hash(df), _salts(key, salt, salt.get(None, 1))))
    elif salt > 1:
        df = df.withColumn(SALT, row_salt(df, salt))
    _save_buckets(df, table, [key] + ([SALT] if SALT in df.columns else []), n, path, sort)


def write_replicated(
    df: DataFrame, table: str, key: str, n: int = 16, salt: int | dict[int | None, int] = 1, path: str | None = None
) -> None:
    """The small side of a salted bucket join: every row once per salt of its key, so once unless the key is hot."""
    df = df.withColumn(key, _whole_number(key))
    if isinstance(salt, dict):
        df = df.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), _salts(key, salt) - 1)))
    elif salt > 1:
        df = df.withColumn(SALT, every_salt(salt))
    _save_buckets(df, table, [key] + ([SALT] if SALT in df.columns else []), n, path, ())


def _whole_number(key: str):
    value = F.col(key)
    return F.when(value.cast("bigint") == value, value.cast("bigint")).otherwise(
        F.when(value.isNotNull(), F.raise_error(F.lit(f"{key} is not a whole number")).cast("bigint"))
    )


def _save_buckets(df, table, keys, n, path, sort) -> None:
    writer = (
        df.repartition(n, *keys).write.mode("overwrite").format("parquet")
        .bucketBy(n, *keys).sortBy(*keys, *sort)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def join_bucketed(data: DataFrame, status: DataFrame, key: str, hint: str = "shuffle_merge") -> DataFrame:
    """Inner join of two bucketed tables on the key, and on the salt if they have one."""
    keys = [key] + ([SALT] if SALT in data.columns else [])
    return data.join(status.hint(hint), keys, "inner").drop(SALT)


def count_bucketed(data: DataFrame, key: str) -> DataFrame:
    """Rows per key of a bucketed table.

    Without salt the scan alone groups the rows and nothing is exchanged. With salt each bucket is
    counted in place and only these counts (at most salt per key) are exchanged.
    """
    counts = data.groupBy(key, *([SALT] if SALT in data.columns else [])).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.sum("n").alias("n")) if SALT in data.columns else counts


def folder_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files below the folders, from their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select("length").agg(F.sum("length")).first()[0] or 0


def in_fewer_files(
    df: DataFrame, size: int, target_files: int | None, target_bytes: int, partition_by: Sequence[str]
) -> DataFrame:
    """``df`` arranged for a compacting write of about ``size`` bytes.

    Nothing is exchanged: neighbouring splits are read by one task until the number of tasks is right.
    Partitioned data is rebalanced by partition instead.
    """
    if partition_by:
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    return df.coalesce(target_files or max(1, -(-size // target_bytes)))


def compact(
    spark: SparkSession, source: str, target: str, target_files: int | None = None,
    partition_by: Sequence[str] = (), target_bytes: int = 256 << 20,
) -> None:
    """Rewrite a parquet folder to a new folder with the same rows in at most ``target_files`` files,
    by default in files of about ``target_bytes``."""
    size = folder_bytes(spark, source)
    df = in_fewer_files(spark.read.parquet(source), size, target_files, target_bytes, partition_by)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
