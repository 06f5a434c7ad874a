"""Ingestion of JSON whose fields change: stop at unknown fields, widen the schema, go on.

The stream reads text lines and decodes them inside the query, so its checkpoint knows nothing of the
payload's schema and stays valid when the schema grows.
"""

from __future__ import annotations

import json
import zlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from sensorloom.operators.evolution import (
    decode_rescued, schema_of_text, schema_text, schema_with_hints, unknown_fields, widen,
)
from sensorloom.session import append_row, path_exists, remove, rename
from sensorloom.streaming.writers import BATCH

MARKER = "UnknownFields"
NOTE = "step BIGINT, schema STRING, side STRING"


class UnknownFields(RuntimeError):
    """A micro-batch has fields the running schema lacks."""


def run_evolving(
    spark: SparkSession,
    path: str,
    out: str,
    hints: str,
    checkpoint: str,
    side: str = "_incorrect_data",
    max_files: int | None = None,
    fields_only: bool = False,
) -> int:
    """Load the JSON lines below ``path`` that are not loaded yet. Returns the number of restarts.

    Starts from the schema last used for ``out`` (from the hints alone the first time). A batch is read
    once: while it is decoded and written aside, the schema of its texts is gathered. If that has no field
    that the running schema lacks, the batch takes its place by a rename. Otherwise nothing of it is kept, the
    stream stops, the schema is widened by those fields and the stream restarts with the same checkpoint, which
    replays the batch. Every restart adds at least one field, and any other error is raised. Pass ``max_files``
    for a large backlog: a stop repeats one batch only.
    """
    known = schema_with_hints(stored_schema(spark, out), hints)
    if not path_exists(spark, f"{out}/_schemas"):
        _remember(spark, out, known, side)
    restarts = 0
    while True:
        found = _run_once(spark, path, out, known, checkpoint, side, max_files, fields_only)
        if found is None:
            return restarts
        known = schema_with_hints(widen(known, found), hints)
        _remember(spark, out, known, side)
        restarts += 1


def _run_once(spark, path, out, known, checkpoint, side, max_files, fields_only) -> T.StructType | None:
    found: list[T.StructType] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        # Batches of another checkpoint are other batches, whatever their number.
        name = f"{BATCH}={zlib.crc32(checkpoint.encode())}-{batch_id}"
        aside, seen = f"{out}/_aside-{name.partition('=')[2]}", Observation()
        passing = batch.observe(seen, schema_text().alias("schema"))
        decode_rescued(passing, known, side=side, fields_only=fields_only).write.mode("overwrite").parquet(aside)
        observed = schema_of_text(seen.get["schema"])
        new = unknown_fields(observed, known)
        if new:
            remove(spark, aside)
            found.append(observed)
            raise UnknownFields(f"{MARKER}: {', '.join(new)}")
        remove(spark, f"{out}/{name}")
        rename(spark, aside, f"{out}/{name}")

    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(path).writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(load).start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if not found or MARKER not in str(error):
            raise
        return found[0]
    return None


def _remember(spark: SparkSession, out: str, schema: T.StructType, side: str) -> None:
    """Note a schema beside the data. Readers of ``out`` skip folders that start with ``_``."""
    row = {"step": len(_noted(spark, out)), "schema": schema.json(), "side": side}
    append_row(spark, f"{out}/_schemas", row, NOTE)


def _noted(spark: SparkSession, out: str) -> list:
    if not path_exists(spark, f"{out}/_schemas"):
        return []
    return spark.read.schema(NOTE).parquet(f"{out}/_schemas").orderBy("step").collect()


def stored_schema(spark: SparkSession, out: str) -> T.StructType:
    """The widest schema used so far for the rows at ``out``, without the side column."""
    noted = _noted(spark, out)
    return T.StructType.fromJson(json.loads(noted[-1]["schema"])) if noted else T.StructType()


def read_evolved(spark: SparkSession, out: str) -> DataFrame:
    """All loaded rows with the widest schema; rows from before a field appeared have NULL there.

    The schema comes from the notes, so no file footer is merged.
    """
    noted = _noted(spark, out)
    if not noted:
        raise ValueError(f"nothing was loaded to {out}")
    side = T.StructField(noted[-1]["side"], T.StringType())
    # Folder names are no columns here: a field of the data may have any name.
    reader = spark.read.schema(T.StructType(stored_schema(spark, out).fields + [side]))
    return reader.option("recursiveFileLookup", "true").parquet(out)
