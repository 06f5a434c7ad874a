"""Streams that run over everything present, then return what their sink holds."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom import streaming
from sensorloom.functions import decode
from sensorloom.operators import analytics
from sensorloom.operators.ledger import Ledger
from sensorloom.operators.quality import Rule, add_check, apply_rules
from sensorloom.plans import medallion
from sensorloom.session import scratch, scratch_root
from sensorloom.sources import create, scan, table, write
from sensorloom.workload import frames
from sensorloom.workload.aggregation import WINDOW_SQL, flat_windows, window_means
from sensorloom.workload.refinement import FLOW_RULES
from sensorloom.workload.registry import query


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _land(df: DataFrame, label: str = "landed") -> DataFrame:
    """Run a stream to the end of its input and read the files it wrote."""
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    streaming.to_path(df, path, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("file_stream", "SELECT event_id, user_id, value FROM events")
def file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scratch(spark, "incoming")
    take = frames.land_files(frames.events(spark, sf_dir).select("event_id", "user_id", "value"), files, 2000)
    return _land(streaming.file_stream(spark, files, "event_id BIGINT, user_id BIGINT, value DOUBLE", max_files=take))


@query("file_stream_inferred", "SELECT event_id, event_type, value FROM events")
def file_stream_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scratch(spark, "incoming")
    frames.events(spark, sf_dir).select("event_id", "event_type", "value").write.json(files)
    return _land(streaming.file_stream(spark, files, fmt="json", infer=True))


@query("message_stream", "SELECT CAST(user_id AS DOUBLE) AS key, event_id AS event, value AS speed FROM events")
def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connector records as a stream, normalised, landed raw, then decoded."""
    raw = streaming.message_stream(frames.messages(frames.events_stream(spark, sf_dir)))
    decoded = decode(_land(raw), frames.READING_DDL, keep=["key"])
    return decoded.select("key", F.col("EVENT").alias("event"), F.col("SPEED").alias("speed"))


@query("table_stream", "SELECT event_id, value FROM events WHERE value >= 5")
def table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream fills a table, a second one reads it."""
    name = _name("landed")
    stream = frames.events_stream(spark, sf_dir).select("event_id", "value")
    streaming.to_table(stream, name, scratch(spark, "checkpoint"), name=name,
                       path=scratch(spark, name)).awaitTermination()
    return _land(streaming.table_stream(spark, name).where("value >= 5"))


@query("copy_into_once", "SELECT event_id, user_id FROM events")
def copy_into_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same folder twice adds its rows once."""
    name, files, checkpoint = _name("loaded"), scratch(spark, "incoming"), scratch(spark, "checkpoint")
    frames.events(spark, sf_dir).select("event_id", "user_id").write.parquet(files)
    create(spark, name, "event_id BIGINT, user_id BIGINT", path=scratch(spark, name))
    for _ in range(2):
        streaming.copy_into(spark, name, files, checkpoint, schema="event_id BIGINT, user_id BIGINT")
    return table(spark, name)


@query("stream_to_table", "SELECT event_id, user_id, value FROM events")
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("appended")
    stream = frames.events_stream(spark, sf_dir).select("event_id", "user_id", "value")
    streaming.to_table(stream, name, scratch(spark, "checkpoint"), name=name,
                       path=scratch(spark, name)).awaitTermination()
    return table(spark, name)


@query("stream_periodic", "SELECT event_id, value FROM events")
def stream_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("periodic")
    stream = frames.events_stream(spark, sf_dir).select("event_id", "value")
    running = streaming.to_table(stream, name, scratch(spark, "checkpoint"), "2 seconds", name,
                                 path=scratch(spark, name))
    running.processAllAvailable()
    running.stop()
    return table(spark, name)


@query("stream_to_memory", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_to_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of event types, so the result fits the driver at any input size."""
    name = _name("live_counts")
    counts = analytics.count_by(frames.events_stream(spark, sf_dir), "event_type")
    streaming.to_memory(counts, name, checkpoint=scratch(spark, "checkpoint")).awaitTermination()
    return spark.table(name)


@query("stream_count_by_id", "SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1")
def stream_count_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running count in complete mode, kept in files because it grows with the devices."""
    stream = frames.events_stream(spark, sf_dir).withColumnRenamed("user_id", "id")
    path = scratch(spark, "counts")
    streaming.rewrite_each_batch(analytics.count_by(stream, "id"), path,
                                 scratch(spark, "checkpoint")).awaitTermination()
    return streaming.latest_result(spark, path)


@query("stream_union", "SELECT CAST(user_id AS DOUBLE) AS key FROM events UNION ALL SELECT CAST(user_id AS DOUBLE) FROM events")
def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = streaming.message_stream(frames.messages(frames.events_stream(spark, sf_dir)))
    history = frames.raw(frames.events_stream(spark, sf_dir)).select("value", "key")
    return _land(medallion.bronze(live, history)).select("key")


@query("stream_expectations", "SELECT event_id AS event, user_id FROM events WHERE user_id > 0")
def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = medallion.silver(frames.raw(frames.events_stream(spark, sf_dir)), frames.READING_DDL, FLOW_RULES)
    return _land(silver.select(F.col("EVENT").alias("event"), F.col("ID").cast("bigint").alias("user_id")))


@query("stream_label_join", f"""SELECT CAST(e.user_id AS DOUBLE) AS id, e.event_id AS event, s.status
    FROM events e LEFT JOIN {frames.STATUS_SQL} s ON e.user_id = s.id WHERE e.user_id > 0""")
def stream_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stream to silver table, silver stream joined with the static status table to gold."""
    silver = medallion.silver(frames.raw(frames.events_stream(spark, sf_dir)), frames.READING_DDL, FLOW_RULES)
    name = _name("silver")
    streaming.to_table(silver, name, scratch(spark, "checkpoint"), path=scratch(spark, name)).awaitTermination()
    gold = medallion.gold(streaming.table_stream(spark, name), frames.status(spark, sf_dir))
    return _land(gold.select("id", F.col("EVENT").alias("event"), "status"))


@query("stream_window_complete", WINDOW_SQL)
def stream_window_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "windows")
    streaming.rewrite_each_batch(window_means(frames.events_stream(spark, sf_dir)), path,
                                 scratch(spark, "checkpoint")).awaitTermination()
    return flat_windows(streaming.latest_result(spark, path))


@query("stream_window_update", WINDOW_SQL)
def stream_window_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "windows")
    streaming.rewrite_each_batch(window_means(frames.events_stream(spark, sf_dir)), path,
                                 scratch(spark, "checkpoint"), "update").awaitTermination()
    return flat_windows(streaming.merge_updates(spark, path, ["id", "window"]))


@query("stream_window_append", f"""SELECT * FROM ({WINDOW_SQL})
    WHERE window_end <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)""")
def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows the watermark has closed; the younger ones stay in the state for the next files."""
    return flat_windows(_land(window_means(frames.events_stream(spark, sf_dir))))


@query("stream_view_sql", "SELECT event_type, max(value) AS peak FROM events GROUP BY 1")
def stream_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a streaming view is a stream."""
    live = _name("live")
    frames.events_stream(spark, sf_dir).createOrReplaceTempView(live)
    peaks = spark.sql(f"SELECT event_type, max(value) AS peak FROM {live} GROUP BY event_type")
    path = scratch(spark, "peaks")
    streaming.rewrite_each_batch(peaks, path, scratch(spark, "checkpoint")).awaitTermination()
    return streaming.latest_result(spark, path)


@query("stream_into_checked_table", "SELECT event_id, value FROM events WHERE value >= 5")
def stream_into_checked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with constraints takes the rows that hold them and refuses a stream with others."""
    name = _name("checked")
    create(spark, name, "event_id BIGINT NOT NULL, value DOUBLE", path=scratch(spark, name))
    add_check(spark, name, "enough", "value >= 5")
    stream = frames.events_stream(spark, sf_dir).select("event_id", "value")
    try:
        streaming.to_table(stream, name, scratch(spark, "checkpoint")).awaitTermination()
        refused = False
    except StreamingQueryException:
        refused = True
    if not refused:  # only a table without a bad row may pass
        return table(spark, name)
    streaming.to_table(stream.where("value >= 5"), name, scratch(spark, "checkpoint")).awaitTermination()
    return table(spark, name)


@query("declarative_stream", f"""SELECT CAST(e.user_id AS DOUBLE) AS id, e.event_id AS event, s.status
    FROM events e LEFT JOIN {frames.STATUS_SQL} s ON e.user_id = s.id WHERE e.user_id > 0""")
def declarative_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live messages and historical records, in different column order, through rules and the status join as one stream.

    The sources have several files each and every micro-batch takes a few of them.
    """
    live, history = scratch(spark, "live"), scratch(spark, "history")
    rows = frames.events(spark, sf_dir)
    newer = frames.land_files(frames.messages(rows.where("event_id % 2 = 0")), live, 1000)
    older = frames.land_files(frames.raw(rows.where("event_id % 2 <> 0")).select("value", "key"), history, 1000)
    messages = streaming.message_stream(streaming.file_stream(spark, live, infer=True, max_files=newer))
    records = streaming.file_stream(spark, history, infer=True, max_files=older)
    silver = medallion.silver(medallion.bronze(messages, records), frames.READING_DDL, FLOW_RULES)
    gold = medallion.gold(silver.withColumnRenamed("ID", "id"), frames.status(spark, sf_dir))
    return _land(gold.select("id", F.col("EVENT").alias("event"), "status"))


_DAY = "CAST(ts AS DATE) = DATE '2024-01-10'"


def _rewritten(spark: SparkSession, sf_dir: str) -> Ledger:
    """All events; then a day is deleted; then it comes back with other values."""
    rows = frames.events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    ledger = Ledger(spark, scratch(spark, "ledger"), rows.schema)
    ledger.append(rows, 0)
    ledger.delete_where(_DAY, 1)
    ledger.append(rows.where(_DAY).withColumn("value", F.col("value") + 1), 2)
    return ledger


_REWRITTEN_SQL = f"SELECT event_id, user_id, CASE WHEN {_DAY} THEN value + 1 ELSE value END AS value FROM events"


@query("stream_after_rewrite", f"""SELECT e.event_id, e.user_id, e.value, s.status
    FROM ({_REWRITTEN_SQL}) e LEFT JOIN {frames.STATUS_SQL} s ON e.user_id = s.id WHERE e.value >= 5""")
def stream_after_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that filters and labels a table goes on while upstream rows are deleted and rewritten.

    The first step is there when it starts; the others arrive later and take back what it wrote before.
    """
    rows = frames.events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    source = Ledger(spark, scratch(spark, "ledger"), rows.schema)
    labelled = T.StructType([*rows.schema.fields, T.StructField("status", T.StringType())])
    gold, checkpoint = Ledger(spark, scratch(spark, "ledger"), labelled), scratch(spark, "checkpoint")
    status = frames.status(spark, sf_dir).withColumnRenamed("id", "user_id")

    def follow() -> None:
        changes = streaming.change_stream(source, max_files=2).where("value >= 5")
        streaming.follow(changes.join(status, "user_id", "left"), gold, checkpoint).awaitTermination()

    source.append(rows, 0)
    follow()
    source.delete_where(_DAY, 1)
    source.append(rows.where(_DAY).withColumn("value", F.col("value") + 1), 2)
    follow()
    return gold.as_of().select("event_id", "user_id", "value", "status")


@query("stream_counts_after_rewrite", f"""SELECT user_id, count(*) AS n,
    CAST(sum(CAST(value * 100 AS BIGINT)) AS BIGINT) AS hundredths FROM ({_REWRITTEN_SQL}) GROUP BY user_id""")
def stream_counts_after_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts and sums per device from which rewritten rows are taken back."""
    changes = streaming.change_stream(_rewritten(spark, sf_dir), max_files=2)
    path = scratch(spark, "counts")
    # As SQL rounds a number to a whole one.
    whole = changes.withColumn("hundredths", F.rint(F.col("value") * 100).cast("bigint"))
    streaming.rewrite_each_batch(streaming.signed_counts(whole, ["user_id"], ["hundredths"]), path,
                                 scratch(spark, "checkpoint"), "update").awaitTermination()
    return streaming.merge_counts(spark, path, ["user_id"])


@query("stream_label_refreshed", """SELECT CAST(e.user_id AS DOUBLE) AS id, e.event_id AS event,
        CASE WHEN s.s_acctbal < (CASE WHEN e.ts < TIMESTAMP '2024-01-15' THEN 3000 ELSE 6000 END)
             THEN 'damaged' WHEN s.s_suppkey IS NOT NULL THEN 'healthy' END AS status
    FROM events e LEFT JOIN supplier s ON e.user_id = s.s_suppkey""")
def stream_label_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One running stream; between two of its micro-batches the status table is replaced."""
    incoming, statuses, out = (scratch(spark, part) for part in ("incoming", "status", "labelled"))
    readings = frames.readings(frames.events(spark, sf_dir)).withColumnRenamed("ID", "id")
    first = F.col("TIMESTAMP") < F.lit("2024-01-15").cast("timestamp")

    def set_status(limit: int) -> None:
        healthy = F.when(F.col("s_acctbal") < limit, "damaged").otherwise("healthy").alias("status")
        write(frames.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), healthy), statuses, "overwrite")

    set_status(3000)
    readings.where(first).write.mode("append").parquet(incoming)
    running = streaming.label_refreshed(streaming.file_stream(spark, incoming, readings.schema),
                                        lambda: scan(spark, statuses), out, scratch(spark, "checkpoint"), trigger=None)
    try:
        running.processAllAvailable()
        set_status(6000)
        readings.where(~first).write.mode("append").parquet(incoming)
        running.processAllAvailable()
    finally:
        running.stop()
    return scan(spark, out).select("id", F.col("EVENT").alias("event"), "status")


def _shuffled_files(spark: SparkSession, sf_dir: str, columns: list[str]) -> str:
    """The events in several files, dealt by hash: every file holds all times."""
    files = scratch(spark, "incoming")
    frames.events(spark, sf_dir).select(*columns).repartition(6, F.xxhash64("event_id")).write.parquet(files)
    return files


_LATEST_SQL = """SELECT user_id, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@query("stream_dedup_latest", _LATEST_SQL)
def stream_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row per device from files in no order, a micro-batch per file."""
    files, out = _shuffled_files(spark, sf_dir, ["event_id", "user_id", "ts", "value"]), scratch(spark, "latest")
    stream = streaming.file_stream(spark, files, "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE", max_files=1)
    streaming.keep_latest(stream, ["user_id"], ["ts", "event_id"], out, scratch(spark, "checkpoint")).awaitTermination()
    return streaming.latest_rows(spark, out, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("stream_dedup_latest_windowed", _LATEST_SQL)
def stream_dedup_latest_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a state of open days only: files in the order of time, days leave the state behind the watermark."""
    files, out = scratch(spark, "incoming"), scratch(spark, "latest")
    rows = frames.events(spark, sf_dir).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    rows.repartitionByRange(6, "ts").write.parquet(files)
    stream = streaming.file_stream(spark, files, rows.schema, max_files=2).withWatermark("ts", "365 days")
    streaming.keep_latest(stream, ["user_id"], ["ts", "event_id"], out, scratch(spark, "checkpoint"),
                          F.window("ts", "1 day")).awaitTermination()
    return streaming.latest_rows(spark, out, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("stream_expectation_report", """
    SELECT 'id' AS rule, count(*) FILTER (WHERE user_id > 0) AS passed,
           count(*) FILTER (WHERE NOT coalesce(user_id > 0, false)) AS failed, count(*) AS total FROM events
    UNION ALL SELECT 'speed', count(*) FILTER (WHERE value >= 5),
           count(*) FILTER (WHERE NOT coalesce(value >= 5, false)), count(*) FROM events
    UNION ALL SELECT 'time', count(ts), count(*) - count(ts), count(*) FROM events""")
def stream_expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of a stream over all its micro-batches and a restart."""
    rules = [Rule("id", "user_id > 0", "drop"), Rule("speed", "value >= 5"), Rule("time", "ts IS NOT NULL", "fail")]
    files = _shuffled_files(spark, sf_dir, ["event_id", "user_id", "ts", "value"])
    late, landed, checkpoint, counts = (scratch(spark, part) for part in ("late", "landed", "checkpoint", "counts"))
    kept = scan(spark, files)
    ddl = "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"
    for part in (kept.where("event_id % 2 = 0"), kept.where("event_id % 2 <> 0")):
        part.write.mode("append").parquet(late)  # the second half is there only when the stream starts again
        checked = apply_rules(streaming.file_stream(spark, late, ddl, max_files=2), rules, "rules")
        with streaming.RuleLog(spark, "rules", counts) as log:
            log.finished(streaming.to_path(checked, landed, checkpoint))
    return streaming.rule_report(spark, counts, rules)


@query("checkpoint_root", "SELECT event_id, value FROM events")
def checkpoint_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that names no checkpoint keeps it below the session's folder: started again, it adds nothing."""
    name, conf = _name("rooted"), "spark.sql.streaming.checkpointLocation"
    before = spark.conf.get(conf, None)
    streaming.configure(spark, scratch(spark, "checkpoints"))
    try:
        for _ in range(2):
            stream = frames.events_stream(spark, sf_dir).select("event_id", "value")
            streaming.to_table(stream, name, name=name, path=f"{scratch_root(spark)}/{name}").awaitTermination()
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)
    return table(spark, name)


@query("stop_streams", "SELECT CAST(2 AS BIGINT) AS stopped, CAST(0 AS BIGINT) AS active, 2 * count(*) AS landed FROM events")
def stop_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams run side by side until both are stopped together; what they landed stays."""
    out = scratch(spark, "landed")
    running = [streaming.to_path(frames.events_stream(spark, sf_dir).select("event_id"), f"{out}/part={i}",
                                 scratch(spark, "checkpoint"), "1 second") for i in range(2)]
    for stream in running:
        stream.processAllAvailable()
    stopped = streaming.stop_all(spark)
    active = sum(stream.isActive for stream in running)
    landed = spark.read.schema("event_id BIGINT").parquet(*[f"{out}/part={i}" for i in range(2)])
    return landed.agg(F.lit(stopped).cast("bigint").alias("stopped"), F.lit(active).cast("bigint").alias("active"),
                      F.count("*").alias("landed"))
