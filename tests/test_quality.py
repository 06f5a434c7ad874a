import datetime as dt
import uuid

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sensorloom.functions import encode
from sensorloom.operators import quality
from sensorloom.operators.quality import ConstraintViolation, Rule, add_check, check
from sensorloom.plans import READING_RULES, gold, silver
from sensorloom.plans.facts import plan_text
from sensorloom.session import path_exists, scratch
from sensorloom.sources import create, insert, table, write


@pytest.fixture
def edge(spark):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(-1.0, 1.0, at), (0.0, -1.0, at), (1.0, 0.0, at), (None, None, at), (2.0, None, at)],
        "ID DOUBLE, SPEED DOUBLE, TIMESTAMP TIMESTAMP")


def test_drop_needs_a_true_predicate(edge):
    kept = quality.expect_or_drop(edge, "id", "ID > 0")
    assert [r.ID for r in kept.orderBy("ID").collect()] == [1.0, 2.0]
    lenient = quality.expect_or_drop(edge, "id", "ID > 0", null_passes=True)
    assert lenient.count() == 3


def test_zero_passes_the_constraint_and_fails_the_expectation(edge):
    positive = edge.where("ID >= 0")
    assert quality.check(positive, "id", "ID >= 0").count() == 3
    assert quality.expect_or_drop(positive, "id", "ID > 0").count() == 2


def test_warning_keeps_rows_and_counts(edge):
    seen = Observation("seen")
    kept = quality.expect(edge, "speed", "SPEED >= 0", observation=seen)
    assert kept.count() == 5
    assert seen.get == {"total": 5, "speed_passed": 2, "speed_failed": 3}


def test_fail_stops_even_if_nothing_reads_the_column(edge):
    with pytest.raises(Exception, match="rule 'id' failed"):
        quality.expect_or_fail(edge, "id", "ID > 0").agg(F.count("*")).collect()
    assert quality.expect_or_fail(edge, "time", "TIMESTAMP IS NOT NULL").count() == 5


def test_report_counts_every_rule(edge):
    report = quality.report(edge, [Rule("id", "ID > 0", "drop"), Rule("speed", "SPEED >= 0", null_passes=True)])
    assert rows(report) == [("id", 2, 3, 5), ("speed", 4, 1, 5)]


def test_rules_gather_counts_in_one_pass_and_do_not_parse_twice(edge):
    raw = encode(edge, "ID")
    seen = Observation("silver")
    out = silver(raw, "ID DOUBLE, SPEED DOUBLE, TIMESTAMP TIMESTAMP", READING_RULES, seen)
    assert plan_text(out).count("from_json") == 1
    assert out.count() == 2
    assert seen.get["id_failed"] == 3 and seen.get["timestamp_failed"] == 0 and seen.get["total"] == 5


def test_unknown_action():
    with pytest.raises(ValueError):
        Rule("x", "true", "ignore")


def test_table_constraints(spark):
    name = "checked_readings"
    create(spark, name, "id INT NOT NULL, status STRING", {"quality": "gold"}, "device's status", scratch(spark, name))
    good = spark.createDataFrame([(0, "healthy"), (5, None)], "id INT, status STRING")
    insert(good, name, ["id", "status"])
    with pytest.raises(ConstraintViolation):
        quality.add_check(spark, name, "positive", "id > 0")
    quality.add_check(spark, name, "known", "status IS NULL OR status IN ('healthy', 'damaged')")
    insert(quality.enforce(good, name), name, ["id"])
    assert table(spark, name).count() == 4
    for bad in [(None, "healthy"), (1, "odd")]:
        frame = spark.createDataFrame([bad], "id INT, status STRING")
        with pytest.raises(Exception, match="failed"):
            insert(quality.enforce(frame, name), name, ["id", "status"])
    assert table(spark, name).count() == 4
    spark.sql(f"DROP TABLE {name}")


def test_counts_reconcile_through_the_layers(edge, spark):
    raw = encode(edge, "ID")
    seen = Observation("layers")
    readings = silver(raw, "ID DOUBLE, SPEED DOUBLE, TIMESTAMP TIMESTAMP", READING_RULES, seen)
    n = readings.count()
    assert raw.count() == n + seen.get["id_failed"]
    status = spark.createDataFrame([(1, "healthy")], "id INT, status STRING")
    labelled = gold(readings, status)
    assert labelled.count() == n
    assert rows(labelled.select("id", "status")) == [(1.0, "healthy"), (2.0, None)]


def test_constraints_hold_on_every_writer(spark):
    from pyspark.errors import StreamingQueryException

    from sensorloom import streaming
    from sensorloom.sources import create, insert, write

    name, files = "held_rules", scratch(spark, "rows")
    create(spark, name, "id BIGINT NOT NULL, v DOUBLE", path=scratch(spark, name))
    quality.add_check(spark, name, "low", "v < 10")
    good, bad, null = (spark.createDataFrame([r], "id BIGINT, v DOUBLE") for r in ((1, 2.0), (2, 20.0), (None, 1.0)))
    insert(good, name, ["id", "v"])
    write(good, name)
    for rows in (bad, null):
        for attempt in (lambda r: insert(r, name, ["id", "v"]), lambda r: write(r, name)):
            with pytest.raises(Exception, match="rule"):
                attempt(rows)
    good.union(bad).write.parquet(files)
    stream = streaming.file_stream(spark, files, "id BIGINT, v DOUBLE")
    with pytest.raises(StreamingQueryException):
        streaming.to_table(stream, name, scratch(spark, "checkpoint")).awaitTermination()
    assert spark.table(name).count() == 2
    write(good, name, mode="overwrite")
    with pytest.raises(Exception, match="rule"):
        insert(bad, name, ["id", "v"])


def stored(spark, name):
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return rows(spark.table(name)), props, spark.catalog.getTable(name).description


@pytest.mark.parametrize("external", [False, True])
def test_refused_overwrite_changes_nothing(spark, external):
    name = f"kept_{uuid.uuid4().hex[:8]}"
    create(spark, name, "a BIGINT NOT NULL, b STRING", {"team": "me"}, "of mine",
           path=scratch(spark, name) if external else None)
    add_check(spark, name, "small", "a < 100")
    write(spark.createDataFrame([(1, "x"), (2, "y")], "a BIGINT, b STRING"), name)
    before = stored(spark, name)
    for bad in ([(3, "z"), (None, "q")], [(100, "z")]):
        with pytest.raises(Exception, match="rule"):
            write(spark.createDataFrame(bad, "a BIGINT, b STRING"), name, "overwrite")
        assert stored(spark, name) == before
    # A good one replaces the rows and keeps comment, properties and constraints; it may read the table itself.
    for n in (3, 4):
        write(spark.table(name).union(spark.createDataFrame([(n, "w")], "a BIGINT, b STRING")), name, "overwrite")
    found, props, comment = stored(spark, name)
    assert found == [(1, "x"), (2, "y"), (3, "w"), (4, "w")] and (props, comment) == before[1:]
    with pytest.raises(Exception, match="rule"):
        write(spark.createDataFrame([(None, "q")], "a BIGINT, b STRING"), name)
    left = [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect()]
    assert left == [name]


def test_overwrite_with_path_partitions_and_other_columns(spark):
    name, path = f"moved_{uuid.uuid4().hex[:8]}", scratch(spark, "moved")
    one = spark.createDataFrame([(1, "x"), (2, None)], "a BIGINT, p STRING")
    write(one, name, "overwrite", partition_by=["p"], path=path)
    other = spark.createDataFrame([(5, 0.5, "z")], "a BIGINT, c DOUBLE, p STRING")
    write(other, name, "overwrite", partition_by=["p"], path=path)
    assert rows(spark.table(name)) == [(5, 0.5, "z")] and not path_exists(spark, path)
    write(one, name, "overwrite")
    assert rows(spark.table(name)) == rows(one)


def test_name_lost_between_the_renames_is_found_again(spark):
    name = f"cut_{uuid.uuid4().hex[:8]}"
    write(spark.createDataFrame([(1,)], "a BIGINT"), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__before_x")
    write(spark.createDataFrame([(2,)], "a BIGINT"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]


def test_failed_overwrite_of_a_path_keeps_its_files(spark):
    path = scratch(spark, "path")
    write(spark.createDataFrame([(1,), (2,)], "a BIGINT"), path)
    failing = check(spark.createDataFrame([(3,), (None,)], "a BIGINT"), "there", "a IS NOT NULL")
    with pytest.raises(Exception, match="rule"):
        write(failing, path, "overwrite")
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    write(spark.read.parquet(path).where("a = 2"), path, "overwrite")
    assert rows(spark.read.parquet(path)) == [(2,)]
