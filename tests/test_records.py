import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from sensorloom.functions import decode, encode, json_field, unit_bucket
from sensorloom.functions.predicates import instant_literal
from sensorloom.schemas import reading_schema
from sensorloom.streaming import message_stream

DDL = "ID DOUBLE, SPEED DOUBLE, TORQUE DOUBLE, TIMESTAMP TIMESTAMP"


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n INT, value STRING")


def test_bad_texts_keep_their_rows(spark):
    df = decode(texts(spark, '{"ID": 1, "SPEED"', "", None, "[1]", "{}"), DDL, keep=["n"])
    assert rows(df) == [(i, None, None, None, None) for i in range(5)]


def test_missing_wrong_and_misspelt_fields(spark):
    df = decode(texts(spark, '{"ID": 1, "SPEED": "fast"}', '{"id": 2, "SPEED": 3}', '{"SPEED": "NaN", "ID": 4}'), DDL, keep=["n"])
    found = rows(df.select("n", "ID", F.col("SPEED").cast("string")))
    assert found == [(0, 1.0, None), (1, None, "3.0"), (2, 4.0, "NaN")]


def test_round_trip_keeps_microseconds(spark):
    at = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(8.0, 6.55, None, at)], DDL)
    back = decode(encode(df, "ID"), DDL)
    assert rows(back) == rows(df)


def test_reading_schema_is_nullable_and_torque_is_optional():
    assert all(f.nullable for f in reading_schema().fields)
    assert "TORQUE" in reading_schema().names and "TORQUE" not in reading_schema(torque=False).names
    assert len(reading_schema().fields) == 12


def test_json_field_reaches_into_structs(spark):
    df = texts(spark, '{"infos": {"level": 3}}', '{"infos": {}}', "no json")
    value = json_field("value", "infos STRUCT<level: INT>", "infos.level")
    assert [r[0] for r in df.orderBy("n").select(value).collect()] == [3, None, None]


def test_message_keys_that_are_no_number_become_null(spark):
    df = spark.createDataFrame([("7", bytearray(b"{}")), ("x", bytearray(b"a")), (None, None)],
                               "partitionKey STRING, data BINARY")
    assert rows(message_stream(df)) == [(7.0, "{}"), (None, "a"), (None, None)]
    bus = spark.createDataFrame([(bytearray(b"5"), bytearray(b"v"))], "key BINARY, value BINARY")
    assert rows(message_stream(bus, "key", "value")) == [(5.0, "v")]
    with pytest.raises(NumberFormatException):
        df.select(F.col("partitionKey").cast("double")).collect()


def test_hash_buckets_are_stable_and_spread(spark):
    for method in ("xxhash64", "md5"):
        df = spark.range(10000).withColumn("b", unit_bucket("id", 1, method))
        low, high, below = df.agg(F.min("b"), F.max("b"), F.count_if(F.col("b") < 2**31)).first()
        assert 0 <= low and high < 2**32 and 4800 < below < 5200
        assert rows(df) == rows(df.repartition(7).withColumn("b", unit_bucket("id", 1, method)))
    with pytest.raises(ValueError):
        unit_bucket("id", method="crc")


def test_impossible_dates_are_rejected_before_a_job(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "ts TIMESTAMP")
    with pytest.raises(ValueError):
        instant_literal(df, "ts", "2020-00-01")
    assert df.where(F.col("ts") >= instant_literal(df, "ts", "2020-01-01")).count() == 1
