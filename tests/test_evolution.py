import json
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.operators.evolution import (
    decode_rescued, observed_schema, schema_with_hints, unknown_fields, widen,
)
from sensorloom.schemas import EVOLVING_HINTS
from sensorloom.session import scratch
from sensorloom.sources import from_json_lines, scan, write
from sensorloom.streaming import read_evolved, run_evolving, writers

# Sample records with every field, a new field, and fields of the wrong type.
BASE = ('{"AN3":-0.25,"AN4":1.5,"AN5":-3.75,"AN6":0.125,"AN7":2.0625,"AN8":-4.5,"AN9":0.75,'
        '"AN10":-0.375,"SPEED":6.25,"ID":12.0,"TIMESTAMP":"2024-03-05T06:07:08.000Z"')
PLAIN = BASE + "}"
NEW_COLUMN = BASE + ', "new_column": "test", "infos": {"wind_speed": 3.5, "wind_direction": "north"}}'
WRONG_TYPES = (BASE + ', "infos": {"wind_speed": "gusty", "wind_direction": "east"}}').replace(
    '"AN3":-0.25', '"AN3":"-0.25"')


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_hints_override_inferred_types(spark):
    inferred = observed_schema(lines(spark, NEW_COLUMN))
    hinted = schema_with_hints(inferred, EVOLVING_HINTS)
    assert isinstance(inferred["TIMESTAMP"].dataType, T.StringType)
    assert isinstance(hinted["TIMESTAMP"].dataType, T.TimestampType)
    assert hinted["infos"].dataType.simpleString() == "struct<wind_direction:string,wind_speed:float>"
    assert isinstance(hinted["AN3"].dataType, T.DoubleType) and "new_column" in hinted.names
    added = schema_with_hints(observed_schema(lines(spark, PLAIN)), EVOLVING_HINTS)
    assert added.names[-1] == "infos"


def test_inference_of_mixed_and_odd_values(spark):
    seen = observed_schema(lines(
        spark, '{"a": 1, "b": null, "c": [1, 2.5], "d": true}', '{"a": "x", "e": {"f": 10000000000}}', "broken", "[1]"))
    kinds = {f.name: f.dataType.simpleString() for f in seen.fields}
    assert kinds == {"a": "string", "b": "string", "c": "array<double>", "d": "boolean", "e": "struct<f:bigint>"}
    assert observed_schema(lines(spark, "broken")).fields == []


def test_unknown_fields_at_every_level(spark):
    known = T.StructType.fromDDL("a BIGINT, s STRUCT<x: STRING, t: STRUCT<y: INT>>")
    seen = observed_schema(lines(spark, '{"a": 1, "b": 2, "s": {"x": "1", "z": 1, "t": {"w": 1}}}'))
    assert sorted(unknown_fields(seen, known)) == ["b", "s.t.w", "s.z"]
    wide = widen(known, seen)
    assert unknown_fields(seen, wide) == [] and wide["a"].dataType == known["a"].dataType


def test_misfits_are_kept_beside_the_good_values(spark):
    schema = schema_with_hints(observed_schema(lines(spark, NEW_COLUMN)), EVOLVING_HINTS)
    df = lines(spark, NEW_COLUMN, WRONG_TYPES, "broken")
    out = {r["infos"]["wind_direction"] if r["infos"] else None: r for r in decode_rescued(df, schema).collect()}
    assert out["north"]["_incorrect_data"] is None and out["north"]["AN3"] == -0.25
    wrong = out["east"]
    assert wrong["AN3"] is None and wrong["AN4"] == 1.5 and wrong["infos"]["wind_speed"] is None
    assert wrong["_incorrect_data"] == WRONG_TYPES and out[None]["_incorrect_data"] == "broken"
    only = decode_rescued(df, schema, fields_only=True).where("_incorrect_data IS NOT NULL")
    assert sorted(r[0] for r in only.select("_incorrect_data").collect()) == [
        "broken", '{"AN3":"-0.25","infos":{"wind_speed":"gusty"}}']


def test_stream_widens_and_restarts(spark):
    path, out, checkpoint = (scratch(spark, f"evolve-{p}") for p in ("in", "out", "ck"))
    write(lines(spark, PLAIN), path, "append", "text")
    assert run_evolving(spark, path, out, EVOLVING_HINTS, checkpoint) == 1
    assert run_evolving(spark, path, out, EVOLVING_HINTS, checkpoint) == 0
    write(lines(spark, NEW_COLUMN), path, "append", "text")
    write(lines(spark, WRONG_TYPES), path, "append", "text")
    assert run_evolving(spark, path, out, EVOLVING_HINTS, checkpoint) == 1
    found = read_evolved(spark, out)
    assert found.count() == 3
    assert rows(found.select("new_column", "infos.wind_direction", F.col("_incorrect_data").isNotNull())) == sorted(
        [(None, None, False), ("test", "north", False), (None, "east", True)], key=repr)
    assert found.where("TIMESTAMP = '2024-03-05 06:07:08'").count() == 3


def test_new_fields_in_several_files(spark):
    path, out, checkpoint = (scratch(spark, f"evolve-{p}") for p in ("in", "out", "ck"))
    for i in range(3):
        write(lines(spark, f'{{"a": {i}, "f{i}": {i}}}'), path, "append", "text")
    restarts = run_evolving(spark, path, out, "a BIGINT", checkpoint, max_files=1)
    assert restarts == 3
    found = read_evolved(spark, out)
    assert rows(found.select("a", "f0", "f1", "f2")) == sorted(
        [(0, 0, None, None), (1, None, 1, None), (2, None, None, 2)], key=repr)


def test_an_accepted_batch_is_read_once(spark):
    path, out, checkpoint = (scratch(spark, f"once-{p}") for p in ("in", "out", "ck"))
    text = "\n".join(f'{{"a": {i}}}' for i in range(500))
    write(lines(spark, *text.split("\n")), path, "append", "text")
    counter = writers._RowCounter()
    spark.streams.addListener(counter)
    try:
        assert run_evolving(spark, path, out, "a BIGINT", checkpoint) == 0
        for _ in range(100):
            if counter._ended and all(e.is_set() for e in counter._ended.values()):
                break
            time.sleep(0.1)
        assert list(counter._rows.values()) == [500]
    finally:
        spark.streams.removeListener(counter)
    write(lines(spark, '{"a": 1, "b": 2}'), path, "append", "text")
    assert run_evolving(spark, path, out, "a BIGINT", checkpoint) == 1
    left = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    names = [f.getPath().getName() for f in left.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(left)]
    assert not [n for n in names if n.startswith("_aside")] and read_evolved(spark, out).count() == 501


def test_other_errors_are_raised(spark, monkeypatch):
    from sensorloom.streaming import evolve

    path, out, checkpoint = (scratch(spark, f"evolve-{p}") for p in ("in", "out", "ck"))
    write(lines(spark, '{"a": 1}'), path, "append", "text")

    def fail(*args, **kwargs):
        raise OSError("disk is gone")

    monkeypatch.setattr(evolve, "decode_rescued", fail)
    with pytest.raises(Exception, match="disk is gone"):
        run_evolving(spark, path, out, "a BIGINT", checkpoint)


def test_json_literals(spark):
    df = from_json_lines(spark, [NEW_COLUMN, PLAIN])
    assert df.count() == 2 and df.where("new_column = 'test'").count() == 1
    assert rows(from_json_lines(spark, ['{"a": 1}'], "a DOUBLE")) == [(1.0,)]


def test_merged_schema_of_appended_files(spark):
    path = scratch(spark, "merge")
    write(spark.createDataFrame([(1,)], "a INT"), path)
    wider = spark.createDataFrame([(2, "x")], "a INT, b STRING")
    with pytest.raises(ValueError, match="merge_schema"):
        write(wider, path)
    write(wider, path, merge_schema=True)
    assert rows(scan(spark, path, mergeSchema=True)) == [(1, None), (2, "x")]


def test_field_names_are_never_types(spark):
    record = {"FLOAT_LEVEL": 1.5, "OBJECT<x": 1, "VOID": None, "DECIMAL(3,0)": "a", "a:b": {"c,d": [1, 2.5], "e`f": [{"q": True}]},
              "g<h": [], "sp ace": {}, "VARIANT": [1, "a"], "n": 3.0}
    kinds = {f.name: f.dataType.simpleString() for f in observed_schema(lines(spark, json.dumps(record))).fields}
    assert kinds == {"FLOAT_LEVEL": "double", "OBJECT<x": "bigint", "VOID": "string", "DECIMAL(3,0)": "string",
                     "a:b": "struct<c,d:array<double>,e`f:array<struct<q:boolean>>>", "g<h": "array<string>",
                     "sp ace": "struct<>", "VARIANT": "array<string>", "n": "double"}


def test_batches_of_another_checkpoint_stay(spark):
    path, out = scratch(spark, "twice-in"), scratch(spark, "twice-out")
    lines(spark, '{"batch_id":1,"ID":5}').write.text(path)
    for turn in range(2):
        run_evolving(spark, path, out, "ID BIGINT", scratch(spark, f"checkpoint-{turn}"))
    assert [tuple(r) for r in read_evolved(spark, out).select("batch_id", "ID").collect()] == [(1, 5), (1, 5)]
