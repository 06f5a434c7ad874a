"""Schemas that are hinted, inferred and widened, and values that do not fit them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def observed_schema(lines: DataFrame, col: str = "value") -> T.StructType:
    """Schema of the JSON texts in ``col``, from one distributed aggregation.

    Whole numbers become BIGINT and other numbers DOUBLE; a field with mixed types, or with NULLs
    only, becomes STRING. Rows that are no JSON object are ignored.
    """
    return schema_of_text(lines.select(schema_text(col).alias("s")).first()["s"])


def schema_text(col: str = "value") -> Column:
    """The aggregate behind :func:`observed_schema`; it may also be observed while rows pass by."""
    return F.schema_of_variant_agg(F.when(F.col(col).rlike(r"^\s*\{"), F.try_parse_json(F.col(col))))


def schema_of_text(text: str | None) -> T.StructType:
    """The schema that :func:`schema_text` tells."""
    kind = _read_type(text, 0)[0] if text else None
    return kind if isinstance(kind, T.StructType) else T.StructType()


#: Variant type names and the column types they become; all others keep their name.
_KINDS = {"BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
          "TIMESTAMP_NTZ": T.TimestampNTZType(), "BINARY": T.BinaryType(), "STRING": T.StringType(),
          "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "VOID": T.StringType(), "VARIANT": T.StringType()}


def _read_type(text: str, at: int) -> tuple[T.DataType, int]:
    """The type written at ``at`` and the place after it. Names are never taken for types.

    A number such as 347.0 is seen as DECIMAL(3,0) and becomes DOUBLE.
    """
    if text.startswith("ARRAY<", at):
        inner, at = _read_type(text, at + len("ARRAY<"))
        return T.ArrayType(inner), at + 1
    if not text.startswith("OBJECT<", at):
        word = re.compile(r"\w+(\(\d+,\s*\d+\))?").match(text, at)
        name = word[0].split("(")[0]
        return (T.DoubleType() if name == "DECIMAL" else _KINDS.get(name, T.StringType())), word.end()
    at, fields = at + len("OBJECT<"), []
    while text[at] != ">":
        quoted = re.compile(r"`((?:[^`]|``)*)`: ").match(text, at)
        name = quoted or re.compile(r"([^:`]+): ").match(text, at)
        kind, at = _read_type(text, name.end())
        fields.append(T.StructField(name[1].replace("``", "`") if quoted else name[1], kind))
        at += 2 if text.startswith(", ", at) else 0
    return T.StructType(fields), at + 1


def schema_with_hints(inferred: T.StructType, hints: str | T.StructType) -> T.StructType:
    """``inferred`` with the hinted types put in, field by field and inside nested structs.

    Hinted fields that were not seen are added at the end.
    """
    hinted = T.StructType.fromDDL(hints) if isinstance(hints, str) else hints
    by_name = {f.name: f for f in hinted.fields}
    fields = []
    for field in inferred.fields:
        hint = by_name.pop(field.name, None)
        kind = field.dataType
        if hint is not None:
            both = isinstance(kind, T.StructType) and isinstance(hint.dataType, T.StructType)
            kind = schema_with_hints(kind, hint.dataType) if both else hint.dataType
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in by_name.values()])


def unknown_fields(observed: T.StructType, known: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of fields that ``known`` lacks, at every struct level."""
    names = {f.name: f.dataType for f in known.fields}
    missing = []
    for field in observed.fields:
        path = prefix + field.name
        if field.name not in names:
            missing.append(path)
        elif isinstance(field.dataType, T.StructType) and isinstance(names[field.name], T.StructType):
            missing += unknown_fields(field.dataType, names[field.name], path + ".")
    return missing


def widen(known: T.StructType, observed: T.StructType) -> T.StructType:
    """``known`` plus the fields only ``observed`` has. Known types never change."""
    seen = {f.name: f.dataType for f in observed.fields}
    fields = []
    for field in known.fields:
        kind, other = field.dataType, seen.pop(field.name, None)
        if isinstance(kind, T.StructType) and isinstance(other, T.StructType):
            kind = widen(kind, other)
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in seen.items()])


def decode_rescued(
    df: DataFrame,
    schema: T.StructType | str,
    col: str = "value",
    side: str = "_incorrect_data",
    fields_only: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decode JSON text and keep what does not fit in the column ``side``.

    Fields that fit are filled. ``side`` holds the whole text of a record with a misfit, or with
    ``fields_only`` a JSON object of just the values that did not fit; it is NULL for good records.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType(schema.fields + [T.StructField(side, T.StringType())])
    record = F.from_json(F.col(col), marked, {"columnNameOfCorruptRecord": side})
    if not fields_only:
        return df.select(*keep, record.alias("_record")).select(*keep, "_record.*")
    parsed = df.select(*keep, F.col(col).alias("_text"), record.alias("_record"))
    misfits = _misfits(schema, F.col("_record"), "$")
    # An empty object means the text itself was broken: keep it whole.
    found = F.to_json(F.struct(*misfits))
    rescued = F.when(
        F.col(f"_record.{side}").isNotNull(), F.when(found != "{}", found).otherwise(F.col("_text"))
    )
    return parsed.select(*keep, *[F.col("_record").getField(f.name).alias(f.name) for f in schema.fields],
                         rescued.alias(side))


def _misfits(schema: T.StructType, record: Column, path: str) -> list[Column]:
    """Per field the original text if the decoded value is missing, else NULL, which JSON leaves out."""
    out = []
    for field in schema.fields:
        value, where = record.getField(field.name), f"{path}['{field.name}']"
        if isinstance(field.dataType, T.StructType):
            inner = F.struct(*_misfits(field.dataType, value, where))
            out.append(F.when(F.to_json(inner) != "{}", inner).alias(field.name))
        else:
            text = F.get_json_object(F.col("_text"), where)
            out.append(F.when(value.isNull() & text.isNotNull(), text).alias(field.name))
    return out
