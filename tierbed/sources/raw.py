"""Raw layer: JSON lines, one object per line, NULL fields and non-ASCII text kept."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)


def write_raw(df: DataFrame, path: str, slices: int | None = None) -> None:
    """Write typed rows as JSON lines, into ``slices`` files when given."""
    out = df if slices is None else df.repartition(slices)
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_raw_records(records: DataFrame, path: str, slices: int | None = None) -> StructType:
    """Write the JSON texts of a ``record`` column, one line each; returns the fields they have.

    Line breaks, which JSON allows between tokens only, become blanks; nothing else changes.
    Without ``slices`` every task writes what it has read, so files follow the bytes of the
    splits and no record is shuffled. The fields are gathered by the write itself.
    """
    lines = records.select(F.translate("record", "\r\n", "  ").alias("record"))
    found = Observation()
    objects = F.when(F.ltrim("record").startswith("{"), F.try_parse_json("record"))
    out = lines if slices is None else lines.repartition(slices)
    observed = out.observe(found, F.schema_of_variant_agg(objects).alias("fields"))
    observed.write.mode("overwrite").text(path)
    return record_fields(found.get["fields"])


# A quoted name, or a type that Spark's DDL writes otherwise.
_NAME_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<>|OBJECT<")


def record_fields(schema: str) -> StructType:
    """Schema of records from that of variants, with the types that Spark gives to JSON lines:
    fractions are doubles; fields without a value or of several types are strings."""
    if not schema.startswith("OBJECT<") or schema == "OBJECT<>":  # no record is an object
        return StructType([])
    spelt = {"OBJECT<>": "STRING", "OBJECT<": "STRUCT<"}
    ddl = _NAME_OR_OBJECT.sub(lambda m: spelt.get(m[0], m[0]), schema)
    return _plain(DataType.fromDDL(ddl))


def _plain(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType), True) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType), True)
    if isinstance(kind, DecimalType) and kind.scale:
        return DoubleType()
    return StringType() if isinstance(kind, (VariantType, NullType)) else kind


def scan_raw(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read JSON lines.

    With a declared schema an absent field reads as NULL and a malformed line as a
    row of NULLs, in one pass. Without one, Spark reads the data once more to infer it.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def with_other_fields(
    spark: SparkSession, path: str, schema: StructType | str, found: StructType | None = None
) -> StructType:
    """``schema`` and, after it, every other field that the JSON lines have.

    ``found`` are the fields that the write of the lines has gathered; without them Spark reads the
    lines once more.
    """
    declared = spark.createDataFrame([], schema).schema
    found = scan_raw(spark, path).schema if found is None else found
    taken = {name.lower() for name in declared.names} | {"_corrupt_record"}
    return StructType([*declared.fields, *(f for f in found if f.name.lower() not in taken)])
