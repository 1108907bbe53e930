"""Avro bodies, through Spark's avro module where the session has it."""

from __future__ import annotations

import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a registry body is a zero byte, the schema id in 4 bytes, then the record.
HEADER_BYTES = 5

_AVRO_TYPES = {
    T.StringType: "string", T.BinaryType: "bytes", T.IntegerType: "int", T.LongType: "long",
    T.FloatType: "float", T.DoubleType: "double", T.BooleanType: "boolean",
    T.ShortType: "int", T.ByteType: "int",
    T.TimestampType: {"type": "long", "logicalType": "timestamp-micros"},
    T.TimestampNTZType: {"type": "long", "logicalType": "local-timestamp-micros"},
    T.DateType: {"type": "int", "logicalType": "date"},
}


def require_module() -> None:
    spark = SparkSession.getActiveSession()
    loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        raise RuntimeError("avro formats need the spark-avro module on the class path") from None


def avro_schema(schema: T.StructType, name: str = "record") -> str:
    """The record schema of a table whose columns may all be null."""
    return json.dumps(_record(schema, name))


def _record(schema: T.StructType, name: str) -> dict:
    def field_type(kind: T.DataType, path: str):
        if isinstance(kind, T.StructType):
            return _record(kind, path)
        if isinstance(kind, T.DecimalType):
            return {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": ["null", field_type(kind.elementType, path)]}
        if isinstance(kind, T.MapType):
            return {"type": "map", "values": ["null", field_type(kind.valueType, path)]}
        return _AVRO_TYPES[type(kind)]

    return {
        "type": "record",
        "name": name,
        "fields": [
            {"name": f.name, "type": ["null", field_type(f.dataType, f"{name}_{f.name}")], "default": None}
            for f in schema.fields
        ],
    }


def schema_id(body: Column) -> Column:
    """Schema id in the header of a registry body."""
    return F.conv(F.hex(F.substring(body, 2, 4)), 16, 10).cast("bigint")


def payload(body: Column) -> Column:
    """The record after the header; a body without the header fails."""
    framed = (F.length(body) >= HEADER_BYTES) & (F.substring(body, 1, 1) == F.lit(b"\x00"))
    return F.when(body.isNull(), None).when(
        framed, F.substring(body, F.lit(HEADER_BYTES + 1), F.length(body) - HEADER_BYTES)
    ).otherwise(F.raise_error(F.lit("body has no schema header")).cast("binary"))


def decode_avro(body: Column, schema: T.StructType) -> Column:
    require_module()
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, avro_schema(schema), {"mode": "FAILFAST"})


def decode_confluent(body: Column, schema: T.StructType, registry: dict[int, str] | None) -> Column:
    """Decode by the writer's schema, looked up by id in the given registry."""
    require_module()
    if not registry:
        raise ValueError("avro-confluent needs the writer schemas by id")
    from pyspark.sql.avro.functions import from_avro

    reader = avro_schema(schema)
    value = F.when(body.isNull(), None)
    for number, writer in registry.items():
        value = value.when(
            schema_id(body) == number,
            from_avro(payload(body), writer, {"mode": "FAILFAST", "avroSchema": reader}),
        )
    return value.otherwise(F.raise_error(F.concat(F.lit("unknown schema id "), schema_id(body).cast("string"))))


def encode_avro(row: Column, writer: str | None = None) -> Column:
    require_module()
    from pyspark.sql.avro.functions import to_avro

    return to_avro(row, writer) if writer else to_avro(row)


def encode_confluent(row: Column, writer: str | None, number: int | None) -> Column:
    if number is None:
        raise ValueError("avro-confluent needs the schema id to write")
    header = b"\x00" + int(number).to_bytes(4, "big")
    return F.concat(F.lit(header), encode_avro(row, writer))
