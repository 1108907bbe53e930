"""Change-data envelopes in JSON: one message to the changelog rows it stands for, and back.

Decoders give ``array<struct<kind, value>>``. Encoders write inserts and update-after rows
as the envelope's insert, deletes and update-before rows as its delete.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.model import DELETE, INSERT, UPDATE_AFTER, UPDATE_BEFORE


def _row(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"))


def _rows_type(schema: T.StructType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", schema)]))


def _unknown(what: str, op: Column, schema: T.StructType, strict: bool) -> Column:
    """Fails on an operation that is not known; no rows in lenient mode."""
    if not strict:
        return F.lit(None).cast(_rows_type(schema))
    text = F.concat(F.lit(f"unknown or missing {what}: "), F.coalesce(op, F.lit("null")))
    return F.raise_error(text).cast(_rows_type(schema))


def _present(value: Column, what: str, strict: bool) -> Column:
    """``value``, which a message of this kind must carry."""
    if not strict:
        return value
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"'{what}' is null in a change that needs it"))
    )


def envelope(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("before", schema), T.StructField("after", schema), T.StructField("op", T.StringType())]
    )


def expand_before_after(
    e: Column,
    schema: T.StructType,
    *,
    field: str = "op",
    inserts: tuple = ("c", "r"),
    update: str = "u",
    delete: str = "d",
    strict: bool = True,
) -> Column:
    """Rows of an envelope with ``before``, ``after`` and an operation field."""
    op = e[field]
    before = _present(e["before"], "before", strict)
    after = _present(e["after"], "after", strict)
    return (
        F.when(op.isin(*inserts), F.array(_row(INSERT, after)))
        .when(op == update, F.array(_row(UPDATE_BEFORE, before), _row(UPDATE_AFTER, after)))
        .when(op == delete, F.array(_row(DELETE, before)))
        .otherwise(_unknown(field, op, schema, strict))
    )


def _json(body: Column, shape: T.StructType, parse: dict) -> Column:
    return F.from_json(body.cast("string"), shape, parse)


def parse_debezium(body: Column, schema: T.StructType, parse: dict, options: dict) -> Column:
    if options.get("schema-include") == "true":
        return _json(body, T.StructType([T.StructField("payload", envelope(schema))]), parse)["payload"]
    return _json(body, envelope(schema), parse)


def expand_debezium(e: Column, schema: T.StructType, strict: bool) -> Column:
    return expand_before_after(e, schema, strict=strict)


def parse_ogg(body: Column, schema: T.StructType, parse: dict, options: dict) -> Column:
    shape = T.StructType(
        [T.StructField("before", schema), T.StructField("after", schema), T.StructField("op_type", T.StringType())]
    )
    return _json(body, shape, parse)


def expand_ogg(e: Column, schema: T.StructType, strict: bool) -> Column:
    return expand_before_after(
        e, schema, field="op_type", inserts=("I",), update="U", delete="D", strict=strict
    )


def _with_old_keys(body: Column, item: T.DataType, keys: str, update: str, parse: dict) -> Column:
    """``data``, ``old`` and ``type``, and next to them the names that ``old`` spells out.

    Null and missing look alike once typed, so the body of an update is read once more, for names alone."""
    shape = T.StructType([T.StructField("data", item), T.StructField("old", item), T.StructField("type", T.StringType())])
    e = _json(body, shape, parse)
    named = F.from_json(body.cast("string"), f"struct<old:{keys}>", {"mode": "PERMISSIVE"})["old"]
    return F.struct(e.alias("e"), F.when(e["type"] == update, named).alias("keys"))


def _before_image(after: Column, old: Column, old_keys: Column, schema: T.StructType) -> Column:
    """The earlier row: ``old`` holds changed fields only, the rest is as in ``after``."""
    return F.struct(
        *[
            F.when(F.map_contains_key(old_keys, f.name), old[f.name]).otherwise(after[f.name]).alias(f.name)
            for f in schema.fields
        ]
    )


def parse_canal(body: Column, schema: T.StructType, parse: dict, options: dict) -> Column:
    return _with_old_keys(body, T.ArrayType(schema), "array<map<string,string>>", "UPDATE", parse)


def expand_canal(parsed: Column, schema: T.StructType, strict: bool) -> Column:
    e, keys = parsed["e"], parsed["keys"]
    data, old, op = e["data"], e["old"], e["type"]

    def both(item: Column, i: Column) -> Column:
        earlier = _before_image(item, F.get(old, i), F.get(keys, i), schema)
        return F.array(_row(UPDATE_BEFORE, earlier), _row(UPDATE_AFTER, item))

    return (
        F.when(op == "INSERT", F.transform(data, lambda v: _row(INSERT, v)))
        .when(op == "UPDATE", F.flatten(F.transform(data, both)))
        .when(op == "DELETE", F.transform(data, lambda v: _row(DELETE, v)))
        .when(op == "CREATE", F.array().cast(_rows_type(schema)))
        .otherwise(_unknown("type", op, schema, strict))
    )


def parse_maxwell(body: Column, schema: T.StructType, parse: dict, options: dict) -> Column:
    return _with_old_keys(body, schema, "map<string,string>", "update", parse)


def expand_maxwell(parsed: Column, schema: T.StructType, strict: bool) -> Column:
    e, keys = parsed["e"], parsed["keys"]
    data, op = e["data"], e["type"]
    earlier = _before_image(data, e["old"], keys, schema)
    return (
        F.when(op == "insert", F.array(_row(INSERT, data)))
        .when(op == "update", F.array(_row(UPDATE_BEFORE, earlier), _row(UPDATE_AFTER, data)))
        .when(op == "delete", F.array(_row(DELETE, data)))
        .otherwise(_unknown("type", op, schema, strict))
    )


#: Body → parsed envelope, and parsed envelope → rows. Two steps, so that a plan can parse
#: a body once and refer to the result.
DECODERS = {
    "debezium-json": (parse_debezium, expand_debezium),
    "canal-json": (parse_canal, expand_canal),
    "maxwell-json": (parse_maxwell, expand_maxwell),
    "ogg-json": (parse_ogg, expand_ogg),
}


def _removes(kind: Column) -> Column:
    return kind.isin(DELETE, UPDATE_BEFORE)


def before_after(row: Column, kind: Column, field: str, insert: str, delete: str) -> Column:
    return F.struct(
        F.when(_removes(kind), row).alias("before"),
        F.when(~_removes(kind), row).alias("after"),
        F.when(_removes(kind), delete).otherwise(insert).alias(field),
    )


ENCODERS = {
    "debezium-json": lambda row, kind: before_after(row, kind, "op", "c", "d"),
    "ogg-json": lambda row, kind: before_after(row, kind, "op_type", "I", "D"),
    "canal-json": lambda row, kind: F.struct(
        F.array(row).alias("data"), F.when(_removes(kind), "DELETE").otherwise("INSERT").alias("type")
    ),
    "maxwell-json": lambda row, kind: F.struct(
        row.alias("data"), F.when(_removes(kind), "delete").otherwise("insert").alias("type")
    ),
}
