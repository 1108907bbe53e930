import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.functions import avro, cdc, formats
from queuelog.model import as_schema

SCHEMA = T.StructType().add("id", "long").add("name", "string").add("at", T.TimestampNTZType())


def bodies(spark, values):
    rows = [(i, None if v is None else bytearray(v.encode() if isinstance(v, str) else v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, body binary")


def decode(spark, values, fmt, schema=SCHEMA, **kw):
    rows = formats.decode(bodies(spark, values), fmt, schema, **kw)
    return [(r["i"], r["row_kind"], None if r["value"] is None else r["value"].asDict(True), r["is_tombstone"])
            for r in rows.orderBy("i").collect()]


def values(spark, bodies_, fmt, **kw):
    return [v for _, _, v, _ in decode(spark, bodies_, fmt, **kw)]


def test_json_fields(spark):
    got = values(spark, ['{}', '{"id": 1, "extra": 2}', '{"name": null, "at": "2024-01-01T00:00:00.123456"}'], "json")
    assert got == [
        {"id": None, "name": None, "at": None},
        {"id": 1, "name": None, "at": None},
        {"id": None, "name": None, "at": datetime.datetime(2024, 1, 1, 0, 0, 0, 123456)},
    ]


def test_json_errors(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        values(spark, ["{bad"], "json")
    with pytest.raises(Exception, match="MALFORMED|CANNOT_PARSE"):
        values(spark, ['{"id": "x"}'], "json")
    with pytest.raises(PySparkException, match="JSON array"):
        values(spark, ['[{"id": 1}, {"id": 2}]'], "json")
    got = decode(spark, ["{bad", '{"id": "x", "name": "n"}', None, '{"id": 3}'], "json", on_error="skip")
    assert [i for i, *_ in got] == [1, 2, 3]
    assert got[0][2] == {"id": None, "name": "n", "at": None}
    assert values(spark, ["{bad"], "json", on_error="null") == [{"id": None, "name": None, "at": None}]


def test_json_required_fields(spark):
    options = {"fail-on-missing-field": "true"}
    assert values(spark, ['{"id": null, "name": "n", "at": null}'], "json", options=options) == [
        {"id": None, "name": "n", "at": None}]
    with pytest.raises(PySparkException, match="missing field"):
        values(spark, ['{"id": 1}'], "json", options=options)


def test_null_body(spark):
    for fmt in ("json", "csv"):
        assert decode(spark, [None], fmt) == [(0, "+I", None, True)]
    # a tombstone follows a delete and changes nothing
    assert decode(spark, [None], "debezium-json") == [(0, None, None, True)]
    assert decode(spark, [None], "json", multi=True) == [(0, "+I", None, True)]


def test_json_many_rows(spark):
    got = decode(spark, ["[]", '[{"id": 1}]', '[{"id": 2}, {"id": 3}, {"id": 4}]', '{"id": 5}'], "json", multi=True)
    assert [(i, v["id"]) for i, _, v, _ in got] == [(1, 1), (2, 2), (2, 3), (2, 4), (3, 5)]


def test_quarantine(spark):
    good, bad = formats.split_quarantine(bodies(spark, ["{bad", '{"id": 1}', None, '{"id": "x"}']), "json", SCHEMA)
    assert [r["i"] for r in good.orderBy("i").collect()] == [1, 2]
    assert [(r["i"], bytes(r["body"])) for r in bad.orderBy("i").collect()] == [(0, b"{bad"), (3, b'{"id": "x"}')]


def test_csv_quotes(spark):
    text = '7,"a ""quoted"", {""k"": 1}",2024-01-01T00:00:00.000001'
    assert values(spark, [text], "csv") == [
        {"id": 7, "name": 'a "quoted", {"k": 1}', "at": datetime.datetime(2024, 1, 1, 0, 0, 0, 1)}]
    with pytest.raises(Exception, match="MALFORMED"):
        values(spark, ["x,y,z"], "csv")


@pytest.mark.parametrize("fmt", ["json", "csv"])
@pytest.mark.parametrize("options", [{}, {"field-delimiter": "|", "null-literal": "-"}])
def test_round_trip(spark, fmt, options):
    if fmt == "json":
        options = {}
    at = datetime.datetime(2024, 2, 29, 23, 59, 59, 999999)
    rows = [(1, 'x,"y"|z', at), (2, "{}", None), (-3, "é\\ ", at), (None, " z", at), (4, "'", at), (5, "", at), (6, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    body = df.select(F.monotonically_increasing_id().alias("i"), formats.encode(F.struct(*SCHEMA.names), fmt, SCHEMA, options=options).alias("body"))
    got = formats.decode(body, fmt, SCHEMA, options=options).orderBy("i").select("value.*").collect()
    assert [tuple(r) for r in got] == rows


@pytest.mark.parametrize("standard, text", [
    ("SQL", "2024-01-01 02:03:04.000005"), ("ISO-8601", "2024-01-01T02:03:04.000005")])
def test_written_times(spark, standard, text):
    at = datetime.datetime(2024, 1, 1, 2, 3, 4, 5)
    schema = T.StructType().add("n", T.TimestampNTZType()).add("z", T.TimestampType())
    df = spark.createDataFrame([(at, at)], schema)
    body = df.select(formats.encode(F.struct("n", "z"), "json", schema, options={"timestamp-format.standard": standard}).alias("body"))
    assert json.loads(bytes(body.first()[0])) == {"n": text, "z": text + "Z"}
    assert tuple(formats.decode(body, "json", schema).select("value.*").first()) == (at, at)
    with pytest.raises(ValueError, match="timestamp-format.standard"):
        formats.encode_json(F.struct("n"), {"timestamp-format.standard": "x"})


def test_raw(spark):
    assert values(spark, ["text"], "raw", schema="v string") == [{"v": "text"}]
    assert values(spark, [b"\x00\x00\x00\x07"], "raw", schema="v int") == [{"v": 7}]
    with pytest.raises(ValueError, match="one column"):
        formats.decode(bodies(spark, ["x"]), "raw", SCHEMA)
    with pytest.raises(ValueError, match="one string or binary"):
        formats.encode(F.struct("a"), "raw", as_schema("a int"))


def row(**kw):
    return {"id": None, "name": None, "at": None, **kw}


CHANGES = [
    ("+I", row(id=1, name="a")),
    ("-U", row(id=1, name="a")),
    ("+U", row(id=1, name="b")),
    ("-D", row(id=1, name="b")),
]

ENVELOPES = {
    "debezium-json": [
        {"before": None, "after": {"id": 1, "name": "a"}, "op": "c"},
        {"before": {"id": 1, "name": "a"}, "after": {"id": 1, "name": "b"}, "op": "u"},
        {"before": {"id": 1, "name": "b"}, "after": None, "op": "d"},
    ],
    "ogg-json": [
        {"before": None, "after": {"id": 1, "name": "a"}, "op_type": "I"},
        {"before": {"id": 1, "name": "a"}, "after": {"id": 1, "name": "b"}, "op_type": "U"},
        {"before": {"id": 1, "name": "b"}, "after": None, "op_type": "D"},
    ],
    "maxwell-json": [
        {"data": {"id": 1, "name": "a"}, "type": "insert"},
        {"data": {"id": 1, "name": "b"}, "old": {"name": "a"}, "type": "update"},
        {"data": {"id": 1, "name": "b"}, "type": "delete"},
    ],
    "canal-json": [
        {"data": [{"id": 1, "name": "a"}], "old": None, "type": "INSERT"},
        {"data": [{"id": 1, "name": "b"}], "old": [{"name": "a"}], "type": "UPDATE"},
        {"data": [{"id": 1, "name": "b"}], "type": "DELETE"},
    ],
}


@pytest.mark.parametrize("fmt", sorted(ENVELOPES))
def test_changes(spark, fmt):
    got = decode(spark, [json.dumps(e) for e in ENVELOPES[fmt]], fmt)
    assert [(k, v) for _, k, v, _ in got] == CHANGES


@pytest.mark.parametrize("fmt", sorted(ENVELOPES))
def test_unknown_change_fails(spark, fmt):
    field = {"debezium-json": "op", "ogg-json": "op_type"}.get(fmt, "type")
    with pytest.raises(PySparkException, match="unknown or missing"):
        decode(spark, [json.dumps({field: "x"})], fmt)
    assert decode(spark, [json.dumps({field: "x"}), "{bad"], fmt, on_error="skip") == []


def test_changed_to_null_is_not_unchanged(spark):
    body = json.dumps({"data": {"id": 1, "name": "b"}, "old": {"name": None}, "type": "update"})
    assert [v["name"] for v in values(spark, [body], "maxwell-json")] == [None, "b"]
    body = json.dumps({"data": [{"id": 1, "name": None}, {"id": 2, "name": "x"}], "old": [{"name": "a"}, {"id": 9}], "type": "UPDATE"})
    assert [(v["id"], v["name"]) for v in values(spark, [body], "canal-json")] == [(1, "a"), (1, None), (9, "x"), (2, "x")]


@pytest.mark.parametrize("fmt", ["canal-json", "maxwell-json"])
def test_names_in_old(spark, fmt):
    """Numbers, nested rows and unknown fields of ``old`` come out as they are; names matter to updates only."""
    one = (lambda v: [v]) if fmt == "canal-json" else (lambda v: v)
    kinds = [k.upper() if fmt == "canal-json" else k for k in ("update", "insert")]
    schema = "id bigint, price decimal(38,18), at struct<x:int,y:array<string>>"
    data = {"id": 1, "price": 2, "at": {"x": 1, "y": ["a"]}}
    old = '{"price": 12345678901234567890.123456789012345678, "at": {"x": 2, "y": null}, "gone": true}'
    text = json.dumps({"data": one(data), "old": one("@"), "type": kinds[0]}).replace('"@"', old)
    new = json.dumps({"data": one(data), "old": one({"gone": [1]}), "type": kinds[1]})
    df = spark.createDataFrame([(text.encode(),), (new.encode(),)], "body binary")
    rows = formats.decode(df, fmt, schema).select("row_kind", "value.*")
    before, after, inserted = rows.collect()
    assert (before.row_kind, before.id, str(before.price)) == ("-U", 1, "12345678901234567890.123456789012345678")
    assert (before["at"].x, before["at"].y) == (2, None) and after["at"].y == ["a"] and inserted.row_kind == "+I"


def test_debezium_details(spark):
    snapshot = {"after": {"id": 1}, "op": "r"}
    assert decode(spark, [json.dumps(snapshot)], "debezium-json")[0][1] == "+I"
    wrapped = json.dumps({"schema": {}, "payload": snapshot})
    assert decode(spark, [wrapped], "debezium-json", options={"schema-include": "true"})[0][2]["id"] == 1
    with pytest.raises(PySparkException, match="'before' is null"):
        decode(spark, [json.dumps({"after": {"id": 1}, "op": "u"})], "debezium-json")


def test_canal_create_has_no_rows(spark):
    assert decode(spark, [json.dumps({"data": None, "type": "CREATE"})], "canal-json") == []


@pytest.mark.parametrize("fmt", sorted(cdc.ENCODERS))
def test_encoded_changes(spark, fmt):
    schema = as_schema("id bigint, name string")
    df = spark.createDataFrame([(i, k, v["id"], v["name"]) for i, (k, v) in enumerate(CHANGES)], "i int, k string, id bigint, name string")
    body = df.select("i", formats.encode(F.struct("id", "name"), fmt, schema, kind=F.col("k")).alias("body"))
    got = formats.decode(body, fmt, schema).orderBy("i").select("row_kind", "value.name").collect()
    assert [tuple(r) for r in got] == [("+I", "a"), ("-D", "a"), ("+I", "b"), ("-D", "b")]


def test_custom_decoder(spark):
    parts = lambda body: F.transform(F.split(body.cast("string"), " "), lambda w: F.struct(w.alias("word")))
    got = decode(spark, ["a b", "c"], "json", schema="word string", decoder=parts, multi=True)
    assert [v["word"] for _, _, v, _ in got] == ["a", "b", "c"]


def test_avro_header_and_schema(spark):
    df = bodies(spark, [b"\x00\x00\x00\x01\x02payload", None])
    got = df.orderBy("i").select(avro.schema_id(F.col("body")), avro.payload(F.col("body"))).collect()
    assert tuple(got[0]) == (258, b"payload") and tuple(got[1]) == (None, None)
    with pytest.raises(PySparkException, match="no schema header"):
        bodies(spark, [b"\x01abcd"]).select(avro.payload(F.col("body"))).collect()
    schema = json.loads(avro.avro_schema(SCHEMA))
    assert [f["type"][0] for f in schema["fields"]] == ["null"] * 3


def test_avro_without_the_module(spark):
    for fmt in ("avro", "avro-confluent", "debezium-avro-confluent"):
        with pytest.raises(RuntimeError, match="spark-avro"):
            formats.decode(bodies(spark, [b""]), fmt, SCHEMA, registry={1: "{}"})
