"""Message bodies to rows and back.

A format turns ``body`` into an array of structs: one per row, so a message may hold none
or many. ``decode`` explodes it; formats with one row per message skip the explode.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from queuelog.functions import avro, cdc
from queuelog.model import as_schema

# How times are written. All six fraction digits; Spark's default keeps three.
# Reading needs no pattern, Spark takes either form and any number of digits.
TIME_STANDARDS = {
    "SQL": {
        "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    },
    "ISO-8601": {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    },
}

ON_ERROR = ("fail", "null", "skip")


def parse_mode(on_error: str) -> dict[str, str]:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error should be one of {ON_ERROR}, but is '{on_error}'")
    return {"mode": "FAILFAST" if on_error == "fail" else "PERMISSIVE"}


def written_times(options: dict | None) -> dict[str, str]:
    standard = (options or {}).get("timestamp-format.standard", "SQL")
    if standard not in TIME_STANDARDS:
        raise ValueError(f"'timestamp-format.standard' should be one of {sorted(TIME_STANDARDS)}, but is '{standard}'")
    return TIME_STANDARDS[standard]


def _text(body: Column) -> Column:
    return body.cast("string")


def decode_json(body: Column, schema: T.StructType | str, on_error: str = "fail", required: bool = False) -> Column:
    """One JSON object as a struct. Null stays null; an array is an error, never its first item."""
    schema = as_schema(schema)
    text = _text(body)
    parsed = F.from_json(text, schema, parse_mode(on_error))
    array = F.lit(None)
    if on_error == "fail":
        array = F.raise_error(F.lit("message body is a JSON array, decode it with multi=True"))
    # the usual body is told by its first character
    value = F.when(text.startswith("{"), parsed).when(F.ltrim(text).startswith("["), array).otherwise(parsed)
    if required:  # every field must be there, though it may be null
        keys = F.json_object_keys(text)
        whole = F.size(F.array_except(F.array(*[F.lit(n) for n in schema.names]), keys)) == 0
        missing = F.raise_error(F.concat(F.lit("missing field in "), text)) if on_error == "fail" else F.lit(None)
        value = F.when(text.isNull() | whole, value).otherwise(missing)
    return value


def decode_json_array(body: Column, schema: T.StructType | str, on_error: str = "fail") -> Column:
    """A JSON array of objects, or one object, as an array of structs."""
    return F.from_json(_text(body), T.ArrayType(as_schema(schema)), parse_mode(on_error))


def decode_csv(body: Column, schema: T.StructType | str, on_error: str = "fail", options: dict | None = None) -> Column:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in as_schema(schema).fields)
    # an unquoted empty cell is null and a quoted one is the empty string, so null needs a name of its own
    return F.from_csv(_text(body), ddl, {"nullValue": "\x01", **parse_mode(on_error), **csv_options(options)})


def csv_options(options: dict | None) -> dict[str, str]:
    options = options or {}
    named = {"field-delimiter": "sep", "quote-character": "quote", "null-literal": "nullValue"}
    # a quote inside a quoted field is doubled, as in RFC 4180, and blanks belong to the value
    rules = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return {**rules, **{named[k]: v for k, v in options.items() if k in named}}


def decode_raw(body: Column, to: T.DataType | str, charset: str = "UTF-8") -> Column:
    """The whole body as one value: text, bytes, or a big-endian number."""
    from queuelog.functions import binary

    kind = binary.FieldType.of(to)
    if isinstance(kind, T.StringType):
        return _text(body) if charset.upper() == "UTF-8" else F.decode(body, charset)
    return F.when(body.isNotNull(), binary.decoder(kind)(body))


def encode_json(row: Column, options: dict | None = None) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false", **written_times(options)}).cast("binary")


def encode_csv(row: Column, options: dict | None = None) -> Column:
    return F.to_csv(row, {**TIME_STANDARDS["SQL"], **csv_options(options)}).cast("binary")


def encode_raw(row: Column, schema: T.StructType) -> Column:
    if len(schema) != 1 or not isinstance(schema[0].dataType, (T.StringType, T.BinaryType)):
        raise ValueError("format 'raw' writes exactly one string or binary column")
    return row[schema[0].name].cast("binary")


def well_formed_json(body: Column) -> Column:
    """True for JSON text, false for anything else, null for null."""
    return F.when(body.isNotNull(), F.try_parse_json(_text(body)).isNotNull())


def decode(
    messages: DataFrame,
    fmt: str,
    schema: T.StructType | str,
    *,
    on_error: str = "fail",
    multi: bool = False,
    options: dict | None = None,
    decoder: Callable[[Column], Column] | None = None,
    registry: dict[int, str] | None = None,
) -> DataFrame:
    """Append ``value`` (a struct of ``schema``), ``row_kind`` and ``is_tombstone`` to messages.

    A null body gives one row of nulls marked ``is_tombstone``. ``on_error`` is ``fail``,
    ``null`` (bad values become null) or ``skip`` (messages that do not parse are dropped).
    ``decoder`` replaces the format by a function column → struct, or array of structs.
    """
    schema = as_schema(schema)
    options = dict(options or {})
    body = F.col("body")
    lenient = "null" if on_error == "skip" else on_error
    if on_error == "skip" and fmt.endswith("json"):
        # an undecodable message is dropped; a decodable one keeps its other fields
        messages = messages.where(F.coalesce(well_formed_json(body), F.lit(True)))
    if on_error == "skip" and fmt == "csv" and decoder is None:
        messages = split_quarantine(messages, fmt, schema, options)[0]
    rows: Column | None = None  # array of (kind, value), for formats with several rows
    value: Column | None = None
    if decoder is not None:
        value = decoder(body)
        if multi:
            rows, value = F.transform(value, lambda v: F.struct(F.lit("+I").alias("kind"), v.alias("value"))), None
    elif fmt == "json" and multi:
        items = decode_json_array(body, schema, lenient)
        rows = F.transform(items, lambda v: F.struct(F.lit("+I").alias("kind"), v.alias("value")))
    elif fmt == "json":
        value = decode_json(body, schema, lenient, options.get("fail-on-missing-field") == "true")
    elif fmt == "csv":
        value = decode_csv(body, schema, lenient, options)
    elif fmt == "raw":
        if len(schema) != 1:
            raise ValueError("format 'raw' reads exactly one column")
        value = F.struct(decode_raw(body, schema[0].dataType, options.get("charset", "UTF-8")).alias(schema[0].name))
    elif fmt in cdc.DECODERS:
        parse, expand = cdc.DECODERS[fmt]
        messages = messages.withColumn("_parsed", parse(body, schema, parse_mode(lenient), options))
        rows = expand(F.col("_parsed"), schema, lenient == "fail")
    elif fmt == "avro":
        value = avro.decode_avro(body, schema)
    elif fmt == "avro-confluent":
        value = avro.decode_confluent(body, schema, registry)
    elif fmt == "debezium-avro-confluent":
        messages = messages.withColumn("_parsed", avro.decode_confluent(body, cdc.envelope(schema), registry))
        rows = cdc.expand_before_after(F.col("_parsed"), schema)
    else:
        raise ValueError(f"unknown format '{fmt}'")

    tombstone = body.isNull().alias("is_tombstone")
    if value is not None:
        return messages.select("*", value.alias("value"), F.lit("+I").alias("row_kind"), tombstone)
    # a null body keeps its one row of nulls; an empty array gives no row. In a changelog it changes
    # nothing (the delete came before it), so its row has no kind
    kind = F.lit(None).cast("string") if "_parsed" in messages.columns else F.lit("+I")
    one_null = F.array(F.struct(kind.alias("kind"), F.lit(None).cast(schema).alias("value")))
    items = F.when(body.isNull(), one_null).otherwise(rows)
    return (
        messages.select("*", tombstone, F.explode(items).alias("_row"))
        .select("*", F.col("_row.value").alias("value"), F.col("_row.kind").alias("row_kind"))
        .drop("_row", "_parsed")
    )


def decode_python(
    messages: DataFrame,
    open_decoder: Callable[[], Callable[[bytes | None], Iterable[dict]]],
    schema: T.StructType | str,
    keep: list[str] | None = None,
) -> DataFrame:
    """Decode bodies with Python code, where no expression can: each body to any number of rows.

    ``open_decoder`` is called once per task and gives the function from a body to its rows.
    Messages pass through in Arrow batches. ``keep`` names message columns to carry along.
    """
    schema = as_schema(schema)
    keep = list(keep or [])
    carried = messages.select(*keep, "body")
    out = T.StructType([*carried.schema.fields[:-1], *schema.fields])
    arrow, names = to_arrow_schema(out), schema.names

    def run(batches):
        decode_one = open_decoder()
        for batch in batches:
            made = ((i, row) for i, body in enumerate(batch.column("body")) for row in decode_one(body.as_py()))
            while part := list(itertools.islice(made, 4096)):  # a body may give any number of rows
                taken = pa.array([i for i, _ in part], pa.int64())
                columns = [batch.column(name).take(taken) for name in keep]
                columns += [pa.array([row.get(name) for _, row in part], arrow.field(name).type) for name in names]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return carried.mapInArrow(run, out)


def split_quarantine(
    messages: DataFrame, fmt: str, schema: T.StructType | str, options: dict | None = None
) -> tuple[DataFrame, DataFrame]:
    """(decodable messages, messages whose body does not parse) for json and csv."""
    fields = as_schema(schema)
    corrupt = "_corrupt_record"
    wider = T.StructType([*fields.fields, T.StructField(corrupt, T.StringType())])
    if fmt == "json":
        value = F.from_json(_text(F.col("body")), wider, {**parse_mode("null"), "columnNameOfCorruptRecord": corrupt})
    elif fmt == "csv":
        value = decode_csv(F.col("body"), wider, "null", options)
    else:
        raise ValueError(f"no quarantine for format '{fmt}'")
    marked = messages.withColumn("_bad", value[corrupt].isNotNull())
    return marked.where(~F.col("_bad")).drop("_bad"), marked.where("_bad").drop("_bad")


def encode(
    row: Column,
    fmt: str,
    schema: T.StructType,
    *,
    kind: Column | None = None,
    options: dict | None = None,
    encoder: Callable[[Column], Column] | None = None,
    avro_schema: str | None = None,
    schema_id: int | None = None,
) -> Column:
    """A struct column as a message body."""
    kind = F.lit("+I") if kind is None else kind
    if encoder is not None:
        return encoder(row)
    if fmt == "json":
        return encode_json(row, options)
    if fmt == "csv":
        return encode_csv(row, options)
    if fmt == "raw":
        return encode_raw(row, schema)
    if fmt in cdc.ENCODERS:
        return encode_json(cdc.ENCODERS[fmt](row, kind), options)
    if fmt == "avro":
        return avro.encode_avro(row, avro_schema)
    if fmt == "avro-confluent":
        return avro.encode_confluent(row, avro_schema, schema_id)
    if fmt == "debezium-avro-confluent":
        return avro.encode_confluent(cdc.before_after(row, kind, "op", "c", "d"), avro_schema, schema_id)
    raise ValueError(f"unknown format '{fmt}'")


# workers may not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
