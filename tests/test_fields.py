import datetime
import math
import struct
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from queuelog.functions import binary, text

FEW = settings(max_examples=5, deadline=None)


def decode(spark, values, kind, **kw):
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, f binary")
    return [r["f"] for r in binary.decode_binary_fields(df, {"f": kind}, **kw).orderBy("i").collect()]


def parse(spark, values, kind, **kw):
    df = spark.createDataFrame(list(enumerate(values)), "i int, f string")
    return [r["f"] for r in text.decode_string_fields(df, {"f": kind}, **kw).orderBy("i").collect()]


def twos(n):
    return n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)


@pytest.mark.parametrize(
    "code, kind, low, high",
    [("i", "int", -(2**31), 2**31 - 1), ("q", "bigint", -(2**63), 2**63 - 1), ("h", "smallint", -(2**15), 2**15 - 1),
     ("b", "tinyint", -128, 127)],
)
def test_integers(spark, code, kind, low, high):
    @FEW
    @given(st.lists(st.integers(low, high), min_size=20, max_size=60))
    def run(values):
        values = [0, 1, -1, low, high, *values]
        assert decode(spark, [struct.pack(">" + code, v) for v in values], kind) == values

    run()


@pytest.mark.parametrize("code, kind, width", [("f", "float", 32), ("d", "double", 64)])
def test_floats(spark, code, kind, width):
    @FEW
    @given(st.lists(st.floats(width=width), min_size=20, max_size=60))
    def run(values):
        values = [0.0, -0.0, math.inf, -math.inf, math.nan, *values]
        got = decode(spark, [struct.pack(">" + code, v) for v in values], kind)
        for v, g in zip(values, got):
            assert (math.isnan(v) and math.isnan(g)) or (v == g and math.copysign(1, v) == math.copysign(1, g))

    run()


def test_big_integers(spark):
    @FEW
    @given(st.lists(st.integers(1 - 10**38, 10**38 - 1), min_size=10, max_size=40))
    def run(values):
        values = [0, 10**38 - 1, 1 - 10**38, 2**64, -(2**64), 2**63, -(2**63) - 1, *values]
        assert [int(v) for v in decode(spark, [twos(v) for v in values], "biginteger")] == values

    run()
    assert [int(v) for v in decode(spark, [b"\xff" * 30 + b"\x85", b"\x00" * 30 + b"\x85"], "biginteger")] == [-123, 133]
    assert decode(spark, [b"\x7f" + b"\xff" * 16], "biginteger", strict=False) == [None]
    with pytest.raises(PySparkException, match="38 digits"):
        decode(spark, [b"\x7f" + b"\xff" * 16], "biginteger")


def test_decimals(spark):
    def packed(d):
        sign, digits, exponent = Decimal(d).as_tuple()
        n = int("".join(map(str, digits))) * (-1 if sign else 1)
        return struct.pack(">i", -exponent) + twos(n)

    values = ["1.23", "-99999.5", "0", "123456789012345678.125"]
    got = decode(spark, [*map(packed, values), b"\0\0\0\0", None], "decimal(30,3)")
    assert got == [*map(Decimal, values), None, None]
    assert decode(spark, [packed("5.00")], "decimal(38,0)") == decode(spark, [packed("5.00")], "decimal(37,0)") == [5]


def test_nulls_and_short_input(spark):
    assert decode(spark, [None], "string") == [""]
    assert decode(spark, [None], "tinyint") == [0]
    for kind in ("int", "bigint", "double", "boolean", "timestamp", "decimal(38,0)"):
        assert decode(spark, [None], kind) == [None]
    for kind, size in (("int", 4), ("bigint", 8), ("smallint", 2), ("float", 4), ("double", 8), ("tinyint", 1), ("boolean", 1)):
        assert decode(spark, [b"\x01" * (size - 1)], kind, strict=False) == [None]
        with pytest.raises(PySparkException, match=f"needs {size} bytes"):
            decode(spark, [b"\x01" * (size - 1)], kind)


def test_text_and_flags(spark):
    assert decode(spark, ["é".encode(), b"\xffa", b""], "string") == ["é", "�a", ""]
    assert decode(spark, ["é".encode("latin-1")], "string", charset="ISO-8859-1") == ["é"]
    assert decode(spark, [b"\x00", b"\x01", b"\x02x"], "boolean") == [False, True, True]


def test_times(spark):
    at = [struct.pack(">q", v) for v in (1704067207179, 0, -1)]
    assert decode(spark, at, "timestamp") == [
        datetime.datetime(2024, 1, 1, 0, 0, 7, 179000), datetime.datetime(1970, 1, 1),
        datetime.datetime(1969, 12, 31, 23, 59, 59, 999000),
    ]
    assert decode(spark, at, "date") == [datetime.date(2024, 1, 1), datetime.date(1970, 1, 1), datetime.date(1969, 12, 31)]
    assert decode(spark, at, "time") == [7179, 0, 86399999]


def test_time_type(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        df = spark.createDataFrame([(bytearray(struct.pack(">q", 1704067207179)),)], "f binary")
        assert binary.decode_binary_fields(df, {"f": "time"}).first()[0] == datetime.time(0, 0, 7, 179000)
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "interval day to second", "interval year to month", "array<int>"])
def test_refused_types(spark, kind):
    df = spark.createDataFrame([(bytearray(b"1"), "1")], "f binary, s string")
    with pytest.raises(TypeError):
        binary.decode_binary_fields(df, {"f": kind})
    with pytest.raises(TypeError):
        text.decode_string_fields(df, {"s": kind})


def test_string_numbers(spark):
    assert parse(spark, ["1", "+1", "-128", None], "tinyint") == [1, 1, -128, None]
    lenient = parse(spark, [" 1", "1.5", "128", "", "x"], "tinyint", strict=False)
    assert lenient == [None] * 5
    for bad in (" 1", "1.5", "128", "", "x"):
        with pytest.raises(PySparkException, match="not a tinyint"):
            parse(spark, [bad], "tinyint")
    got = parse(spark, ["1e3", " .5 ", "5.", "1f", "-Infinity", "NaN"], "double")
    assert got[:5] == [1000.0, 0.5, 5.0, 1.0, -math.inf] and math.isnan(got[5])
    assert parse(spark, ["inf", "nan", "0x1p3"], "double", strict=False) == [None] * 3


def test_string_decimals(spark):
    assert parse(spark, ["1.25", "-1.25", "1e1", "99999"], "decimal(4,1)") == [Decimal("1.3"), Decimal("-1.3"), Decimal(10), None]
    with pytest.raises(PySparkException, match="not a decimal"):
        parse(spark, [" 1"], "decimal(4,1)")
    assert parse(spark, ["-" + "9" * 38], "decimal(38,0)") == [Decimal("-" + "9" * 38)]


def test_string_booleans(spark):
    assert parse(spark, ["true", "FALSE", "1", "0", None], "boolean") == [True, False, True, False, None]
    for bad in ("yes", "t", "", " true"):
        with pytest.raises(PySparkException, match="not a boolean"):
            parse(spark, [bad], "boolean")


def test_string_times(spark):
    at = datetime.datetime
    assert parse(spark, ["1704067207179", "2024-1-5 3:04:05.1239", "2024-02-30 25:00:00", "-5", None], "timestamp") == [
        at(2024, 1, 1, 0, 0, 7, 179000), at(2024, 1, 5, 3, 4, 5, 123000), at(2024, 3, 2, 1), at(1969, 12, 31, 23, 59, 59, 995000), None,
    ]
    for bad in ("x", "1704067207179 ", "2024-13-01 00:00:00", "2024-01-01"):
        with pytest.raises(PySparkException, match="not a timestamp"):
            parse(spark, [bad], "timestamp")
    assert parse(spark, ["2024-1-5", "2024-02-30", None], "date") == [datetime.date(2024, 1, 5), datetime.date(2024, 3, 1), None]
    with pytest.raises(PySparkException, match="not a date"):
        parse(spark, ["2024-13-01"], "date")
    assert parse(spark, ["1704067207179"], "time") == [7179]
    for kind in ("timestamp", "date", "time"):
        assert parse(spark, ["1704067207179"], kind, raw=True) == [1704067207179]


def test_string_bytes(spark):
    assert parse(spark, ["QUJD", "QQ", "QQ==", "Q", "QQ=", "!!", "QUJD QUJD", None], "binary", raw=True) == [
        b"ABC", b"A", b"A", None, None, None, None, None,
    ]
    assert parse(spark, ["ABC", None], "binary") == [b"ABC", None]


def test_null_values_come_first(spark):
    nulls = {"", "NULL", "\\N"}
    assert parse(spark, ["", "NULL", "\\N", "5", None], "int", null_values=nulls) == [None, None, None, 5, None]


def test_decoders_stay_native(spark):
    df = spark.createDataFrame([(bytearray(8), "1")], "b binary, s string")
    out = text.decode_string_fields(binary.decode_binary_fields(df, {"b": "double"}), {"s": "timestamp"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
