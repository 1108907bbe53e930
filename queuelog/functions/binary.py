"""Big-endian binary fields to typed columns, as native expressions.

``decode_binary_fields(df, {"price": "double", "at": "timestamp"})`` replaces the named
binary columns. Too few bytes fail the query, or give null with ``strict=False``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _need(c: Column, n: int, value: Column, strict: bool) -> Column:
    """``value`` where the array holds ``n`` bytes; null stays null."""
    short = F.lit(None)
    if strict:
        short = F.raise_error(
            F.concat(F.lit(f"field needs {n} bytes but has "), F.length(c).cast("string"))
        )
    return F.when(c.isNull(), None).when(F.length(c) >= n, value).otherwise(short.cast("void"))


def _signed(c: Column, start: int, n: int) -> Column:
    """``n`` bytes from 1-based ``start`` as a signed bigint (two's complement)."""
    digits = F.hex(F.substring(c, start, n))
    if n < 8:  # extend the sign to 64 bits
        fill = F.when(F.substring(digits, 1, 1) >= "8", "F").otherwise("0")
        digits = F.concat(F.repeat(fill, F.lit(16 - 2 * n)), digits)
    return F.conv(digits, 16, -10).cast("bigint")


def _apart(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` computed once, out of the generated code around it.

    A long expression there makes a method that the JVM no longer compiles.
    """
    return F.get(F.transform(F.array(c), f), F.lit(0))


def bin_int(c: Column, strict: bool = True) -> Column:
    return _need(c, 4, _signed(c, 1, 4), strict).cast("int")


def bin_long(c: Column, strict: bool = True) -> Column:
    return _need(c, 8, _signed(c, 1, 8), strict).cast("bigint")


def bin_short(c: Column, strict: bool = True) -> Column:
    return _need(c, 2, _signed(c, 1, 2), strict).cast("smallint")


def bin_byte(c: Column, strict: bool = True) -> Column:
    """The first byte; null counts as 0."""
    return F.when(c.isNull(), F.lit(0)).otherwise(_need(c, 1, _signed(c, 1, 1), strict)).cast("tinyint")


def bin_boolean(c: Column, strict: bool = True) -> Column:
    return _need(c, 1, F.substring(c, 1, 1) != F.lit(b"\x00"), strict).cast("boolean")


def _ieee754(bits: Column, fraction_bits: int, exponent_bits: int) -> Column:
    """The floating-point number with these bits. Every step is exact in double precision."""
    bias = 2 ** (exponent_bits - 1) - 1
    top = 2**exponent_bits - 1
    fraction = bits.bitwiseAND(F.lit(2**fraction_bits - 1).cast("bigint")).cast("double")
    exponent = F.shiftright(bits, fraction_bits).bitwiseAND(F.lit(top).cast("bigint"))
    sign_bit = F.shiftrightunsigned(bits, fraction_bits + exponent_bits).bitwiseAND(F.lit(1).cast("bigint"))
    sign = F.when(sign_bit == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    two = F.lit(2.0)
    magnitude = (
        F.when((exponent == top) & (fraction != 0), F.lit(math.nan))
        .when(exponent == top, F.lit(math.inf))
        .when(exponent == 0, fraction * F.lit(2.0 ** (1 - bias - fraction_bits)))
        .otherwise((F.lit(1.0) + fraction * F.lit(2.0**-fraction_bits)) * F.pow(two, exponent - bias))
    )
    return sign * magnitude


def bin_float(c: Column, strict: bool = True) -> Column:
    return _need(c, 4, _apart(_signed(c, 1, 4), lambda bits: _ieee754(bits, 23, 8)), strict).cast("float")


def bin_double(c: Column, strict: bool = True) -> Column:
    return _need(c, 8, _apart(_signed(c, 1, 8), lambda bits: _ieee754(bits, 52, 11)), strict).cast("double")


def bin_string(c: Column, charset: str = "UTF-8") -> Column:
    """Text; null becomes the empty string, malformed UTF-8 becomes U+FFFD."""
    if charset.upper() in ("UTF-8", "UTF8"):
        text = F.make_valid_utf8(c.cast("string"))
    else:
        text = F.decode(c, charset)
    return F.coalesce(text, F.lit(""))


def bin_bytes(c: Column) -> Column:
    return c


def bin_timestamp(c: Column, strict: bool = True) -> Column:
    return F.timestamp_millis(bin_long(c, strict))


def bin_date(c: Column, strict: bool = True) -> Column:
    """Date of the epoch milliseconds in the session time zone."""
    return F.to_date(bin_timestamp(c, strict))


def time_of_day_millis(at: Column) -> Column:
    """Milliseconds since midnight of a timestamp in the session time zone."""
    return (
        (F.hour(at) * 3600 + F.minute(at) * 60).cast("bigint") * 1000
        + (F.date_part(F.lit("SECOND"), at) * 1000).cast("bigint")
    )


def as_time(at: Column, time_type: bool) -> Column:
    """``TIME`` where the session has that type, else milliseconds of the day."""
    if time_type:
        return F.make_time(F.hour(at), F.minute(at), F.date_part(F.lit("SECOND"), at))
    return time_of_day_millis(at)


def bin_time(c: Column, strict: bool = True, time_type: bool = False) -> Column:
    return as_time(bin_timestamp(c, strict), time_type)


def _sign_fill(c: Column) -> Column:
    return F.when(F.substring(F.hex(F.substring(c, 1, 1)), 1, 1) >= "8", "F").otherwise("0")


def _short_integer(c: Column) -> Column:
    """1 to 8 bytes of two's complement as a bigint."""
    digits = F.right(F.concat(F.repeat(_sign_fill(c), F.lit(14)), F.hex(c)), F.lit(16))
    return F.conv(digits, 16, -10).cast("bigint")


def _long_integer(c: Column, strict: bool) -> Column:
    """Two's complement of any length as decimal(38,0).

    The low 8 bytes are taken unsigned and the 8 before them signed; bytes further up may
    only repeat the sign.
    """
    n = F.length(c)
    fill = _sign_fill(c)
    negative = fill == "F"
    wide = F.right(F.concat(F.repeat(fill, 32 - 2 * n), F.hex(c)), F.lit(32))
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast("decimal(19,0)")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(20,0)")
    # a negative number is summed from both halves towards zero, so no step exceeds the result
    step = F.lit("18446744073709551616").cast("decimal(20,0)")
    high = F.when(negative, high + 1).otherwise(high).cast("decimal(38,0)")
    low = F.when(negative, low - step).otherwise(low)
    value = F.try_add(F.try_multiply(high, step).cast("decimal(38,0)"), low).cast("decimal(38,0)")
    extra = F.substring(F.hex(c), F.lit(1), 2 * n - 32)
    same_sign = (F.substring(wide, 1, 1) >= "8") == negative
    fits = (n <= 16) | ((extra == F.repeat(fill, 2 * n - 32)) & same_sign)
    if not strict:
        return F.when(fits, value)
    overflow = F.raise_error(F.lit("integer field needs more than 38 digits")).cast("decimal(38,0)")
    return F.coalesce(F.when(fits, value), F.when(n > 0, overflow))


def bin_bigint(c: Column, strict: bool = True) -> Column:
    value = F.when(F.length(c) <= 8, _short_integer(c).cast("decimal(38,0)")).otherwise(
        _apart(c, lambda b: _long_integer(b, strict))
    )
    return _need(c, 1, value, strict).cast("decimal(38,0)")


def bin_decimal(c: Column, precision: int, scale: int, strict: bool = True) -> Column:
    """4 bytes of scale, then the unscaled value. Fewer than 5 bytes give null."""
    digits = F.substring(c, F.lit(5), F.length(c) - 4)
    unscaled = F.when(F.length(c) <= 12, _short_integer(digits).cast("string")).otherwise(
        _apart(digits, lambda b: _long_integer(b, strict).cast("string"))
    )
    text = F.concat(unscaled, F.lit("E"), (-_signed(c, 1, 4)).cast("string"))
    to = f"decimal({precision},{scale})"
    value = text.cast(to) if strict else text.try_cast(to)
    return F.when(F.length(c) >= 5, value)


class FieldType:
    """Which decoder a declared Spark type selects; refused types are known but not decoded."""

    #: Name of the two's-complement integer without a scale; it is decoded to ``decimal(38,0)``.
    BIG_INTEGER = "biginteger"

    @staticmethod
    def of(declared: T.DataType | str) -> T.DataType:
        if not isinstance(declared, str):
            return declared
        if declared.strip().lower() == "time":
            return T.TimeType()
        return T.DataType.fromDDL(declared)

    refused = (T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)


def decoder(declared: T.DataType | str, *, strict: bool = True, charset: str = "UTF-8", time_type: bool = False):
    """A function column → column for the declared type; ``TypeError`` for unsupported ones."""
    if declared == FieldType.BIG_INTEGER:
        return lambda c: bin_bigint(c, strict)
    kind = FieldType.of(declared)
    if isinstance(kind, FieldType.refused):
        raise TypeError(f"binary fields of type {kind.simpleString()} cannot be decoded")
    if isinstance(kind, T.DecimalType):
        return lambda c: bin_decimal(c, kind.precision, kind.scale, strict)
    if isinstance(kind, T.StringType):
        return lambda c: bin_string(c, charset)
    if isinstance(kind, T.BinaryType):
        return bin_bytes
    if isinstance(kind, T.TimeType):
        return lambda c: bin_time(c, strict, time_type)
    plain = {
        T.ByteType: bin_byte, T.ShortType: bin_short, T.IntegerType: bin_int, T.LongType: bin_long,
        T.FloatType: bin_float, T.DoubleType: bin_double, T.BooleanType: bin_boolean,
        T.TimestampType: bin_timestamp, T.DateType: bin_date,
    }
    if type(kind) not in plain:
        raise TypeError(f"unsupported field type {kind.simpleString()}")
    return lambda c: plain[type(kind)](c, strict)


def has_time_type(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.timeType.enabled", "false")).lower() == "true"


def decode_binary_fields(
    df: DataFrame, fields: dict, *, strict: bool = True, charset: str = "UTF-8"
) -> DataFrame:
    """Replace binary columns by their decoded values; the types are checked before any job."""
    time_type = has_time_type(df)
    return df.withColumns(
        {
            name: decoder(kind, strict=strict, charset=charset, time_type=time_type)(F.col(name))
            for name, kind in fields.items()
        }
    )
