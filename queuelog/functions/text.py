"""String fields to typed columns, as native expressions.

Rules differ from Spark's own casts: numbers allow no surrounding blanks, booleans only
true/false/1/0, timestamps may be epoch milliseconds. A value in the null set is null
before anything else. Bad input fails the query, or gives null with ``strict=False``.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.functions.binary import FieldType, as_time, has_time_type

# What each kind of text looks like.
INTEGER = r"^[+-]?[0-9]+$"
FLOATING = r"^\s*[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?))\s*$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE = r"^\s*([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\s*$"
TIMESTAMP = r"^\s*([0-9]{4})-([0-9]{1,2})-([0-9]{1,2}) ([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})(\.[0-9]{1,9})?\s*$"
BASE64 = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}(==)?|[A-Za-z0-9+/]{3}=?)?$"


def _bad(c: Column, what: str, to: str, strict: bool) -> Column:
    if not strict:
        return F.lit(None).cast(to)
    return F.raise_error(F.concat(F.lit(f"not {what}: "), c)).cast(to)


def _checked(c: Column, ok: Column, value: Column, what: str, to: str, strict: bool) -> Column:
    """``value`` where ``ok`` and not null, else the error; computes ``value`` once."""
    found = F.when(ok, value)
    return F.coalesce(found, F.when(c.isNotNull(), _bad(c, what, to, strict))) if strict else found


def str_numeric(c: Column, to: str, strict: bool = True) -> Column:
    """byte, short, int, long, float or double."""
    if to in ("float", "double"):
        # a trailing type letter is allowed and says nothing
        return _checked(c, c.rlike(FLOATING), F.regexp_replace(F.trim(c), "[fFdD]$", "").try_cast(to), f"a {to}", to, strict)
    return _checked(c, c.rlike(INTEGER), c.try_cast(to), f"a {to}", to, strict)


def str_bigint(c: Column, strict: bool = True) -> Column:
    return _checked(c, c.rlike(INTEGER), c.try_cast("decimal(38,0)"), "an integer of 38 digits", "decimal(38,0)", strict)


def str_decimal(c: Column, precision: int, scale: int, strict: bool = True) -> Column:
    """Rounded half up to the scale; a number too large for the precision is null."""
    to = f"decimal({precision},{scale})"
    return (
        F.when(c.isNull(), None)
        .when(c.rlike(DECIMAL), c.try_cast(to))
        .otherwise(_bad(c, "a decimal", to, strict))
    )


def str_boolean(c: Column, strict: bool = True) -> Column:
    word = F.lower(c)
    return (
        F.when(c.isNull(), None)
        .when(word.isin("true", "1"), F.lit(True))
        .when(word.isin("false", "0"), F.lit(False))
        .otherwise(_bad(c, "a boolean", "boolean", strict))
    )


def str_string(c: Column) -> Column:
    return c


def str_bytes(c: Column, raw: bool = False) -> Column:
    """Bytes of the text; with ``raw``, its base64 content, null where it is not base64."""
    return F.when(c.rlike(BASE64), F.unbase64(c)) if raw else c.cast("binary")


def _day(c: Column, pattern: str) -> Column:
    """The date in the text. Days past the end of a month run on into the next one."""
    year, month, day = (F.regexp_extract(c, pattern, i).try_cast("int") for i in (1, 2, 3))
    valid = month.between(1, 12) & day.between(1, 31)
    return F.when(valid, F.date_add(F.make_date(year, month, F.lit(1)), day - 1))


def str_timestamp(c: Column, strict: bool = True, raw: bool = False) -> Column:
    """Epoch milliseconds, else ``yyyy-[m]m-[d]d hh:mm:ss[.f]`` in the session time zone."""
    if raw:
        return str_numeric(c, "bigint", strict)
    millis = F.when(c.rlike(INTEGER), F.timestamp_millis(c.try_cast("bigint")))
    hours, minutes, seconds = (F.regexp_extract(c, TIMESTAMP, i).try_cast("int") for i in (4, 5, 6))
    plain = F.date_trunc("millisecond", c.try_cast("timestamp_ntz").cast("timestamp"))
    # parts past their range run on into the next; three digits of the fraction are kept
    fraction = F.rpad(F.substring(F.regexp_extract(c, TIMESTAMP, 7), 2, 3), 3, "0").try_cast("decimal(6,3)") / 1000
    wall = _day(c, TIMESTAMP).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hours, minutes, (seconds + F.coalesce(fraction, F.lit(0))).cast("decimal(18,6)")
    )
    written = F.when(c.rlike(TIMESTAMP), F.coalesce(plain, wall.cast("timestamp")))
    return _checked(c, F.lit(True), F.coalesce(millis, written), "a timestamp", "timestamp", strict)


def str_date(c: Column, strict: bool = True, raw: bool = False) -> Column:
    if raw:
        return str_numeric(c, "bigint", strict)
    # days past the end of their month take the long way
    return _checked(c, c.rlike(DATE), F.coalesce(c.try_cast("date"), _day(c, DATE)), "a date", "date", strict)


def str_time(c: Column, strict: bool = True, raw: bool = False, time_type: bool = False) -> Column:
    """Epoch milliseconds to the time of day."""
    millis = str_numeric(c, "bigint", strict)
    return millis if raw else as_time(F.timestamp_millis(millis), time_type)


def str_null_values(c: Column, null_values: Collection[str] | None) -> Column:
    return F.when(~c.isin(list(null_values)), c) if null_values else c


def decoder(declared: T.DataType | str, *, strict: bool = True, raw: bool = False, time_type: bool = False):
    kind = FieldType.of(declared)
    if isinstance(kind, T.DecimalType):
        if kind.precision == 38 and kind.scale == 0:
            return lambda c: str_bigint(c, strict)
        return lambda c: str_decimal(c, kind.precision, kind.scale, strict)
    simple = {
        T.StringType: str_string,
        T.BinaryType: lambda c: str_bytes(c, raw),
        T.BooleanType: lambda c: str_boolean(c, strict),
        T.TimestampType: lambda c: str_timestamp(c, strict, raw),
        T.DateType: lambda c: str_date(c, strict, raw),
        T.TimeType: lambda c: str_time(c, strict, raw, time_type),
    }
    if type(kind) in simple:
        return simple[type(kind)]
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return lambda c: str_numeric(c, kind.simpleString(), strict)
    raise TypeError(f"unsupported field type {kind.simpleString()}")


def decode_string_fields(
    df: DataFrame,
    fields: dict,
    *,
    null_values: Collection[str] | None = None,
    raw: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Replace string columns by their decoded values."""
    time_type = has_time_type(df)
    return df.withColumns(
        {
            name: decoder(kind, strict=strict, raw=raw, time_type=time_type)(
                str_null_values(F.col(name), null_values)
            )
            for name, kind in fields.items()
        }
    )
