"""The owner of a queue among n readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the low 31 bits.
_LOW31 = 0x7FFFFFFF


def string_hash(text: Column) -> Column:
    """The JVM string hash (h = 31·h + c over UTF-16 units), low 31 bits only.

    Those bits are all the owner rule looks at. A character above U+FFFF counts as its two
    surrogates.
    """
    mask = F.lit(_LOW31).cast("bigint")

    def step(h: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        high = F.lit(0xD800) + F.shiftright(code - 0x10000, 10)
        low = F.lit(0xDC00) + (code - 0x10000).bitwiseAND(F.lit(0x3FF).cast("bigint"))
        return F.when(code < 0x10000, (h * 31 + code).bitwiseAND(mask)).otherwise(
            ((h * 31 + high).bitwiseAND(mask) * 31 + low).bitwiseAND(mask)
        )

    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), step)


def queue_owner(n: int, topic: str = "topic", broker: str = "broker_name", queue: str = "queue_id") -> Column:
    if n <= 0:
        raise ValueError("number of readers must be positive")
    base = string_hash(F.concat(F.col(topic), F.lit("-"), F.coalesce(F.col(broker), F.lit("null"))))
    start = (base * 31).bitwiseAND(F.lit(_LOW31).cast("bigint")) % n
    return ((start + F.col(queue)) % n).cast("int")
