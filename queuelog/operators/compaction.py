"""The sink's buffer: of the rows it holds between two flushes, the last one per key is sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelog.operators.indexing import ROWS_PER_BUCKET, dense_index


def _last_per(df: DataFrame, groups: list, seq: str) -> DataFrame:
    """The row with the greatest ``seq`` per group; tasks aggregate before the shuffle."""
    last = df.groupBy(*groups).agg(F.max_by(F.struct(*df.columns), F.col(seq)).alias("_last"))
    return last.select("_last.*")


def _window(ts: str, interval_ms: int) -> Column:
    """Start of the interval that a time lies in, in microseconds; rows without time share one, null."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return micros - F.pmod(micros, F.lit(interval_ms * 1000))


def compact_rows(df: DataFrame, producer: list[str], seq: str, keys: list[str], max_rows: int) -> DataFrame:
    """Flush after ``max_rows`` rows of a producer. ``seq`` is its dense row number from 0; 0 is off."""
    if max_rows <= 0:
        return df
    flush = (F.col(seq) - F.pmod(F.col(seq), F.lit(max_rows))).alias("_flush")
    return _last_per(df, [*producer, flush, *keys], seq)


def compact_interval(
    df: DataFrame, producer: list[str], seq: str, keys: list[str], ts: str, interval_ms: int
) -> DataFrame:
    """Flush whenever ``interval_ms`` of time passed; 0 is off."""
    if interval_ms <= 0:
        return df
    flush = _window(ts, interval_ms).alias("_flush")
    return _last_per(df, [*producer, flush, *keys], seq)


def compact(
    df: DataFrame,
    producer: list[str],
    order: list[str],
    keys: list[str],
    ts: str,
    max_rows: int,
    interval_ms: int,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Flush at the row limit or the interval, whichever comes first; both must be on.

    A flush by time starts the row count anew.
    """
    if max_rows <= 0 or interval_ms <= 0:
        return df
    group = [*producer, "_window"]
    timed = df.withColumn("_window", _window(ts, interval_ms))
    rows = dense_index(timed, group, order, "_seq", rows_per_bucket=rows_per_bucket)
    return compact_rows(rows, group, "_seq", keys, max_rows).select(df.columns)
