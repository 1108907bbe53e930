"""Event time and watermarks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelog.model import QUEUE_KEY


def with_event_time(df: DataFrame, delay: str | None = None, column: str = "store_timestamp") -> DataFrame:
    """Store time is the event time; with ``delay``, a stream gets a watermark on it."""
    return df.withWatermark(column, delay) if delay else df


def queue_watermarks(df: DataFrame, delay: str, column: str = "store_timestamp") -> DataFrame:
    """Watermark per queue: its latest time minus the delay."""
    latest = df.groupBy(QUEUE_KEY).agg(F.max(column).alias("max_ts"))
    return latest.withColumn("watermark", F.col("max_ts") - F.expr(f"interval {delay}"))


def combined_watermark(df: DataFrame, delay: str, column: str = "store_timestamp") -> DataFrame:
    """One row: the slowest queue decides."""
    return queue_watermarks(df, delay, column).agg(F.min("watermark").alias("watermark"))


def per_queue_watermarks(stream: DataFrame, queues: list[tuple[str, int]], delay: str, column: str = "store_timestamp") -> DataFrame:
    """A stream whose watermark follows its slowest queue.

    Spark keeps the minimum over the inputs of a union. Every queue reads the source once
    more, so this is for few queues, and ``queues`` must list all of them: rows of others
    fail rather than get lost.
    """
    def of(broker: str, queue: int) -> Column:
        return (F.col("broker_name") == broker) & (F.col("queue_id") == queue)

    listed = reduce(Column.__or__, [of(*q) for q in queues])
    name = F.concat_ws("-", "broker_name", F.col("queue_id").cast("string"))
    fail = F.raise_error(F.concat(F.lit("queue not listed: "), name)).cast("boolean")
    # the first branch looks at every row, the others only at their own
    first = F.when(of(*queues[0]), True).when(listed, False).otherwise(fail)
    conditions = [first, *[of(*q) for q in queues[1:]]]
    branches = [stream.where(c).withWatermark(column, delay) for c in conditions]
    return reduce(DataFrame.unionByName, branches)
