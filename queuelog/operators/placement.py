"""Rows of a queue on their owner among n readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelog.functions.hashing import queue_owner


def with_owner(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("owner", queue_owner(n))


def queue_affine_repartition(
    df: DataFrame, n: int, *, lanes: int = 1, rows_per_lane: int = 1_000_000
) -> DataFrame:
    """Place rows by owner. Each owner is ``lanes`` partitions wide.

    A queue may hold a large part of all rows, so with several lanes its offset runs of
    ``rows_per_lane`` take turns on them: partition = owner · lanes + lane. Rows of a run stay
    together and in order.
    """
    if lanes <= 0:
        raise ValueError("lanes must be positive")
    lane = F.pmod(F.expr(f"queue_offset div {int(rows_per_lane)}"), F.lit(lanes))
    target = (F.col("owner") * lanes + lane).cast("int")
    return with_owner(df, n).repartitionById(n * lanes, target).sortWithinPartitions("broker_name", "queue_id", "queue_offset")


def lanes_for(bounds: DataFrame, n: int, rows_per_partition: int) -> int:
    """Lanes so that the busiest owner's partitions hold about ``rows_per_partition`` rows."""
    busiest = (
        with_owner(bounds, n)
        .groupBy("owner")
        .agg(F.sum(F.col("end") - F.col("earliest")).alias("rows"))
        .agg(F.max("rows"))
        .first()[0]
    )
    return max(1, -(-(busiest or 0) // rows_per_partition))
