"""Which queue of the topic a row goes to. A partitioner is a column of queue numbers 0..n-1."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelog.operators.indexing import ROWS_PER_BUCKET, dense_index

QUEUE = "queue_id"


class Partitioner:
    """Base of user partitioners.

    ``queue`` gets the row as a struct, the key column (or ``None``), the encoded body, the
    topic, and the number of queues, and returns the queue number as a column.
    """

    def queue(self, row: Column, key: Column | None, body: Column, topic: str, n: int) -> Column:
        raise NotImplementedError


def _check(n: int) -> None:
    if n <= 0:
        raise ValueError("the topic has no queues")


def fixed(df: DataFrame, n: int, producer: str | None = None) -> DataFrame:
    """All rows of a producer (a column, else the writing task) go to one queue."""
    _check(n)
    if producer is None:
        return df.withColumn(QUEUE, (F.spark_partition_id() % n).cast("int"))
    id_ = F.col(producer)
    checked = F.when(id_ >= 0, id_ % n).otherwise(F.raise_error(F.lit("producer id cannot be negative")).cast("int"))
    return df.withColumn(QUEUE, checked.cast("int"))


def round_robin(
    df: DataFrame,
    n: int,
    producer: str | None = None,
    order: list[str] | None = None,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Each producer cycles through the queues.

    With a producer column, its rows are counted in ``order``, however many it has. Without,
    the writing task is the producer and its rows are counted as they come; no shuffle.
    """
    _check(n)
    if producer is None:
        row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        return df.withColumn(QUEUE, F.pmod(row_in_task, F.lit(n)).cast("int"))
    if not order:
        raise ValueError("round-robin by producer needs an order of its rows")
    indexed = dense_index(df, [producer], order, "_turn", rows_per_bucket=rows_per_bucket)
    return indexed.withColumn(QUEUE, F.pmod("_turn", F.lit(n)).cast("int")).drop("_turn")


def load(name: str) -> Partitioner:
    """A partitioner by its full class name, ``package.module.Class``."""
    module, _, cls = name.rpartition(".")
    try:
        found = getattr(importlib.import_module(module), cls)
    except (ImportError, AttributeError, ValueError) as e:
        raise ValueError(f"no class to import as partitioner: '{name}'") from e
    if not (isinstance(found, type) and issubclass(found, Partitioner)):
        raise ValueError(f"'{name}' is not a subclass of {Partitioner.__module__}.Partitioner")
    return found()


def custom(
    df: DataFrame,
    n: int,
    choose: Partitioner | Callable[..., Column],
    *,
    topic: str,
    key: Column | None = None,
    body: Column | None = None,
) -> DataFrame:
    """The user's choice; a queue outside 0..n-1 fails."""
    _check(n)
    call = choose.queue if isinstance(choose, Partitioner) else choose
    row = F.struct(*df.columns)
    queue = call(row, key, body if body is not None else F.lit(None).cast("binary"), topic, n)
    checked = F.when(queue.between(0, n - 1), queue).otherwise(
        F.raise_error(F.concat(F.lit(f"partitioner chose a queue outside 0..{n - 1}: "),
                               F.coalesce(queue.cast("string"), F.lit("null")))).cast("int")
    )
    return df.withColumn(QUEUE, checked.cast("int"))


def assign_queue(
    df: DataFrame,
    partitioner: str | Partitioner | Callable[..., Column],
    n: int,
    *,
    topic: str,
    producer: str | None = None,
    order: list[str] | None = None,
    key: Column | None = None,
    body: Column | None = None,
) -> DataFrame:
    """Add ``queue_id`` by option value: default, fixed, round-robin, or the user's own."""
    if partitioner == "fixed":
        return fixed(df, n, producer)
    if partitioner in ("default", "round-robin"):
        return round_robin(df, n, producer if order else None, order)
    if isinstance(partitioner, str):
        partitioner = load(partitioner)
    return custom(df, n, partitioner, topic=topic, key=key, body=body)
