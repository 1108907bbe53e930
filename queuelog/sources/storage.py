"""Where the messages of a log lie, and which of them are committed.

    <log>/topic=<t>/batch=<n>-<txn>/part-*.parquet          messages
    <log>/_ranges/topic=<t>/batch=<n>-<txn>/part-*.parquet  offsets and times per queue
    <log>/_commits/topic=<t>/<n>-<txn>                      empty file: the batch counts
    <log>/_groups/group=<g>/topic=<t>/commit=<n>/...        offsets a consumer group committed

The commit file is the last thing a writer makes, and one listing shows all of them. Spark
skips names with a leading underscore when it lists data files. A plain parquet folder with
the message columns under ``topic=<t>`` also works as a log; then offset bounds come from a
scan of the key columns. Several writers may write at a time: a commit claims the state it goes on
from, ``<log>/_commits/topic=<t>/.after-<batch>``, and the one that comes second starts over.
``.done-<batch>`` beside it tells a batch whose commit file was taken away from one not finished yet.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.model import LOG_SCHEMA, RANGES_SCHEMA

_READ_SCHEMA = T.StructType([*LOG_SCHEMA.fields[1:], T.StructField("batch", T.StringType())])


class Folder:
    """The few file-system calls the layout needs, on whatever system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def children(self) -> list[str]:
        if not self._fs.exists(self._root):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._root)]

    def numbered(self, prefix: str) -> list[int]:
        """Numbers n of the children ``<prefix>=<n>``, ascending."""
        prefix += "="
        return sorted(int(n.removeprefix(prefix)) for n in self.children() if n.startswith(prefix))

    def has(self, name: str) -> bool:
        return self._fs.exists(self._jvm.org.apache.hadoop.fs.Path(self._root, name))

    def touch(self, name: str) -> None:
        self._fs.create(self._jvm.org.apache.hadoop.fs.Path(self._root, name), True).close()

    def claim(self, name: str, owner: str) -> str:
        """Make a file that only one can make; who made it, by the text inside."""
        path = self._jvm.org.apache.hadoop.fs.Path(self._root, name)
        try:
            out = self._fs.create(path, False)
        except Py4JJavaError:
            if not self._fs.exists(path):
                raise
            found = self._fs.open(path)
            try:
                return self._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
            finally:
                found.close()
        out.write(bytearray(owner.encode()))
        out.close()
        return owner

    def delete(self) -> None:
        self._fs.delete(self._root, True)


def data_path(log: str, topic: str) -> str:
    return f"{log.rstrip('/')}/topic={topic}"


def ranges_path(log: str, topic: str) -> str:
    return f"{log.rstrip('/')}/_ranges/topic={topic}"


def commits_path(log: str, topic: str) -> str:
    return f"{log.rstrip('/')}/_commits/topic={topic}"


def committed_batches(spark: SparkSession, log: str, topic: str) -> list[str]:
    """Names of committed batches in commit order."""
    return sorted(n for n in Folder(spark, commits_path(log, topic)).children() if not n.startswith("."))


def started_batches(spark: SparkSession, log: str, topic: str) -> list[str]:
    names = Folder(spark, data_path(log, topic)).children()
    return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))


def mark_committed(spark: SparkSession, log: str, topic: str, batch: str, after: str | None) -> bool:
    """Make a batch count that goes on from the state of ``after``; False if another one does.

    Whoever claims a state has written all it needs by then, so a commit that was cut off right after
    its claim is finished here for it. A batch that was finished and has lost its commit file since does not
    come back: what would have followed it follows its claim."""
    folder = Folder(spark, commits_path(log, topic))
    owner = folder.claim(f".after-{after or 'nothing'}", batch)
    while owner != batch and folder.has(f".done-{owner}") and not folder.has(owner):
        owner = folder.claim(f".after-{owner}", batch)
    folder.touch(owner)
    folder.touch(f".done-{owner}")
    return owner == batch


def states(spark: SparkSession, log: str, topic: str, first: str) -> DataFrame:
    """States of all queues after every committed batch from ``first`` on, with the column ``batch``."""
    unfinished = sorted(set(started_batches(spark, log, topic)) - set(committed_batches(spark, log, topic)))
    schema = T.StructType([*RANGES_SCHEMA.fields, T.StructField("batch", T.StringType())])
    rows = spark.read.schema(schema).parquet(ranges_path(log, topic)).where(F.col("batch") >= first)
    if unfinished:
        rows = rows.where(~F.col("batch").isin(unfinished))
    return rows.withColumn("topic", F.lit(topic))


def messages(spark: SparkSession, log: str, topic: str, first: str | None = None, only: list[str] | None = None) -> DataFrame:
    """Committed messages of a topic with the columns of ``LOG_SCHEMA``, from batch ``first`` on.

    ``only`` opens no other batches, and keeps their names in the column ``batch``."""
    # commits are listed before the files and folders after them, so a batch that is being
    # written meanwhile is known to be unfinished
    committed = committed_batches(spark, log, topic)
    plain = not committed and not started_batches(spark, log, topic)
    schema = T.StructType(LOG_SCHEMA.fields[1:]) if plain else _READ_SCHEMA
    rows = spark.read.schema(schema).parquet(data_path(log, topic))
    unfinished = sorted(set(started_batches(spark, log, topic)) - set(committed))
    # both conditions prune whole folders
    if unfinished:
        rows = rows.where(~F.col("batch").isin(unfinished))
    if first is not None:
        rows = rows.where(F.col("batch") >= first)
    if only is not None:
        rows = rows.where(F.col("batch").isin(only))
    return rows.withColumn("topic", F.lit(topic)).select(*LOG_SCHEMA.names, *(["batch"] if only is not None else []))


def ranges(spark: SparkSession, log: str, topic: str, batch: str | None = None) -> DataFrame | None:
    """State of every queue after a batch (the last one by default); ``None`` for a plain folder."""
    if batch is None:
        committed = committed_batches(spark, log, topic)
        if not committed:
            return None
        batch = committed[-1]
    rows = spark.read.schema(RANGES_SCHEMA).parquet(f"{ranges_path(log, topic)}/batch={batch}")
    return rows.withColumn("topic", F.lit(topic))


def first_batch(
    spark: SparkSession, log: str, topic: str, reached: Callable[[DataFrame], DataFrame] | Column
) -> str | None:
    """First batch after which some queue's state satisfies a condition that stays true.

    ``reached`` filters the state. Looks at a logarithmic number of batches. When none gets
    there, a name between the last batch and the next; ``None`` for a plain folder.
    """
    names = committed_batches(spark, log, topic)

    def holds(name: str) -> bool:
        state = ranges(spark, log, topic, name)
        return not (state.where(reached) if isinstance(reached, Column) else reached(state)).isEmpty()

    if len(names) <= 1:
        return names[0] if names else None
    if not holds(names[-1]):
        return names[-1] + "~"
    low, high = 0, len(names) - 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(names[middle]) else (middle + 1, high)
    return names[low]
