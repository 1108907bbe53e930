"""Where to start reading each queue: startup modes, resume, discovery, group offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.model import OFFSETS_SCHEMA, QUEUE_KEY, same_key_join
from queuelog.sources import storage

#: More queues than this are handled as a distributed table, never on the driver.
MAX_DRIVER_QUEUES = 10_000
#: Up to this many queues become literal ranges that reach the parquet scan.
MAX_LITERAL_QUEUES = 64
#: Up to this many batches are named one by one when a time is looked up; else all from the first on are read.
MAX_BATCHES = 1000

#: In a shuffled join a queue is cut into runs of this many messages, dealt to this many tasks.
RUN_LENGTH, RUNS = 65_536, 32

_RANGE_SCHEMA = T.StructType(
    [
        *OFFSETS_SCHEMA.fields[:3],
        T.StructField("from_offset", T.LongType()),
        T.StructField("to_offset", T.LongType()),
    ]
)


def queue_bounds(log: DataFrame) -> DataFrame:
    """Per queue: first offset and exclusive end. Reads only the key columns."""
    return log.groupBy(QUEUE_KEY).agg(
        F.min("queue_offset").alias("earliest"), (F.max("queue_offset") + 1).alias("end")
    )


def topic_bounds(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The same from the last commit, without touching messages, where there are commits."""
    state = storage.ranges(spark, path, topic)
    if state is None:
        return queue_bounds(storage.messages(spark, path, topic))
    return state.select(*QUEUE_KEY, "earliest", "end")


def earliest(bounds: DataFrame) -> DataFrame:
    return bounds.select(*QUEUE_KEY, F.col("earliest").alias("offset"))


def latest(bounds: DataFrame) -> DataFrame:
    return bounds.select(*QUEUE_KEY, F.col("end").alias("offset"))


def group_offsets(bounds: DataFrame, committed: DataFrame) -> DataFrame:
    """Committed offset of the group; the end of the queue where there is none or it is negative."""
    own = committed.select(*QUEUE_KEY, F.col("offset").alias("committed"))
    return same_key_join(bounds, own, QUEUE_KEY, "left").select(
        *QUEUE_KEY,
        F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.col("end")).alias("offset"),
    )


def specific_offset(offsets: dict[int, int]) -> Column:
    """The given offset for the queue id, on every broker; a queue without one fails, by name."""
    pairs = [F.lit(number) for pair in offsets.items() for number in pair]
    given = F.create_map(*pairs).cast("map<int,bigint>")[F.col("queue_id")] if pairs else F.lit(None)
    given = given.cast("bigint")
    name = F.concat_ws("-", "topic", "broker_name", F.col("queue_id").cast("string"))
    missing = F.raise_error(F.concat(F.lit("queue "), name, F.lit(" needs an offset")))
    return F.when(given >= 0, given).otherwise(missing.cast("bigint"))


def specific_offsets(bounds: DataFrame, offsets: dict[int, int]) -> DataFrame:
    return bounds.select(*QUEUE_KEY, specific_offset(offsets).alias("offset"))


def timestamp_offsets(
    log: DataFrame, bounds: DataFrame, millis: int, on_miss: str = "earliest"
) -> DataFrame:
    """First offset stored at or after the time; ``on_miss`` where no message is that late."""
    if on_miss not in ("earliest", "latest"):
        raise ValueError(f"on_miss should be 'earliest' or 'latest', but is '{on_miss}'")
    at = F.timestamp_millis(F.lit(millis))
    found = (
        log.where(F.col("store_timestamp") >= at)
        .groupBy(QUEUE_KEY)
        .agg(F.min("queue_offset").alias("found"))
    )
    miss = F.col("earliest" if on_miss == "earliest" else "end")
    return same_key_join(bounds, found, QUEUE_KEY, "left").select(
        *QUEUE_KEY, F.coalesce("found", miss).alias("offset")
    )


def messages_around(spark: SparkSession, path: str, topic: str, millis: int) -> DataFrame:
    """Messages among which each queue's first one at or after the time is: of one batch a queue.

    What commits say of the latest store time so far is an index: the batch with which a queue gets to
    the time holds that message. Only states are read to find it, from a batch found by binary search on."""
    at = F.timestamp_millis(F.lit(millis))
    first = storage.first_batch(spark, path, topic, F.col("seen_ts") >= at)
    if first is None:  # a plain folder has no commits
        return storage.messages(spark, path, topic)
    reached = storage.states(spark, path, topic, first).where((F.col("seen_ts") >= at) & (F.col("end") > F.col("start")))
    reached = reached.groupBy(QUEUE_KEY).agg(F.min("batch").alias("batch"))
    names = [r["batch"] for r in reached.select("batch").distinct().limit(MAX_BATCHES + 1).collect()]
    if len(names) > MAX_BATCHES:
        return storage.messages(spark, path, topic, first)
    rows = storage.messages(spark, path, topic, first, names)
    return same_key_join(rows, reached, [*QUEUE_KEY, "batch"], "left_semi").drop("batch")


def resume_offsets(read: DataFrame) -> DataFrame:
    """Where to go on after these messages: one past the last of each queue."""
    return read.groupBy(QUEUE_KEY).agg((F.max("queue_offset") + 1).alias("offset"))


def capped_ends(starts: DataFrame, bounds: DataFrame, max_messages: int = 64) -> DataFrame:
    """Where one poll of each queue ends: at most ``max_messages`` further on."""
    return same_key_join(starts, bounds, QUEUE_KEY).select(
        *QUEUE_KEY, F.least(F.col("end"), F.col("offset") + max_messages).alias("offset")
    )


def parse_specific_offsets(text: Column) -> Column:
    """The option text as a column: ``array<struct<partition, offset>>``, last duplicate only."""
    entry = "^partition:([+-]?[0-9]+),offset:([+-]?[0-9]+),*$"
    bad = F.raise_error(F.concat(F.lit("invalid specific offsets: "), text))

    def parsed(e: Column) -> Column:
        return F.struct(
            F.when(e.rlike(entry), F.regexp_extract(e, entry, 1)).otherwise(bad).cast("int").alias("partition"),
            F.regexp_extract(e, entry, 2).cast("bigint").alias("offset"),
        )

    entries = F.transform(F.split(F.regexp_replace(text, ";+$", ""), ";"), parsed)
    later = lambda i: F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1)))
    return F.filter(
        entries, lambda e, i: ~F.exists(later(i), lambda o: o["partition"] == e["partition"])
    )


def new_queues(current: DataFrame, known: DataFrame) -> DataFrame:
    """Queues not seen before; queues that vanished are not reported."""
    return same_key_join(current.select(QUEUE_KEY).distinct(), known.select(QUEUE_KEY), QUEUE_KEY, "left_anti")


def collect_offsets(offsets: DataFrame) -> list | None:
    """The offsets on the driver, or ``None`` when there are too many queues for that."""
    rows = offsets.select(*QUEUE_KEY, "offset").limit(MAX_DRIVER_QUEUES + 1).collect()
    return rows if len(rows) <= MAX_DRIVER_QUEUES else None


def restrict(log: DataFrame, starts: DataFrame | list, ends: DataFrame | None = None) -> DataFrame:
    """Messages of the listed queues from their start (and before their end).

    Few queues become an OR of literal ranges, which parquet row groups are pruned by. More
    become a broadcast table, and beyond ``MAX_DRIVER_QUEUES`` the join is a shuffle.
    """
    spark = log.sparkSession
    wanted = None
    if isinstance(starts, list) and ends is None:  # collected already
        rows = [Row(**{k: r[k] for k in QUEUE_KEY}, from_offset=r["offset"], to_offset=None) for r in starts]
    else:
        if isinstance(starts, list):
            starts = spark.createDataFrame([tuple(r) for r in starts], OFFSETS_SCHEMA)
        wanted = starts.select(*QUEUE_KEY, F.col("offset").alias("from_offset"))
        if ends is None:
            wanted = wanted.withColumn("to_offset", F.lit(None).cast("bigint"))
        else:
            stops = ends.select(*QUEUE_KEY, F.col("offset").alias("to_offset"))
            wanted = same_key_join(wanted, stops, QUEUE_KEY, "left")
        rows = wanted.limit(MAX_DRIVER_QUEUES + 1).collect()
    if len(rows) <= MAX_LITERAL_QUEUES:
        condition = F.lit(False)
        for row in rows:
            one = F.col("queue_offset") >= row["from_offset"]
            if row["to_offset"] is not None:
                one &= F.col("queue_offset") < row["to_offset"]
            for key in QUEUE_KEY:
                one &= F.col(key).eqNullSafe(F.lit(row[key])) if row[key] is None else F.col(key) == row[key]
            condition |= one
        return log.where(condition)
    inside = (F.col("queue_offset") >= F.col("from_offset")) & (
        F.col("to_offset").isNull() | (F.col("queue_offset") < F.col("to_offset"))
    )
    if len(rows) <= MAX_DRIVER_QUEUES:  # counted above, so small enough for every executor
        table = F.broadcast(spark.createDataFrame([tuple(r) for r in rows], _RANGE_SCHEMA))
        return same_key_join(log, table, QUEUE_KEY).where(inside).select(log.columns)
    # runs of a queue go to different tasks, since one queue may hold much of the log
    run = F.pmod(F.expr(f"queue_offset div {RUN_LENGTH}"), F.lit(RUNS)).cast("int").alias("_run")
    if wanted is None:
        wanted = spark.createDataFrame([tuple(r) for r in rows], _RANGE_SCHEMA)
    table = wanted.withColumn("_run", F.explode(F.sequence(F.lit(0), F.lit(RUNS - 1))))
    return same_key_join(log.select("*", run), table, [*QUEUE_KEY, "_run"]).where(inside).select(log.columns)


# -- offsets a consumer group committed --------------------------------------------------


def _group_path(path: str, group: str, topic: str) -> str:
    return f"{path.rstrip('/')}/_groups/group={group}/topic={topic}"


def commit_offsets(spark: SparkSession, path: str, group: str, topic: str, offsets: DataFrame) -> None:
    """Record next offsets for a group. Queues not named keep theirs."""
    folder = _group_path(path, group, topic)
    before = committed_offsets(spark, path, group, topic)
    state = offsets.select(OFFSETS_SCHEMA.names).unionByName(same_key_join(before, offsets, QUEUE_KEY, "left_anti"))
    number = max(storage.Folder(spark, folder).numbered("commit"), default=-1) + 1
    # one row per queue
    state.drop("topic").repartition(1).write.mode("overwrite").parquet(f"{folder}/commit={number}")


def committed_offsets(spark: SparkSession, path: str, group: str, topic: str) -> DataFrame:
    """The group's offsets as of its last complete commit."""
    folder = _group_path(path, group, topic)
    files = storage.Folder(spark, folder)
    for number in reversed(files.numbered("commit")):
        if files.has(f"commit={number}/_SUCCESS"):
            rows = spark.read.schema(T.StructType(OFFSETS_SCHEMA.fields[1:])).parquet(f"{folder}/commit={number}")
            return rows.withColumn("topic", F.lit(topic)).select(OFFSETS_SCHEMA.names)
    return spark.createDataFrame([], OFFSETS_SCHEMA)


def needed_from(spark: SparkSession, path: str, topic: str, starts: list) -> str | None:
    """First batch that holds a message at or after the starts; earlier ones need not be opened."""
    begun = F.lit(False)
    if len(starts) <= MAX_LITERAL_QUEUES:
        for row in starts:
            begun |= F.col("broker_name").eqNullSafe(row["broker_name"]) & F.col("queue_id").eqNullSafe(row["queue_id"]) & (
                F.col("end") > row["offset"])
        return storage.first_batch(spark, path, topic, begun)
    table = spark.createDataFrame([tuple(r) for r in starts], OFFSETS_SCHEMA)
    return storage.first_batch(
        spark, path, topic, lambda state: same_key_join(state, table, QUEUE_KEY).where("end > offset")
    )


def starting_offsets(
    spark: SparkSession,
    path: str,
    topic: str,
    mode: str,
    *,
    group: str | None = None,
    specific: dict[int, int] | None = None,
    timestamp_millis: int | None = None,
    committed: DataFrame | None = None,
    on_timestamp_miss: str = "earliest",
) -> DataFrame:
    """Offsets for a startup mode, one row per queue of the topic."""
    bounds = topic_bounds(spark, path, topic)
    if mode == "earliest-offset":
        return earliest(bounds)
    if mode == "latest-offset":
        return latest(bounds)
    if mode == "group-offsets":
        if committed is None:
            committed = committed_offsets(spark, path, group, topic)
        return group_offsets(bounds, committed)
    if mode == "specific-offsets":
        return specific_offsets(bounds, specific or {})
    if mode == "timestamp":
        return timestamp_offsets(messages_around(spark, path, topic, timestamp_millis), bounds, timestamp_millis, on_timestamp_miss)
    raise ValueError(f"unknown startup mode '{mode}'")
