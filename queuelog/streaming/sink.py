"""Rows to messages of a topic: batch and streaming writes with dense offsets per queue."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from queuelog import options as opt
from queuelog.functions import formats
from queuelog.model import LOG_SCHEMA, QUEUE_KEY, RANGES_SCHEMA, same_key_join, scratch_path
from queuelog.operators import compaction, partitioners
from queuelog.operators.indexing import ROWS_PER_BUCKET, dense_index
from queuelog.sources import positions, storage

#: Columns a row may carry that describe the message and are not part of its body.
HEADERS, TIMESTAMP, ROW_KIND = "headers", "timestamp", "row_kind"


def sink_headers(c: Column) -> Column:
    """Header entries with a value; a null map stays null."""
    return F.map_filter(c, lambda k, v: v.isNotNull())


def sink_timestamp(c: Column) -> Column:
    return F.date_trunc("millisecond", c)


def to_messages(
    df: DataFrame,
    options: opt.SinkOptions,
    *,
    metadata: tuple[str, ...] = (),
    exclude: tuple[str, ...] = (),
    tag: Column | None = None,
    broker: Column | str = "broker-0",
    store_timestamp: Column | None = None,
    queues: int = 4,
    partitioner: partitioners.Partitioner | Callable[..., Column] | None = None,
    producer: str | None = None,
    order: list[str] | None = None,
    encoder: Callable[[Column], Column] | None = None,
    avro_schema: str | None = None,
    schema_id: int | None = None,
) -> DataFrame:
    """Rows as messages of ``LOG_SCHEMA`` without offsets, plus the ``order`` columns as ``_order*``.

    ``metadata`` names the columns that are message metadata, ``exclude`` further columns
    that are not part of the body. An excluded ``queue_id`` is the queue of the row.
    """
    for name in metadata:
        if name not in (HEADERS, TIMESTAMP):
            raise ValueError(f"metadata column '{name}' cannot be written, only '{HEADERS}' and '{TIMESTAMP}'")
    kind = F.col(ROW_KIND) if ROW_KIND in df.columns else None
    if kind is not None:
        wrong = F.raise_error(F.concat(F.lit(f"format '{options.format}' cannot write row kind "), kind))
        allowed = kind.isin(sorted(opt.changelog_mode(options.format)))
        df = df.where(F.when(allowed, True).otherwise(wrong.cast("boolean")))
    physical = [c for c in df.columns if c not in {*metadata, *exclude, ROW_KIND}]
    row = F.struct(*physical)
    body = formats.encode(
        row, options.format, df.select(*physical).schema, kind=kind, options=options.format_options,
        encoder=encoder, avro_schema=avro_schema, schema_id=schema_id,
    )
    key = F.struct(*options.key_fields) if options.key_fields else None
    # column names of the input stay usable until the last projection
    placed = df.withColumn("_body", body)
    if "queue_id" not in exclude:
        placed = partitioners.assign_queue(
            placed, partitioner or options.partitioner, queues, topic=options.topic,
            producer=producer, order=order, key=key, body=F.col("_body"),
        )
    if tag is None:
        tag = F.lit(options.tag or None).cast("string")
    return placed.select(
        F.lit(options.topic).alias("topic"),
        (F.lit(broker) if isinstance(broker, str) else broker).alias("broker_name"),
        F.col("queue_id").cast("int").alias("queue_id"),
        (F.current_timestamp() if store_timestamp is None else store_timestamp.cast("timestamp")).alias("store_timestamp"),
        tag.alias("tags"),
        F.col("_body").alias("body"),
        (sink_headers(F.col(HEADERS)) if HEADERS in metadata else F.lit(None)).cast("map<string,binary>").alias("headers"),
        (sink_timestamp(F.col(TIMESTAMP)) if TIMESTAMP in metadata else F.lit(None)).cast("timestamp").alias("msg_timestamp"),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order or [])],
    )


def assign_offsets(
    messages: DataFrame,
    order: list[str],
    ends: DataFrame | None = None,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    total: int | None = None,
) -> DataFrame:
    """Append ``queue_offset``: dense per queue, going on from the queue's present end."""
    first = None
    if ends is not None:
        first = ends.select(*QUEUE_KEY, F.col("offset").alias("first"))
    return dense_index(
        messages, QUEUE_KEY, order, "queue_offset", first=first, rows_per_bucket=rows_per_bucket, total=total
    )


def _state_after(written: DataFrame, before: DataFrame | None) -> DataFrame:
    """Offsets and times of every queue once ``written`` counts (see ``RANGES_SCHEMA``)."""
    own = written.groupBy("broker_name", "queue_id").agg(
        F.min("queue_offset").alias("start"),
        (F.max("queue_offset") + 1).alias("end"),
        F.max("store_timestamp").alias("max_ts"),
        F.percentile_approx(F.unix_micros("store_timestamp"), [i / 20 for i in range(1, 21)], 1000).alias("ts_quantiles"),
    )
    times = F.coalesce("ts_quantiles", F.array().cast("array<bigint>"))  # a queue may hold no time at all
    if before is None:
        state = own.withColumns({"earliest": F.col("start"), "seen_ts": F.col("max_ts"), "ts_quantiles": times})
    else:
        past = before.select(
            "broker_name", "queue_id", "earliest", F.col("end").alias("past_end"), F.col("seen_ts").alias("past_ts")
        )
        state = same_key_join(own, past, ["broker_name", "queue_id"], "full").withColumns(
            {
                "earliest": F.coalesce("earliest", "start"),
                "start": F.coalesce("start", "past_end"),
                "end": F.coalesce("end", "past_end"),
                "seen_ts": F.greatest("max_ts", "past_ts"),
                "ts_quantiles": times,
            }
        )
    return state.select(RANGES_SCHEMA.names)


def _folder_name(txn: str) -> str:
    """A transaction id as part of a folder name."""
    plain = quote(txn, safe="")
    return plain if len(plain) <= 128 else hashlib.sha256(txn.encode()).hexdigest()


def _buffers(options: opt.SinkOptions) -> bool:
    return bool(options.key_fields) and options.buffer_rows > 0 and options.buffer_interval_ms > 0


def _repeatable(options: opt.SinkOptions, kwargs: dict) -> bool:
    """Whether queue and order of a row are the same each time they are computed."""
    by_task = kwargs.get("partitioner") is None and options.partitioner in ("default", "fixed", "round-robin")
    return bool(kwargs.get("order")) and (
        not by_task or kwargs.get("producer") is not None or "queue_id" in kwargs.get("exclude", ())
    )


def _batch_name(spark: SparkSession, path: str, topic: str, txn: str) -> tuple[str, bool]:
    """Folder name for a transaction, and whether it is committed already.

    Numbers follow commit order. A repeated write replaces what an interrupted one left, unless
    another batch was committed since: then it gets a new number, and what it left is never read.
    """
    committed = storage.committed_batches(spark, path, topic)
    started = storage.started_batches(spark, path, topic)
    number = lambda name: int(name.split("-", 1)[0])
    last = max(map(number, committed), default=-1)
    own = [name for name in {*committed, *started} if name.split("-", 1)[1] == txn]
    for name in own:
        if name in committed:
            return name, True
    for name in own:
        if number(name) > last:
            return name, False
    number = max(map(number, {*committed, *started}), default=-1) + 1
    return f"{number:012d}-{txn}", False


@contextmanager
def _timestamps_with_statistics(spark: SparkSession):
    """Write timestamps as parquet's own type; readers cannot skip row groups by INT96."""
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def commit(
    messages: DataFrame,
    path: str,
    topic: str,
    txn: str,
    order: list[str],
    *,
    parallelism: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> str | None:
    """Write messages as one batch. Readers see all of it or nothing; a committed ``txn`` is kept.

    A writer that another one overtakes numbers its messages anew and tries again."""
    spark = messages.sparkSession
    total = None
    while True:
        committed = storage.committed_batches(spark, path, topic)
        after = committed[-1] if committed else None
        name, done = _batch_name(spark, path, topic, _folder_name(txn))
        if total is None:
            total = 0 if done else messages.count()
        if done or not total:
            return None
        before = None if after is None else storage.ranges(spark, path, topic, after)
        ends = None if before is None else before.withColumn("offset", F.col("end"))
        rows = assign_offsets(messages, order, ends, rows_per_bucket=rows_per_bucket, total=total)
        rows = rows.select(LOG_SCHEMA.names).drop("topic")
        if parallelism:
            rows = rows.repartitionByRange(parallelism, "broker_name", "queue_id", "queue_offset")
        # sorted files let row groups be skipped by queue and offset
        rows = rows.sortWithinPartitions("broker_name", "queue_id", "queue_offset")
        data = f"{storage.data_path(path, topic)}/batch={name}"
        with _timestamps_with_statistics(spark):
            rows.write.mode("overwrite").parquet(data)
        written = spark.read.schema(rows.schema).parquet(data)
        with _timestamps_with_statistics(spark):  # one row per queue
            state = _state_after(written, before).repartition(1)
            state.write.mode("overwrite").parquet(f"{storage.ranges_path(path, topic)}/batch={name}")
        if storage.mark_committed(spark, path, topic, name, after):
            return name
        # another writer went on from the same state meanwhile: these offsets are taken


def _write(df: DataFrame, options: opt.SinkOptions, txn: str, stage: bool, rows_per_bucket: int, kwargs: dict) -> str | None:
    spark = df.sparkSession
    if _batch_name(spark, options.path, options.topic, _folder_name(txn))[1]:
        return None
    if _buffers(options) or options.partitioner == "round-robin" and kwargs.get("producer") is not None:
        # rows are numbered in several passes, so all of them must see the same rows
        folder = scratch_path(spark, "rows")
        df.write.parquet(folder)
        df = spark.read.schema(df.schema).parquet(folder)
    if _buffers(options):
        if not kwargs.get("order"):
            raise ValueError("buffering by key needs an order of the rows")
        producer = kwargs.get("producer")
        df = df.withColumn("_producer", F.col(producer) if producer else F.lit(0))
        stamp = kwargs.get("store_timestamp")
        if stamp is None:
            raise ValueError("buffering by interval needs a store time of the rows")
        df = df.withColumn("_stamp", stamp.cast("timestamp"))
        kept = compaction.compact(
            df, ["_producer"], kwargs["order"], options.key_fields, "_stamp",
            options.buffer_rows, options.buffer_interval_ms, rows_per_bucket=rows_per_bucket,
        )
        df, stage = kept.drop("_producer", "_stamp"), True
    messages = to_messages(df, options, **kwargs)
    order = [c for c in messages.columns if c.startswith("_order")]
    if not order:
        # no order asked for: rows keep the order in which tasks produced them
        messages, order, stage = messages.withColumn("_order0", F.monotonically_increasing_id()), ["_order0"], True
    if not stage:
        return commit(messages, options.path, options.topic, txn, order,
                      parallelism=options.parallelism, rows_per_bucket=rows_per_bucket)
    # queue, order and store time may depend on how Spark ran, and offsets need two passes
    folder = scratch_path(spark, "stage")
    messages.write.parquet(folder)
    try:
        staged = spark.read.schema(messages.schema).parquet(folder)
        return commit(staged, options.path, options.topic, txn, order,
                      parallelism=options.parallelism, rows_per_bucket=rows_per_bucket)
    finally:
        storage.Folder(spark, folder).delete()


def write_log(
    df: DataFrame,
    options: dict,
    *,
    primary_key: list[str] | None = None,
    txn: str | None = None,
    stage: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    **kwargs,
) -> str | None:
    """Write a DataFrame to a topic and return the name of the batch (``None`` if ``txn`` was done).

    Keyword arguments are those of ``to_messages``. ``order`` names columns that order the
    rows in full; offsets follow it. Offsets take two passes over the messages, so they are
    staged in the work folder first; ``stage=False`` computes them twice instead, which is
    right when every column, ``store_timestamp`` included, is a fixed function of stored data.
    """
    resolved = opt.sink_options(options, primary_key)
    if resolved.guarantee == "exactly-once":
        if txn is None:
            raise ValueError("an exactly-once write needs a txn that is the same on a retry")
        txn = f"{resolved.txn_prefix}-{txn}"
    return _write(df, resolved, txn or uuid.uuid4().hex, stage, rows_per_bucket, kwargs)


def write_log_stream(
    df: DataFrame,
    options: dict,
    *,
    checkpoint: str | None = None,
    primary_key: list[str] | None = None,
    commit_group: tuple[str, str, str] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    **kwargs,
) -> DataStreamWriter:
    """A writer for a stream; set a trigger and ``start()`` it.

    ``none`` and ``at-least-once`` append every batch run, so a batch run again appears
    again. ``exactly-once`` names a batch by prefix, query and batch id, and a batch run again
    replaces or repeats nothing; a query with a new checkpoint is another query. ``commit_group`` = (log path, topic, group) records, after
    each batch, the next offsets of the rows read; they need the queue columns and
    ``queue_offset``, which are kept out of the body.
    """
    resolved = opt.sink_options(options, primary_key)
    if resolved.guarantee != "none" and checkpoint is None:
        raise ValueError(f"'{resolved.guarantee}' needs a checkpoint location")
    if commit_group:
        missing = [c for c in (*QUEUE_KEY, "queue_offset") if c not in df.columns]
        if missing:
            raise ValueError(f"commit_group needs the columns {', '.join(missing)}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        txn = uuid.uuid4().hex
        if resolved.guarantee == "exactly-once":
            query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")  # the checkpoint keeps it
            if not query:
                raise RuntimeError("an exactly-once batch does not know its streaming query")
            txn = f"{resolved.txn_prefix}-{query}-{batch_id}"
        if not commit_group and not _buffers(resolved):
            _write(batch, resolved, txn, True, rows_per_bucket, kwargs)
            return
        # the micro-batch is needed more than once: keep it where a lost executor cannot take it
        folder = scratch_path(spark, "batch")
        batch.write.parquet(folder)
        try:
            fixed = spark.read.schema(batch.schema).parquet(folder)
            rows = fixed.drop(*QUEUE_KEY, "queue_offset") if commit_group else fixed
            _write(rows, resolved, txn, not _repeatable(resolved, kwargs), rows_per_bucket, kwargs)
            if commit_group and not fixed.isEmpty():
                path, topic, group = commit_group
                positions.commit_offsets(spark, path, group, topic, positions.resume_offsets(fixed))
        finally:
            storage.Folder(spark, folder).delete()

    writer = df.writeStream.foreachBatch(run)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
