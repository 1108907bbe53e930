"""A topic as a table: batch and streaming reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog import options as opt
from queuelog.functions import formats
from queuelog.model import LOG_SCHEMA, as_schema
from queuelog.operators.event_time import with_event_time
from queuelog.sources import datasource, positions, storage


def tag_filter(messages: DataFrame, tag: str | None) -> DataFrame:
    """Drop messages with another tag. Untagged messages pass, and no filter passes all."""
    if not tag:
        return messages
    tags = F.col("tags")
    return messages.where(tags.isNull() | (tags == "") | (tags == tag))


def _decoded(
    messages: DataFrame,
    options: opt.SourceOptions,
    schema: T.StructType,
    columns: list[str] | None,
    metadata: dict[str, str | Column] | list[str] | tuple[str, ...],
    on_error: str | None,
    multi: bool,
    decoder: Callable[[Column], Column] | None,
    registry: dict[int, str] | None,
) -> DataFrame:
    if not isinstance(metadata, dict):
        metadata = {name: name for name in metadata}
    known = {*LOG_SCHEMA.names, "row_kind", "is_tombstone"} - {"body"}
    for source in metadata.values():
        if isinstance(source, str) and source not in known:
            raise ValueError(f"unknown metadata column '{source}', expected one of {sorted(known)}")
    if on_error is None:
        on_error = "skip" if options.format_options.get("ignore-parse-errors") == "true" else "fail"
    wanted = schema
    if columns is not None:
        for name in columns:
            if name not in schema.names:
                raise ValueError(f"unknown column '{name}'")
        if options.format not in ("csv", "raw") and not options.format_options.get("fail-on-missing-field"):
            # only these fields are parsed; Spark does not prune a fail-fast parse itself
            wanted = T.StructType([schema[name] for name in columns])
    rows = formats.decode(
        messages, options.format, wanted, on_error=on_error, multi=multi,
        options=options.format_options, decoder=decoder, registry=registry,
    )
    names = columns if columns is not None else schema.names
    if options.format in opt.CHANGELOG_FORMATS and "row_kind" not in metadata:
        metadata = {**metadata, "row_kind": "row_kind"}
    return rows.select(
        *[F.col("value")[name].alias(name) for name in names],
        *[(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in metadata.items()],
    )


def read_log(
    spark: SparkSession,
    options: dict,
    schema: T.StructType | str,
    *,
    primary_key: list[str] | None = None,
    columns: list[str] | None = None,
    metadata: dict[str, str | Column] | list[str] | tuple[str, ...] = (),
    committed: DataFrame | None = None,
    ending_offsets: DataFrame | None = None,
    ending_timestamp_millis: int | None = None,
    on_timestamp_miss: str = "earliest",
    on_error: str | None = None,
    multi: bool = False,
    decoder: Callable[[Column], Column] | None = None,
    registry: dict[int, str] | None = None,
) -> DataFrame:
    """Read a topic from its startup position to its present end.

    ``schema`` describes the body. ``columns`` selects some of its fields and parses only
    those. ``metadata`` appends message columns: a list, or new name → message column or
    expression over message columns.
    """
    resolved = opt.source_options(options, primary_key)
    messages = read_messages(
        spark, resolved, committed=committed, ending_offsets=ending_offsets,
        ending_timestamp_millis=ending_timestamp_millis, on_timestamp_miss=on_timestamp_miss,
    )
    return _decoded(
        messages, resolved, as_schema(schema), columns, metadata, on_error, multi, decoder, registry
    )


def read_messages(
    spark: SparkSession,
    options: opt.SourceOptions | dict,
    *,
    committed: DataFrame | None = None,
    ending_offsets: DataFrame | None = None,
    ending_timestamp_millis: int | None = None,
    on_timestamp_miss: str = "earliest",
) -> DataFrame:
    """The messages themselves, undecoded."""
    o = opt.source_options(options) if isinstance(options, dict) else options
    if o.startup_mode == "earliest-offset" and ending_offsets is None:
        messages = storage.messages(spark, o.path, o.topic)
    else:
        starts = positions.starting_offsets(
            spark, o.path, o.topic, o.startup_mode, group=o.group, specific=o.specific_offsets,
            timestamp_millis=o.timestamp_millis, committed=committed, on_timestamp_miss=on_timestamp_miss,
        )
        known = positions.collect_offsets(starts)
        first = None if known is None else positions.needed_from(spark, o.path, o.topic, known)
        messages = storage.messages(spark, o.path, o.topic, first)
        messages = positions.restrict(messages, starts if known is None else known, ending_offsets)
    if ending_timestamp_millis is not None:
        messages = messages.where(F.col("store_timestamp") < F.timestamp_millis(F.lit(ending_timestamp_millis)))
    return tag_filter(messages, o.tag)


def read_log_stream(
    spark: SparkSession,
    options: dict,
    schema: T.StructType | str,
    *,
    watermark: str | None = None,
    engine: str = "queuelog",
    max_messages_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
    committed: DataFrame | None = None,
    columns: list[str] | None = None,
    metadata: dict[str, str | Column] | list[str] | tuple[str, ...] = ("store_timestamp",),
    on_error: str | None = None,
    multi: bool = False,
    decoder: Callable[[Column], Column] | None = None,
    registry: dict[int, str] | None = None,
    primary_key: list[str] | None = None,
) -> DataFrame:
    """Read a topic as a stream from its startup position.

    ``engine="queuelog"`` follows commits and can cap a trigger at a common store time of all
    queues. ``engine="files"`` is Spark's own file stream over the message files: the faster
    scan, for topics that are only appended to; it also sees batches a writer did not finish.
    The position is resolved once and then kept in the query's checkpoint.
    """
    resolved = opt.source_options(options, primary_key)
    if engine == "queuelog":
        datasource.register(spark)
        reader = spark.readStream.format("queuelog").options(
            path=resolved.path, topic=resolved.topic, startup=resolved.startup_mode,
            discovery=str(resolved.discovery_interval_ms), maxPartitionBytes=str(_part_bytes(spark)),
        ).schema(_needed(resolved, metadata))
        if resolved.tag:
            reader = reader.option("tag", resolved.tag)
        if resolved.startup_mode != "earliest-offset":
            reader = reader.option("starts", datasource.starts_json(_resolved(spark, resolved, committed)))
        if max_messages_per_trigger:
            reader = reader.option("maxMessagesPerTrigger", str(max_messages_per_trigger))
        messages = reader.load()
    elif engine == "files":
        messages = (
            spark.readStream.schema(T.StructType([*LOG_SCHEMA.fields[1:], T.StructField("batch", T.StringType())]))
            .options(**({"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else {}))
            .parquet(storage.data_path(resolved.path, resolved.topic))
            .withColumn("topic", F.lit(resolved.topic))
            .select(LOG_SCHEMA.names)
        )
        if resolved.startup_mode == "specific-offsets":
            messages = _from(messages, resolved.specific_offsets)
        elif resolved.startup_mode != "earliest-offset":
            # these depend on when they are resolved, and a file stream has no place to keep them
            raise ValueError(f"engine 'files' cannot start at '{resolved.startup_mode}', use engine 'queuelog'")
    else:
        raise ValueError(f"unknown engine '{engine}', expected 'queuelog' or 'files'")
    if isinstance(metadata, dict):
        names = metadata
    else:
        names = {name: name for name in metadata}
    rows = _decoded(
        tag_filter(messages, resolved.tag), resolved, as_schema(schema), columns, names,
        on_error, multi, decoder, registry,
    )
    if watermark:
        time = [name for name, source in names.items() if isinstance(source, str) and source == "store_timestamp"]
        if not time:
            raise ValueError("a watermark needs the metadata column 'store_timestamp'")
        rows = with_event_time(rows, watermark, time[0])
    return rows


def _part_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _needed(o: opt.SourceOptions, metadata: dict | list | tuple) -> T.StructType:
    """Message columns that a table with this metadata reads; all of them where an expression may use any."""
    sources = list(metadata.values()) if isinstance(metadata, dict) else list(metadata)
    if not all(isinstance(source, str) for source in sources):
        return LOG_SCHEMA
    names = {*sources, "body", *(["tags"] if o.tag else [])}
    return T.StructType([field for field in LOG_SCHEMA if field.name in names])


def _resolved(spark: SparkSession, o: opt.SourceOptions, committed: DataFrame | None) -> list:
    starts = positions.starting_offsets(
        spark, o.path, o.topic, o.startup_mode, group=o.group, specific=o.specific_offsets,
        timestamp_millis=o.timestamp_millis, committed=committed,
    )
    rows = positions.collect_offsets(starts)
    if rows is None:
        raise ValueError(f"a stream position holds at most {positions.MAX_DRIVER_QUEUES} queues")
    return rows


def _from(messages: DataFrame, offsets: dict[int, int]) -> DataFrame:
    """Messages at or after the offset given for their queue id; a queue without one fails."""
    return messages.where(F.col("queue_offset") >= positions.specific_offset(offsets))


def register_topic(spark: SparkSession, name: str, options: dict, schema: T.StructType | str, **kwargs) -> None:
    """Make a topic queryable in SQL under a name."""
    read_log(spark, options, schema, **kwargs).createOrReplaceTempView(name)
