"""Every operator as a query over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog import options as opt
from queuelog.functions import binary, cdc, formats, text
from queuelog.model import QUEUE_KEY, as_schema, scratch_path
from queuelog.operators import changelog, compaction, event_time, partitioners, placement
from queuelog.plans import fixtures as fx
from queuelog.sources import datasource, positions, scan, storage
from queuelog.streaming import sink

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LOG = """WITH log AS (
  SELECT *, 'events' AS topic, 'broker-'||(user_id%2) AS broker_name,
         CAST((user_id//2)%4 AS INT) AS queue_id,
         row_number() OVER (PARTITION BY user_id%2,(user_id//2)%4 ORDER BY event_id)-1 AS queue_offset,
         ts AS store_timestamp, event_type AS tags
  FROM events)
"""

CHANGES = """WITH changelog AS (
  SELECT 0 AS seq, '+I' AS row_kind, o_orderkey, o_totalprice, o_orderstatus FROM orders
  UNION ALL SELECT 1, '-U', o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT 1, '+U', o_orderkey, o_totalprice + 1, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT 2, '-D', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END,
                   o_orderstatus FROM orders WHERE o_orderkey % 10 = 0)
"""

#: 2024-01-15 00:00:00 UTC
START_MILLIS = 1705276800000
QUEUE = ["broker_name", "queue_id"]


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def _log(spark: SparkSession, sf: str, **options) -> dict:
    return fx.options(fx.events_log(spark, sf), **options)


def _ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


# -- sources -----------------------------------------------------------------------------


@query("log_scan", LOG + "SELECT event_id, user_id, value, broker_name, queue_id, queue_offset FROM log")
def log_scan(spark, sf):
    return scan.read_log(
        spark, _log(spark, sf), fx.EVENT_SCHEMA,
        columns=["event_id", "user_id", "value"], metadata=[*QUEUE, "queue_offset"],
    )


def _read_per_queue(messages: DataFrame) -> DataFrame:
    return messages.groupBy(QUEUE).agg(
        F.min("queue_offset").alias("first_offset"), F.max("queue_offset").alias("last_offset"),
        F.count("*").alias("n_messages"),
    )


READ_PER_QUEUE = """SELECT broker_name, queue_id, min(queue_offset) AS first_offset, max(queue_offset) AS last_offset,
  count(*) AS n_messages FROM log """


@query("start_earliest", LOG + READ_PER_QUEUE + "GROUP BY ALL")
def start_earliest(spark, sf):
    path = fx.events_log(spark, sf)
    starts = positions.starting_offsets(spark, path, "events", "earliest-offset")
    return _read_per_queue(positions.restrict(storage.messages(spark, path, "events"), starts))


@query(
    "start_latest",
    LOG + "SELECT broker_name, queue_id, max(queue_offset)+1 AS start_offset FROM log GROUP BY ALL",
)
def start_latest(spark, sf):
    starts = positions.latest(positions.queue_bounds(fx.events_messages(spark, sf)))
    return starts.select(*QUEUE, F.col("offset").alias("start_offset"))


@query(
    "start_group_offsets",
    LOG + """, bounds AS (SELECT broker_name, queue_id, max(queue_offset)+1 AS e FROM log GROUP BY ALL),
    committed AS (SELECT broker_name, queue_id, CASE WHEN broker_name='broker-0' THEN 100*queue_id ELSE -1 END AS c
                  FROM bounds WHERE broker_name='broker-0' OR queue_id % 2 = 0)
    SELECT b.broker_name, b.queue_id, CASE WHEN c >= 0 THEN c ELSE e END AS start_offset
    FROM bounds b LEFT JOIN committed USING (broker_name, queue_id)""",
)
def start_group_offsets(spark, sf):
    starts = positions.starting_offsets(
        spark, fx.events_log(spark, sf), "events", "group-offsets", committed=fx.committed(spark, sf)
    )
    return starts.select(*QUEUE, F.col("offset").alias("start_offset"))


@query(
    "start_specific_offsets",
    LOG + READ_PER_QUEUE
    + "WHERE queue_offset >= CASE queue_id WHEN 0 THEN 42 WHEN 1 THEN 300 WHEN 2 THEN 0 ELSE 7 END GROUP BY ALL",
)
def start_specific_offsets(spark, sf):
    options = _log(
        spark, sf, scan__startup__mode="specific-offsets", scan__startup__specific_offsets=fx.SPECIFIC
    )
    return _read_per_queue(scan.read_messages(spark, options))


@query(
    "start_timestamp",
    LOG + f""", starts AS (SELECT broker_name, queue_id, coalesce(
        min(queue_offset) FILTER (store_timestamp >= make_timestamp({START_MILLIS * 1000})), min(queue_offset)) AS s
      FROM log GROUP BY ALL)
    SELECT broker_name, queue_id, min(queue_offset) AS first_offset, max(queue_offset) AS last_offset,
      count(*) AS n_messages FROM log JOIN starts USING (broker_name, queue_id) WHERE queue_offset >= s GROUP BY ALL""",
)
def start_timestamp(spark, sf):
    options = _log(
        spark, sf, scan__startup__mode="timestamp", scan__startup__timestamp_millis=str(START_MILLIS)
    )
    return _read_per_queue(scan.read_messages(spark, options))


@query(
    "parse_specific_offsets",
    """SELECT o_orderkey, CAST(o_orderkey % 5 AS INT) AS partition_id, o_custkey AS start_offset FROM orders
       UNION ALL SELECT o_orderkey, CAST(o_orderkey % 5 + 1 AS INT), o_orderkey FROM orders""",
)
def parse_specific_offsets(spark, sf):
    orders = fx.table(spark, sf, "orders")
    first = (F.col("o_orderkey") % 5).cast("string")
    second = (F.col("o_orderkey") % 5 + 1).cast("string")
    # the first entry is overridden by the last one for the same partition
    written = F.concat(
        F.lit("partition:"), first, F.lit(",offset:9;partition:"), second, F.lit(",offset:"),
        F.col("o_orderkey").cast("string"), F.lit(";partition:"), first, F.lit(",offset:"),
        F.col("o_custkey").cast("string"),
    )
    rows = orders.select("o_orderkey", F.explode(positions.parse_specific_offsets(written)).alias("o"))
    return rows.select("o_orderkey", F.col("o.partition").alias("partition_id"), F.col("o.offset").alias("start_offset"))


@query("queue_discovery", LOG + "SELECT DISTINCT broker_name, queue_id FROM log WHERE broker_name <> 'broker-0'")
def queue_discovery(spark, sf):
    bounds = positions.topic_bounds(spark, fx.events_log(spark, sf), "events")
    return positions.new_queues(bounds, bounds.where("broker_name = 'broker-0'")).select(QUEUE)


@query(
    "resume_offsets",
    LOG + """, next AS (SELECT broker_name, queue_id, max(queue_offset)+1 AS s FROM log
      WHERE store_timestamp < TIMESTAMP '2024-01-10' GROUP BY ALL)
    SELECT broker_name, queue_id, min(queue_offset) AS first_offset, max(queue_offset) AS last_offset,
      count(*) AS n_messages FROM log JOIN next USING (broker_name, queue_id) WHERE queue_offset >= s GROUP BY ALL""",
)
def resume_offsets(spark, sf):
    messages = fx.events_messages(spark, sf)
    read = messages.where(F.col("store_timestamp") < F.lit("2024-01-10").cast("timestamp"))
    return _read_per_queue(positions.restrict(messages, positions.resume_offsets(read)))


@query(
    "read_batch_cap",
    LOG + f""", starts AS (SELECT broker_name, queue_id, coalesce(
        min(queue_offset) FILTER (store_timestamp >= make_timestamp({START_MILLIS * 1000})), min(queue_offset)) AS s
      FROM log GROUP BY ALL)
    SELECT event_id, broker_name, queue_id, queue_offset FROM log JOIN starts USING (broker_name, queue_id)
    WHERE queue_offset >= s AND queue_offset < s + 64""",
)
def read_batch_cap(spark, sf):
    path = fx.events_log(spark, sf)
    options = _log(
        spark, sf, scan__startup__mode="timestamp", scan__startup__timestamp_millis=str(START_MILLIS)
    )
    starts = positions.starting_offsets(spark, path, "events", "timestamp", timestamp_millis=START_MILLIS)
    ends = positions.capped_ends(starts, positions.topic_bounds(spark, path, "events"), 64)
    return scan.read_log(
        spark, options, fx.EVENT_SCHEMA, columns=["event_id"], ending_offsets=ends, metadata=[*QUEUE, "queue_offset"]
    )


@query(
    "queue_affine_repartition",
    LOG + """, hashed AS (SELECT *, list_reduce(list_transform(string_split(topic||'-'||broker_name,''),
        lambda c: CAST(ascii(c) AS BIGINT)), lambda a, x: (a*31+x)&2147483647, CAST(0 AS BIGINT)) AS h FROM log)
    SELECT CAST((((h*31)&2147483647) % 5 + queue_id) % 5 AS INT) AS owner, broker_name, queue_id, count(*) AS n_messages
    FROM hashed GROUP BY ALL""",
)
def queue_affine_repartition(spark, sf):
    path = fx.events_log(spark, sf)
    lanes = placement.lanes_for(positions.topic_bounds(spark, path, "events"), 5, 2_000_000)
    placed = placement.queue_affine_repartition(storage.messages(spark, path, "events"), 5, lanes=lanes)
    return placed.groupBy("owner", *QUEUE).agg(F.count("*").alias("n_messages"))


@query(
    "file_scans",
    "SELECT f.file_format, e.event_id, e.user_id, e.event_type, e.value FROM events e, "
    "(VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(file_format)",
)
def file_scans(spark, sf):
    columns = ["event_id", "user_id", "event_type", "value"]
    events = fx.table(spark, sf, "events").select(columns)

    def build(path: str) -> None:
        for name in ("csv", "json", "orc", "parquet"):
            events.write.format(name).save(f"{path}/{name}")

    path = fx.once(spark, "files", sf, build)
    parts = [
        spark.read.schema(events.schema).format(name).load(f"{path}/{name}").withColumn("file_format", F.lit(name))
        for name in ("csv", "json", "orc", "parquet")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("log_stream", LOG + "SELECT event_id, user_id, value, broker_name, queue_id, queue_offset FROM log")
def log_stream(spark, sf):
    stream = scan.read_log_stream(
        spark, _log(spark, sf), fx.EVENT_SCHEMA,
        columns=["event_id", "user_id", "value"], metadata=[*QUEUE, "queue_offset"],
    )
    return _run(spark, stream)


@query(
    "log_by_format",
    LOG + f""", starts AS (
  SELECT broker_name, queue_id, min(queue_offset) AS first_offset FROM log
  WHERE epoch_ms(ts) >= {START_MILLIS} GROUP BY ALL)
SELECT event_id, log.broker_name, log.queue_id, queue_offset
FROM log LEFT JOIN starts ON log.broker_name = starts.broker_name AND log.queue_id = starts.queue_id
WHERE tags = 'click' AND queue_offset >= coalesce(first_offset, 0)""",
)
def log_by_format(spark, sf):
    """The table's declaration as options of the format: start time and tag."""
    datasource.register(spark)
    declared = _log(spark, sf, tag="click", **{
        "scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": str(START_MILLIS)})
    messages = spark.read.format("queuelog").options(**declared).load()
    rows = formats.decode(messages, "json", as_schema(fx.EVENT_SCHEMA))
    return rows.select(F.col("value")["event_id"].alias("event_id"), *QUEUE, "queue_offset")


@query("log_stream_capped", "SELECT event_id, user_id, value FROM events")
def log_stream_capped(spark, sf):
    """Two commits, store times cut to the day and some missing: far more messages of a time than a trigger takes."""
    def build(path: str) -> None:
        events = fx.placed_events(spark, sf)
        day = F.when(F.col("event_id") % 7 != 0, F.date_trunc("day", F.col("ts").cast("timestamp")))
        for rest in (0, 1):
            sink.write_log(
                events.where(F.col("event_id") % 3 == 0 if rest == 0 else F.col("event_id") % 3 != 0), fx.options(path),
                exclude=("broker_name", "queue_id"), broker=F.col("broker_name"), store_timestamp=day, order=["event_id"], stage=False,
            )

    path = fx.once(spark, "events-days", sf, build)
    stream = scan.read_log_stream(
        spark, fx.options(path), fx.EVENT_SCHEMA, columns=["event_id", "user_id", "value"], metadata=[],
        max_messages_per_trigger=max(200, fx.table(spark, sf, "events").count() // 6),
    )
    return _run(spark, stream, close_windows=True)


@query("log_stream_files", LOG + "SELECT event_id, user_id, broker_name, queue_id, queue_offset FROM log WHERE tags = 'click'")
def log_stream_files(spark, sf):
    stream = scan.read_log_stream(
        spark, _log(spark, sf, tag="click"), fx.EVENT_SCHEMA, engine="files",
        columns=["event_id", "user_id"], metadata=[*QUEUE, "queue_offset"],
    )
    return _run(spark, stream)


def _run(spark: SparkSession, stream: DataFrame, close_windows: bool = False) -> DataFrame:
    """Run a stream over what is there and read its output."""
    folder = scratch_path(spark, "stream")
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    )
    if close_windows:  # takes one more, empty batch, which availableNow would not run
        running = writer.start()
        running.processAllAvailable()
        running.stop()
    else:
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


# -- formats -----------------------------------------------------------------------------

EVENT_COLUMNS = "event_id, user_id, event_type, value, props, ts"


@query("decode_json", f"SELECT {EVENT_COLUMNS} FROM events")
def decode_json(spark, sf):
    return scan.read_log(spark, _log(spark, sf), fx.EVENT_SCHEMA)


def _event_row(df: DataFrame, names: str = EVENT_COLUMNS) -> tuple[Column, object]:
    columns = names.split(", ")
    return F.struct(*columns), df.select(*columns).schema


@query("encode_json", "SELECT event_id, user_id, event_type, value, props FROM events")
def encode_json(spark, sf):
    events = fx.table(spark, sf, "events")
    row, schema = _event_row(events)
    body = events.select(formats.encode(row, "json", schema).cast("string").alias("j"))
    # read back by another parser than the format's own
    v = F.try_parse_json("j")
    return body.select(
        *[F.variant_get(v, f"$.{n}", t).alias(n) for n, t in
          (("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string"))]
    )


@query("decode_csv", f"SELECT {EVENT_COLUMNS} FROM events")
def decode_csv(spark, sf):
    events = fx.table(spark, sf, "events")

    def cell(name: str) -> Column:
        return F.concat(F.lit('"'), F.replace(F.col(name).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))

    body = F.concat_ws(",", *[cell(n) for n in EVENT_COLUMNS[:-4].split(", ")], F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    schema = events.select(*EVENT_COLUMNS.split(", ")).schema
    return formats.decode(events.select(body.cast("binary").alias("body")), "csv", schema).select("value.*")


@query("decode_csv_skip", "SELECT l_orderkey AS a, l_extendedprice AS b FROM lineitem WHERE l_orderkey % 5 <> 0")
def decode_csv_skip(spark, sf):
    """Bodies that do not parse are dropped."""
    good = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_extendedprice").cast("string"))
    body = F.when(F.col("l_orderkey") % 5 == 0, F.lit("x,y")).otherwise(good).cast("binary")
    messages = fx.table(spark, sf, "lineitem").select(body.alias("body"))
    return formats.decode(messages, "csv", "a bigint, b double", on_error="skip").select("value.*")


@query("encode_csv", f"SELECT {EVENT_COLUMNS} FROM events")
def encode_csv(spark, sf):
    events = fx.table(spark, sf, "events")
    row, schema = _event_row(events)
    options = {"field-delimiter": "|"}
    body = events.select(formats.encode(row, "csv", schema, options=options).alias("body"))
    return formats.decode(body, "csv", schema, options=options).select("value.*")


@query("decode_raw", "SELECT event_id, props, user_id AS number FROM events")
def decode_raw(spark, sf):
    events = fx.table(spark, sf, "events").select(
        "event_id", F.col("props").cast("binary").alias("body"), fx.big_endian(F.col("user_id"), 8).alias("n")
    )
    return formats.decode(events, "raw", "props string").select(
        "event_id", "value.props", formats.decode_raw(F.col("n"), "bigint").alias("number")
    )


@query("encode_raw", "SELECT event_id, props FROM events")
def encode_raw(spark, sf):
    events = fx.table(spark, sf, "events")
    body = formats.encode(F.struct("props"), "raw", as_schema("props string"))
    return events.select("event_id", body.cast("string").alias("props"))


def _decode_changes(spark, sf, fmt):
    rows = formats.decode(fx.change_messages(spark, sf, fmt), fmt, fx.ORDER_SCHEMA)
    return rows.select("seq", "row_kind", "value.*")


DECODED_CHANGES = CHANGES + "SELECT * FROM changelog"

for _fmt in ("debezium-json", "canal-json", "maxwell-json", "ogg-json"):
    query(f"decode_{_fmt.removesuffix('-json')}", DECODED_CHANGES)(
        lambda spark, sf, fmt=_fmt: _decode_changes(spark, sf, fmt)
    )


@query("decode_messages", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem")
def decode_messages(spark, sf):
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    items = fx.table(spark, sf, "lineitem").select(names)
    body = formats.encode(F.struct(*names), "json", items.schema)
    return formats.decode(items.select(body.alias("body")), "json", items.schema).select("value.*")


@query(
    "decode_multi",
    "SELECT event_id, user_id, CAST(unnest(range(event_id % 4)) AS INT) AS item FROM events",
)
def decode_multi(spark, sf):
    events = fx.table(spark, sf, "events").withColumn("n", (F.col("event_id") % 4).cast("int"))
    items = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(F.col("user_id"), i.alias("item"))))
    items = F.coalesce(items, F.array().cast("array<struct<user_id:bigint,item:int>>"))
    messages = events.select("event_id", F.to_json(items).cast("binary").alias("body"))
    return formats.decode(messages, "json", "user_id bigint, item int", multi=True).select("event_id", "value.*")


@query(
    "null_body",
    LOG + """SELECT broker_name, queue_id, queue_offset, event_id % 9 = 0 AS is_tombstone,
    CASE WHEN event_id % 9 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 9 <> 0 THEN value END AS value FROM log""",
)
def null_body(spark, sf):
    id_ = F.get_json_object(F.col("body").cast("string"), "$.event_id").cast("bigint")
    messages = fx.events_messages(spark, sf).withColumn("body", F.when(id_ % 9 != 0, F.col("body")))
    rows = formats.decode(messages, "json", "event_id bigint, value double")
    return rows.select(*QUEUE, "queue_offset", "is_tombstone", "value.event_id", "value.value")


def _some_broken(spark, sf) -> DataFrame:
    events = fx.table(spark, sf, "events")
    row, schema = _event_row(events)
    body = F.when(F.col("event_id") % 13 == 0, F.lit("{bad").cast("binary")).otherwise(formats.encode(row, "json", schema))
    return events.select(F.col("event_id").alias("message_id"), body.alias("body"))


@query(
    "decode_error_policy",
    """SELECT event_id AS message_id, event_id % 13 <> 0 AS decoded,
       CASE WHEN event_id % 13 <> 0 THEN user_id END AS user_id FROM events""",
)
def decode_error_policy(spark, sf):
    good, bad = formats.split_quarantine(_some_broken(spark, sf), "json", fx.EVENT_SCHEMA)
    rows = formats.decode(good, "json", fx.EVENT_SCHEMA)
    return rows.select("message_id", F.lit(True).alias("decoded"), "value.user_id").unionByName(
        bad.select("message_id", F.lit(False).alias("decoded"), F.lit(None).cast("bigint").alias("user_id"))
    )


@query("decode_error_skip", "SELECT event_id, user_id, value FROM events WHERE event_id % 13 <> 0")
def decode_error_skip(spark, sf):
    rows = formats.decode(_some_broken(spark, sf), "json", "event_id bigint, user_id bigint, value double", on_error="skip")
    return rows.select("value.*")


@query(
    "tag_filter",
    LOG + """, tagged AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '' ELSE tags END AS tags FROM log)
    SELECT 'click' AS tag_option, event_id FROM tagged WHERE coalesce(tags,'')='' OR tags='click'
    UNION ALL SELECT '', event_id FROM tagged""",
)
def tag_filter(spark, sf):
    id_ = F.get_json_object(F.col("body").cast("string"), "$.event_id").cast("bigint")
    messages = fx.events_messages(spark, sf).withColumn("event_id", id_)
    tagged = messages.withColumn(
        "tags", F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, "").otherwise(F.col("tags"))
    )
    return scan.tag_filter(tagged, "click").select(F.lit("click").alias("tag_option"), "event_id").unionByName(
        scan.tag_filter(tagged, "").select(F.lit("").alias("tag_option"), "event_id")
    )


@query("metadata_topic", LOG + "SELECT event_id, topic AS source_topic FROM log")
def metadata_topic(spark, sf):
    return scan.read_log(
        spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id"], metadata={"source_topic": "topic"}
    )


@query("metadata_converter", LOG + "SELECT event_id, 'events/' || broker_name || '/' || queue_id AS source_queue, CAST(ts AS DATE) AS day FROM log")
def metadata_converter(spark, sf):
    """Metadata columns from expressions over the message."""
    name = F.concat_ws("/", "topic", "broker_name", F.col("queue_id").cast("string"))
    return scan.read_log(
        spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id"],
        metadata={"source_queue": name, "day": F.to_date("store_timestamp")},
    )


@query("custom_deserializer", LOG + "SELECT queue_offset, queue_id, event_id, CAST(unnest(range(event_id % 3)) AS BIGINT) AS part FROM log")
def custom_deserializer(spark, sf):
    """A body to any number of rows by user code in Python."""

    def open_decoder():
        import json

        def decode_one(body):
            event = json.loads(body)
            for part in range(event["event_id"] % 3):
                yield {"event_id": event["event_id"], "part": part}

        return decode_one

    messages = fx.events_messages(spark, sf)
    return formats.decode_python(messages, open_decoder, "event_id bigint, part bigint", ["queue_offset", "queue_id"])


@query("custom_serializer", "SELECT event_id, event_type || ':' || CAST(user_id AS VARCHAR) AS body FROM events")
def custom_serializer(spark, sf):
    """A row to a body by a user expression."""
    names = ["event_id", "event_type", "user_id"]
    events = fx.table(spark, sf, "events").select(names)
    body = formats.encode(
        F.struct(*names), "json", events.schema,
        encoder=lambda row: F.concat_ws(":", row["event_type"], row["user_id"].cast("string")).cast("binary"),
    )
    return events.select("event_id", body.cast("string").alias("body"))


@query(
    "sql_over_topic",
    "SELECT event_type, count(*) AS n, sum(user_id) AS users FROM events WHERE value > 10 GROUP BY event_type",
)
def sql_over_topic(spark, sf):
    scan.register_topic(spark, "events_topic", _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_type", "user_id", "value"])
    return spark.sql(
        "SELECT event_type, count(*) AS n, sum(user_id) AS users FROM events_topic WHERE value > 10 GROUP BY event_type"
    )


# -- binary fields -----------------------------------------------------------------------

ITEM = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _items(spark, sf) -> DataFrame:
    return fx.table(spark, sf, "lineitem")


def _bin(name: str, encode: Callable[[], Column], kind: str, sql: str, shown: Callable[[Column], Column] = lambda c: c):
    def run(spark, sf):
        items = _items(spark, sf).select(*ITEM.split(", "), encode().alias("field"))
        return binary.decode_binary_fields(items, {"field": kind}).select(*ITEM.split(", "), shown(F.col("field")).alias("field"))

    query(name, f"SELECT {ITEM}, {sql} AS field FROM lineitem")(run)


def _c(name: str) -> Column:
    return F.col(name)


_SHIFTED = "l_shipdate + to_microseconds(l_orderkey * 7919)"


def _shifted() -> Column:
    return F.timestamp_millis(F.floor((F.unix_micros(_c("l_shipdate").cast("timestamp")) + _c("l_orderkey") * 7919) / 1000))


_bin("bin_int", lambda: fx.big_endian(_c("l_partkey") * 1000003 - 1000000000, 4), "int",
     "CAST(((l_partkey * 1000003 - 1000000000 + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 AS INT)")
_bin("bin_long", lambda: fx.big_endian(_c("l_partkey") * 1000000007 - _c("l_orderkey"), 8), "bigint",
     "l_partkey * 1000000007 - l_orderkey")
_bin("bin_short", lambda: fx.big_endian(_c("l_orderkey") % 65536 - 32768, 2), "smallint",
     "CAST(l_orderkey % 65536 - 32768 AS SMALLINT)")
_bin("bin_byte", lambda: F.when(_c("l_orderkey") % 5 != 0, fx.big_endian(_c("l_orderkey") % 256 - 128, 1)), "tinyint",
     "CAST(CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE l_orderkey % 256 - 128 END AS TINYINT)")
_bin("bin_float", lambda: fx.float_bytes(_c("l_extendedprice") / -3), "float",
     "CAST(CAST(l_extendedprice / -3 AS FLOAT) AS DOUBLE)", lambda c: c.cast("double"))
_bin("bin_double", lambda: fx.double_bytes(_c("l_extendedprice") / -3), "double", "l_extendedprice / -3")
_bin("bin_boolean", lambda: fx.big_endian(_c("l_partkey") % 3, 1), "boolean", "l_partkey % 3 <> 0")
_bin("bin_string", lambda: F.when(_c("l_partkey") % 7 != 0, F.concat(_c("l_returnflag"), F.lit("é")).cast("binary")), "string",
     "CASE WHEN l_partkey % 7 = 0 THEN '' ELSE l_returnflag || 'é' END")
_bin("bin_bytes", lambda: fx.big_endian(_c("l_partkey"), 4), "binary",
     "lpad(to_hex(l_partkey), 8, '0')", lambda c: F.hex(c))
_bin("bin_bigint", lambda: F.concat(fx.big_endian(_c("l_orderkey") - 500, 8), fx.big_endian(_c("l_partkey"), 8)), "biginteger",
     "CAST(CAST(l_orderkey - 500 AS HUGEINT) * 18446744073709551616 + l_partkey AS VARCHAR)", lambda c: c.cast("string"))
_bin("bin_decimal",
     lambda: F.concat(fx.big_endian(_c("l_linenumber") % 4, 4), fx.big_endian(_c("l_partkey") * 12345 - 9999999, 8)), "decimal(20,3)",
     "CAST(CAST(l_partkey * 12345 - 9999999 AS DOUBLE) / power(10, l_linenumber % 4) AS DOUBLE)", lambda c: c.cast("double"))
_bin("bin_decimal38",
     lambda: F.concat(fx.big_endian(_c("l_partkey") * 0 + 2, 4), fx.big_endian(_c("l_partkey") * 100, 8)), "decimal(38,0)",
     "CAST(l_partkey AS VARCHAR)", lambda c: c.cast("string"))
_bin("bin_timestamp", lambda: fx.big_endian(fx.millis(_shifted()), 8), "timestamp",
     f"make_timestamp(epoch_us({_SHIFTED}) // 1000 * 1000)", lambda c: c.cast("timestamp_ntz"))
_bin("bin_date", lambda: fx.big_endian(fx.millis(_shifted()), 8), "date", f"CAST({_SHIFTED} AS DATE)")


@query("bin_time", f"SELECT {ITEM}, (epoch_us({_SHIFTED}) // 1000) % 86400000 AS field FROM lineitem")
def bin_time(spark, sf):
    items = _items(spark, sf).select(*ITEM.split(", "), fx.big_endian(fx.millis(_shifted()), 8).alias("field"))
    # milliseconds of the day whatever the session says about the TIME type
    return items.withColumn("field", binary.bin_time(F.col("field"), time_type=False))


@query(
    "bin_length_check",
    f"SELECT {ITEM}, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey END AS field FROM lineitem",
)
def bin_length_check(spark, sf):
    whole = fx.big_endian(F.col("l_partkey"), 8)
    cut = F.when(F.col("l_partkey") % 4 == 0, F.substring(whole, 1, 7)).otherwise(whole)
    items = _items(spark, sf).select(*ITEM.split(", "), cut.alias("field"))
    return binary.decode_binary_fields(items, {"field": "bigint"}, strict=False)


@query(
    "type_index",
    """SELECT l_orderkey AS a, CAST(l_partkey AS INT) AS b, CAST(l_linenumber AS SMALLINT) AS c, l_quantity AS d,
       l_returnflag AS e, l_linestatus = 'O' AS f, l_shipdate AS g FROM lineitem""",
)
def type_index(spark, sf):
    """Decoders chosen by declared type, several columns at once."""
    items = _items(spark, sf).select(
        fx.big_endian(F.col("l_orderkey"), 8).alias("a"), fx.big_endian(F.col("l_partkey"), 4).alias("b"),
        fx.big_endian(F.col("l_linenumber"), 2).alias("c"), fx.double_bytes("l_quantity").alias("d"),
        F.col("l_returnflag").cast("binary").alias("e"),
        F.when(F.col("l_linestatus") == "O", F.lit(b"\x01")).otherwise(F.lit(b"\x00")).alias("f"),
        fx.big_endian(fx.millis(F.col("l_shipdate")), 8).alias("g"),
    )
    types = {"a": "bigint", "b": "int", "c": "smallint", "d": "double", "e": "string", "f": "boolean", "g": "timestamp"}
    return binary.decode_binary_fields(items, types).withColumn("g", _ntz("g"))


# -- string fields -----------------------------------------------------------------------


def _str(name: str, encode: Callable[[], Column], kind: str, sql: str, shown: Callable[[Column], Column] = lambda c: c, **how):
    def run(spark, sf):
        items = _items(spark, sf).select(*ITEM.split(", "), encode().alias("field"))
        return text.decode_string_fields(items, {"field": kind}, **how).select(*ITEM.split(", "), shown(F.col("field")).alias("field"))

    query(name, f"SELECT {ITEM}, {sql} AS field FROM lineitem")(run)


_str("str_null_values",
     lambda: F.when(_c("l_partkey") % 3 == 0, "NULL").when(_c("l_partkey") % 3 == 1, "").otherwise(_c("l_partkey").cast("string")),
     "bigint", "CASE WHEN l_partkey % 3 = 2 THEN l_partkey END", null_values={"", "NULL", "\\N"})
_str("str_bytes",
     lambda: F.when(_c("l_partkey") % 5 == 0, "not base64!").otherwise(F.base64(_c("l_returnflag").cast("binary"))),
     "binary", "CASE WHEN l_partkey % 5 <> 0 THEN l_returnflag END", lambda c: c.cast("string"), raw=True)
_str("str_string", lambda: _c("l_returnflag"), "string", "l_returnflag")
_str("str_long", lambda: (_c("l_partkey") - 700).cast("string"), "bigint", "l_partkey - 700")
_str("str_int", lambda: F.concat(F.lit("+"), _c("l_partkey").cast("string")), "int", "CAST(l_partkey AS INT)")
_str("str_short", lambda: (_c("l_orderkey") % 30000).cast("string"), "smallint", "CAST(l_orderkey % 30000 AS SMALLINT)")
_str("str_byte", lambda: (_c("l_orderkey") % 256 - 128).cast("string"), "tinyint", "CAST(l_orderkey % 256 - 128 AS TINYINT)")
_str("str_double", lambda: _c("l_extendedprice").cast("string"), "double", "l_extendedprice")
_str("str_float", lambda: _c("l_quantity").cast("string"), "float", "l_quantity", lambda c: c.cast("double"))
_str("str_boolean",
     lambda: F.element_at(F.array(*map(F.lit, ("true", "FALSE", "1", "0", "True", "yes"))), (_c("l_partkey") % 6 + 1).cast("int")),
     "boolean", "CASE l_partkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN true END",
     strict=False)
_str("str_timestamp",
     lambda: F.when(_c("l_partkey") % 2 == 0, fx.millis(_shifted()).cast("string")).otherwise(
         F.date_format(_shifted(), "yyyy-M-d H:m:s.SSS")),
     "timestamp", f"make_timestamp(epoch_us({_SHIFTED}) // 1000 * 1000)", lambda c: c.cast("timestamp_ntz"))
_str("str_timestamp_raw", lambda: fx.millis(_shifted()).cast("string"), "timestamp", f"epoch_us({_SHIFTED}) // 1000", raw=True)
_str("str_date", lambda: F.date_format("l_shipdate", "yyyy-M-d"), "date", "CAST(l_shipdate AS DATE)")
_str("str_decimal", lambda: _c("l_extendedprice").cast("decimal(15,2)").cast("string"), "decimal(12,1)",
     "CAST(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DECIMAL(12,1)) AS DOUBLE)", lambda c: c.cast("double"))
_str("str_bigint", lambda: F.concat(_c("l_orderkey").cast("string"), F.lit("00000000000000000000001")), "decimal(38,0)",
     "CAST(CAST(l_orderkey AS HUGEINT) * 100000000000000000000000 + 1 AS VARCHAR)", lambda c: c.cast("string"))


@query(
    "str_numeric",
    """SELECT CAST(l_orderkey % 256 - 128 AS TINYINT) AS a, CAST(l_orderkey % 30000 AS SMALLINT) AS b, CAST(-l_partkey AS INT) AS c,
       l_orderkey AS d, l_quantity AS e, CASE WHEN l_partkey % 6 <> 0 THEN l_extendedprice END AS f FROM lineitem""",
)
def str_numeric(spark, sf):
    """All number types at once; null stays null."""
    items = _items(spark, sf).select(
        (F.col("l_orderkey") % 256 - 128).cast("string").alias("a"), (F.col("l_orderkey") % 30000).cast("string").alias("b"),
        (-F.col("l_partkey")).cast("string").alias("c"), F.col("l_orderkey").cast("string").alias("d"),
        F.col("l_quantity").cast("string").alias("e"),
        F.when(F.col("l_partkey") % 6 != 0, F.col("l_extendedprice").cast("string")).alias("f"),
    )
    types = {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float", "f": "double"}
    return text.decode_string_fields(items, types).withColumn("e", F.col("e").cast("double"))


@query("str_time", f"SELECT {ITEM}, (epoch_us({_SHIFTED}) // 1000) % 86400000 AS field FROM lineitem")
def str_time(spark, sf):
    items = _items(spark, sf).select(*ITEM.split(", "), fx.millis(_shifted()).cast("string").alias("field"))
    return items.withColumn("field", text.str_time(F.col("field"), time_type=False))


# -- event time --------------------------------------------------------------------------


@query(
    "event_time",
    LOG + """SELECT tags, time_bucket(INTERVAL 1 HOUR, store_timestamp) AS hour, count(*) AS n, max(event_id) AS last_event
    FROM log GROUP BY ALL""",
)
def hourly_tags(spark, sf):
    rows = scan.read_log(
        spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id"], metadata=["store_timestamp", "tags"]
    )
    timed = event_time.with_event_time(rows.withColumn("store_timestamp", _ntz("store_timestamp")))
    return (
        timed.groupBy("tags", F.window("store_timestamp", "1 hour").alias("w"))
        .agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))
        .select("tags", F.col("w.start").alias("hour"), "n", "last_event")
    )


@query(
    "queue_watermarks",
    LOG + """, q AS (SELECT broker_name, queue_id, max(store_timestamp) - INTERVAL 5 MINUTE AS watermark FROM log GROUP BY ALL)
    SELECT broker_name, queue_id, watermark, (SELECT min(watermark) FROM q) AS combined FROM q""",
)
def queue_watermarks(spark, sf):
    each = event_time.queue_watermarks(fx.events_messages(spark, sf), "5 minutes")
    combined = each.agg(F.min("watermark")).scalar()
    return each.select(*QUEUE, _ntz("watermark").alias("watermark"), combined.cast("timestamp_ntz").alias("combined"))


@query(
    "watermark",
    LOG + """SELECT time_bucket(INTERVAL 1 HOUR, store_timestamp) AS hour, count(*) AS n FROM log GROUP BY ALL
    HAVING time_bucket(INTERVAL 1 HOUR, min(store_timestamp)) + INTERVAL 1 HOUR
      <= (SELECT date_trunc('millisecond', max(store_timestamp)) - INTERVAL 5 MINUTE FROM log)""",
)
def watermark(spark, sf):
    """Windows the watermark has closed, from a stream in append mode."""
    stream = scan.read_log_stream(spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id"], watermark="5 minutes")
    counts = stream.groupBy(F.window("store_timestamp", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    return _run(spark, counts.select(F.col("w.start").alias("hour"), "n"), close_windows=True).withColumn("hour", _ntz("hour"))


# -- changelogs --------------------------------------------------------------------------

UPSERTED = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0"""


@query("upsert_materialize", UPSERTED)
def upsert_materialize(spark, sf):
    state = changelog.upsert_materialize(fx.changelog(spark, sf), ["o_orderkey"], ["seq"])
    return state.drop("seq", "at")


@query(
    "upsert_events",
    LOG + """SELECT user_id, event_type, value FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM log) WHERE rn = 1 AND event_type <> 'error'""",
)
def upsert_events(spark, sf):
    """The last event per user; an error event stands for a delete."""
    rows = scan.read_log(spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id", "user_id", "event_type", "value"])
    kinds = rows.withColumn("row_kind", F.when(F.col("event_type") == "error", "-D").otherwise("+U"))
    return changelog.upsert_materialize(kinds, ["user_id"], ["event_id"]).select("user_id", "event_type", "value")


@query("upsert_tombstone", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0")
def upsert_tombstone(spark, sf):
    """Every delete is followed by a message without body, which changes nothing."""
    image = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    insert = F.concat(F.lit('{"before":null,"op":"c","after":'), image, F.lit("}"))
    delete = F.concat(F.lit('{"after":null,"op":"d","before":'), image, F.lit("}"))
    gone = F.array(insert, delete, F.lit(None).cast("string"))
    bodies = F.when(F.col("o_orderkey") % 10 == 0, gone).otherwise(F.array(insert))
    messages = fx.table(spark, sf, "orders").select(F.posexplode(bodies).alias("seq", "text"))
    messages = messages.select("seq", F.col("text").cast("binary").alias("body"))
    rows = formats.decode(messages, "debezium-json", "o_orderkey bigint, o_orderstatus string")
    return changelog.upsert_materialize(rows.select("seq", "row_kind", "value.*"), ["o_orderkey"], ["seq"]).drop("seq")


@query("upsert_stream", UPSERTED)
def upsert_stream(spark, sf):
    """A changelog topic read as a stream; changes per key, then the table they lead to."""

    def build(path: str) -> None:
        sink.write_log(
            fx.changelog(spark, sf), fx.options(path, "orders", "debezium-json"), exclude=("seq", "at"),
            order=["o_orderkey", "seq", "at"], stage=False,
            partitioner=lambda row, key, body, topic, n: F.pmod(F.xxhash64(row["o_orderkey"]), F.lit(n)),
        )

    path = fx.once(spark, "orders-changes", sf, build)
    schema = as_schema(fx.ORDER_SCHEMA)
    stream = scan.read_log_stream(
        spark, fx.options(path, "orders", "debezium-json"), schema, metadata=["queue_offset"], primary_key=["o_orderkey"]
    )
    folder = scratch_path(spark, "upserts")
    changed = changelog.last_changes(stream, ["o_orderkey"], ["queue_offset"])

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    changed.writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    latest = spark.read.schema(changed.schema).parquet(f"{folder}/out")
    return changelog.upsert_materialize(latest, ["o_orderkey"], ["queue_offset"]).select(schema.names)


@query(
    "encode_changelog",
    CHANGES + """SELECT f.fmt, seq, o_orderkey, row_kind IN ('-U', '-D') AS removes, o_totalprice FROM changelog,
    (VALUES ('debezium-json'), ('canal-json'), ('maxwell-json'), ('ogg-json')) f(fmt)""",
)
def encode_changelog(spark, sf):
    rows = fx.changelog(spark, sf)
    schema = as_schema(fx.ORDER_SCHEMA)
    value = F.struct(*schema.names)
    parts = []
    for fmt in cdc.ENCODERS:
        body = formats.encode(value, fmt, schema, kind=F.col("row_kind"))
        back = formats.decode(rows.select("seq", body.alias("body")), fmt, schema)
        parts.append(
            back.select(F.lit(fmt).alias("fmt"), "seq", "value.o_orderkey", (F.col("row_kind") == "-D").alias("removes"), "value.o_totalprice")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "changelog_mode",
    CHANGES + "SELECT row_kind, count(*) AS n FROM changelog GROUP BY ALL",
)
def changelog_mode(spark, sf):
    """Row kinds a format delivers, as declared and as counted."""
    kinds = opt.changelog_mode("debezium-json")
    rows = _decode_changes(spark, sf, "debezium-json")
    return rows.where(F.col("row_kind").isin(sorted(kinds))).groupBy("row_kind").agg(F.count("*").alias("n"))


# -- sinks -------------------------------------------------------------------------------


def _per_queue(messages: DataFrame) -> DataFrame:
    return messages.groupBy("queue_id").agg(
        F.count("*").alias("n"), F.min("queue_offset").alias("first_offset"),
        F.max("queue_offset").alias("last_offset"), F.count_distinct("queue_offset").alias("n_offsets"),
    )


def _users(row, key, body, topic, n):
    return F.pmod(row["user_id"], F.lit(n))


@query(
    "write_log",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'orders' AS topic, 'new' AS tags FROM orders",
)
def write_log(spark, sf):
    def build(path: str) -> None:
        orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
        sink.write_log(orders, fx.options(path, "orders", tag="new"), order=["o_orderkey"], queues=5)

    path = fx.once(spark, "orders", sf, build)
    return scan.read_log(
        spark, fx.options(path, "orders"),
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string", metadata=["topic", "tags"],
    )


@query("sink_headers", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 1 ELSE 2 END AS n_headers FROM events")
def sink_headers(spark, sf):
    props = F.when(F.col("event_id") % 4 != 1, F.col("props").cast("binary"))
    given = F.when(
        F.col("event_id") % 4 != 0,
        F.create_map(F.lit("type"), F.col("event_type").cast("binary"), F.lit("props"), props),
    )
    kept = fx.table(spark, sf, "events").select("event_id", sink.sink_headers(given).alias("h"))
    return kept.select("event_id", F.when(F.col("h").isNotNull(), F.size("h")).alias("n_headers"))


@query("sink_timestamp", LOG + "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS msg_timestamp FROM log")
def sink_timestamp(spark, sf):
    rows = scan.read_log(spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id"], metadata=["msg_timestamp"])
    return rows.withColumn("msg_timestamp", _ntz("msg_timestamp"))


@query("part_default", "SELECT count(*) AS n, true AS all_placed FROM events")
def part_default(spark, sf):
    placed = partitioners.round_robin(fx.table(spark, sf, "events"), 5)
    return placed.agg(F.count("*").alias("n"), F.bool_and(F.col("queue_id").between(0, 4)).alias("all_placed"))


@query(
    "part_fixed",
    "SELECT n.n_queues, event_id, CAST((user_id % 3) % n.n_queues AS INT) AS queue_id FROM events, (VALUES (2), (4), (5)) n(n_queues)",
)
def part_fixed(spark, sf):
    events = fx.table(spark, sf, "events").withColumn("producer_id", F.col("user_id") % 3)
    parts = [
        partitioners.fixed(events, n, "producer_id").select(F.lit(n).alias("n_queues"), "event_id", "queue_id")
        for n in (2, 4, 5)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "part_round_robin",
    """SELECT event_id, user_id % 3 AS producer_id,
    CAST((row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1) % 4 AS INT) AS queue_id FROM events""",
)
def part_round_robin(spark, sf):
    events = fx.table(spark, sf, "events").withColumn("producer_id", F.col("user_id") % 3)
    return partitioners.round_robin(events, 4, "producer_id", ["event_id"]).select("event_id", "producer_id", "queue_id")


@query("part_custom", "SELECT event_id, CAST(user_id % 4 AS INT) AS queue_id FROM events")
def part_custom(spark, sf):
    return partitioners.custom(fx.table(spark, sf, "events"), 4, _users, topic="events").select("event_id", "queue_id")


@query(
    "buffer_compact_rows",
    LOG + "SELECT broker_name, queue_id, user_id, max(event_id) AS event_id, arg_max(value, queue_offset) AS value FROM log "
    "GROUP BY broker_name, queue_id, queue_offset // 64, user_id",
)
def buffer_compact_rows(spark, sf):
    rows = _event_rows(spark, sf)
    return compaction.compact_rows(rows, QUEUE, "queue_offset", ["user_id"], 64).select(*QUEUE, "user_id", "event_id", "value")


def _event_rows(spark, sf) -> DataFrame:
    return scan.read_log(
        spark, _log(spark, sf), fx.EVENT_SCHEMA, columns=["event_id", "user_id", "value"],
        metadata=[*QUEUE, "queue_offset", "store_timestamp"],
    )


@query(
    "buffer_compact_interval",
    LOG + "SELECT broker_name, queue_id, user_id, max(event_id) AS event_id, arg_max(value, queue_offset) AS value FROM log "
    "GROUP BY broker_name, queue_id, time_bucket(INTERVAL 1 HOUR, store_timestamp), user_id",
)
def buffer_compact_interval(spark, sf):
    rows = compaction.compact_interval(_event_rows(spark, sf), QUEUE, "queue_offset", ["user_id"], "store_timestamp", 3_600_000)
    return rows.select(*QUEUE, "user_id", "event_id", "value")


@query(
    "buffer_compact",
    LOG + """, w AS (SELECT *, time_bucket(INTERVAL 1 DAY, store_timestamp) AS day FROM log),
    n AS (SELECT *, row_number() OVER (PARTITION BY broker_name, queue_id, day ORDER BY queue_offset) - 1 AS seq FROM w)
    SELECT broker_name, queue_id, user_id, max(event_id) AS event_id FROM n GROUP BY broker_name, queue_id, day, seq // 20, user_id""",
)
def buffer_compact(spark, sf):
    """Both limits on, as the sink needs them: a flush every 20 rows and at the end of a day."""
    rows = compaction.compact(_event_rows(spark, sf), QUEUE, ["queue_offset"], ["user_id"], "store_timestamp", 20, 86_400_000)
    return rows.select(*QUEUE, "user_id", "event_id")


def _hot(spark, sf) -> DataFrame:
    """Orders as messages; one queue of eight holds more than a third of them."""
    queue = F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey") % 8).cast("int")
    return fx.table(spark, sf, "orders").select(
        F.lit("orders").alias("topic"), F.lit("broker-0").alias("broker_name"), queue.alias("queue_id"), "o_orderdate", "o_orderkey"
    )


@query(
    "assign_offsets",
    """WITH q AS (SELECT *, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 8 END AS INT) AS queue_id FROM orders)
    SELECT queue_id, o_orderkey, 1000 + row_number() OVER (PARTITION BY queue_id ORDER BY o_orderdate, o_orderkey) - 1 AS queue_offset FROM q""",
)
def assign_offsets(spark, sf):
    rows = _hot(spark, sf)
    ends = rows.select(QUEUE_KEY).distinct().withColumn("offset", F.lit(1000).cast("bigint"))
    # small buckets, so that the hot queue is cut at every scale
    return sink.assign_offsets(rows, ["o_orderdate", "o_orderkey"], ends, rows_per_bucket=997).select(
        "queue_id", "o_orderkey", "queue_offset"
    )


@query(
    "assign_offsets_nulls",
    """WITH q AS (SELECT *, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 8 END AS INT) AS queue_id FROM orders)
    SELECT queue_id, o_orderkey, 1000 + row_number() OVER (PARTITION BY queue_id ORDER BY o_orderdate, o_orderkey) - 1 AS queue_offset FROM q""",
)
def assign_offsets_nulls(spark, sf):
    """Half of the queues have no broker name."""
    rows = _hot(spark, sf).withColumn("broker_name", F.when(F.col("queue_id") % 2 == 1, F.col("broker_name")))
    ends = rows.select(QUEUE_KEY).distinct().withColumn("offset", F.lit(1000).cast("bigint"))
    return sink.assign_offsets(rows, ["o_orderdate", "o_orderkey"], ends, rows_per_bucket=997).select(
        "queue_id", "o_orderkey", "queue_offset"
    )


@query(
    "restrict_many_queues",
    """SELECT CAST(l_partkey % 80 AS INT) AS queue_id, count(*) AS messages FROM lineitem
    WHERE l_orderkey * 10 + l_linenumber >= (l_partkey % 80) * 100 GROUP BY 1""",
)
def restrict_many_queues(spark, sf):
    """More queues than become literal ranges, half of them without a broker name."""
    queue = (F.col("l_partkey") % 80).cast("int")
    log = fx.table(spark, sf, "lineitem").select(
        F.lit("items").alias("topic"), F.when(queue % 2 == 0, F.lit("broker-0")).alias("broker_name"), queue.alias("queue_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("queue_offset"),
    )
    starts = log.select(QUEUE_KEY).distinct().withColumn("offset", F.col("queue_id").cast("bigint") * 100)
    return positions.restrict(log, starts).groupBy("queue_id").agg(F.count("*").alias("messages"))


def _copy(spark, sf, guarantee: str, replay: bool = False) -> DataFrame:
    """The events topic streamed into another topic."""
    source = fx.events_log(spark, sf)
    folder = scratch_path(spark, "copy")
    target = {
        **fx.options(f"{folder}/log", "copy"), "sink.delivery-guarantee": guarantee,
        "sink.transactional-id-prefix": "copy",
    }
    stream = scan.read_log_stream(
        spark, fx.options(source), fx.EVENT_SCHEMA, metadata=["store_timestamp", *QUEUE_KEY, "queue_offset"]
    )
    writer = sink.write_log_stream(
        stream, target, checkpoint=None if guarantee == "none" else f"{folder}/checkpoint",
        commit_group=(source, "events", f"copy-{guarantee}"), exclude=("store_timestamp",),
        store_timestamp=F.col("store_timestamp"), order=["event_id"], partitioner=_users, queues=4,
    )
    if guarantee == "none":
        writer = writer.option("checkpointLocation", f"{folder}/progress")
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()
    if replay:  # the same batch of the same streaming query once more
        batch = scan.read_log(spark, fx.options(source), fx.EVENT_SCHEMA, metadata=["store_timestamp"])
        sink.write_log(batch, target, txn=f"{run.id}-0", exclude=("store_timestamp",), store_timestamp=F.col("store_timestamp"),
                       order=["event_id"], partitioner=_users, queues=4)
    return _per_queue(storage.messages(spark, f"{folder}/log", "copy"))


COPIED = """SELECT CAST(user_id % 4 AS INT) AS queue_id, count(*) AS n, CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset,
  count(*) AS n_offsets FROM events GROUP BY ALL"""

query("delivery_none", COPIED)(lambda spark, sf: _copy(spark, sf, "none"))
query("delivery_at_least_once", COPIED)(lambda spark, sf: _copy(spark, sf, "at-least-once"))
query("delivery_exactly_once", COPIED)(lambda spark, sf: _copy(spark, sf, "exactly-once", replay=True))


@query(
    "committed_offsets",
    LOG + "SELECT broker_name, queue_id, max(queue_offset)+1 AS next_offset FROM log WHERE tags = 'view' GROUP BY ALL",
)
def committed_offsets(spark, sf):
    """Offsets a group commits after reading, and reads back as its position."""
    path = fx.events_log(spark, sf)
    read = scan.read_messages(spark, fx.options(path)).where("tags = 'view'")
    positions.commit_offsets(spark, path, "viewers", "events", positions.resume_offsets(read))
    return positions.committed_offsets(spark, path, "viewers", "events").select(*QUEUE, F.col("offset").alias("next_offset"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Events per hour and tag, with a tag filter, from a topic read at its earliest offset."""
    rows = scan.read_log(
        spark, _log(spark, sf, tag="click"), fx.EVENT_SCHEMA,
        columns=["event_id", "value"], metadata=["store_timestamp", "tags"],
    )
    return (
        rows.groupBy("tags", F.window("store_timestamp", "1 hour").alias("w"))
        .agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"), F.max("value").alias("top_value"))
        .select("tags", _ntz("w.start").alias("hour"), "n", "last_event", "top_value")
    )


query(
    "tagged_hourly",
    LOG + """SELECT tags, time_bucket(INTERVAL 1 HOUR, store_timestamp) AS hour, count(*) AS n, max(event_id) AS last_event,
    max(value) AS top_value FROM log WHERE coalesce(tags,'')='' OR tags='click' GROUP BY ALL""",
)(flagship)
