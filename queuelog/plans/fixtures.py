"""Logs and changelogs derived from the given tables; inputs of queries, tests and benchmarks."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog.model import scratch_path
from queuelog.sources import positions, storage
from queuelog.streaming import sink

EVENT_SCHEMA = (
    "event_id bigint, user_id bigint, event_type string, value double, props string, ts timestamp_ntz"
)
ORDER_SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderstatus string"

_built: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, label: str, sf_dir: str, build) -> str:
    """Path of a derived log, built when first asked for in this application."""
    key = (spark.sparkContext.applicationId, label, sf_dir)
    if key not in _built:
        path = scratch_path(spark, label)
        build(path)
        _built[key] = path
    return _built[key]


def options(path: str, topic: str = "events", fmt: str = "json", **more) -> dict:
    return {
        "connector": "queuelog",
        "properties.nameserver.address": path,
        "properties.topic": topic,
        "properties.group.id": "g1",
        "format": fmt,
        "scan.startup.mode": "earliest-offset",
        **{k.replace("__", ".").replace("_", "-"): v for k, v in more.items()},
    }


def placed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the queue they belong to."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").withColumns(
        {
            "broker_name": F.concat(F.lit("broker-"), (user % 2).cast("string")),
            "queue_id": (F.shiftright(user, 1) % 4).cast("int"),
        }
    )


def write_events(spark: SparkSession, sf_dir: str, path: str, **more) -> str:
    """The canonical log: 8 queues on 2 brokers, offsets by ``event_id``, tag = event type."""
    events = placed_events(spark, sf_dir).withColumns(
        {
            "headers": F.create_map(
                F.lit("type"), F.col("event_type").cast("binary"), F.lit("props"), F.col("props").cast("binary")
            ),
            "timestamp": F.col("ts").cast("timestamp"),
        }
    )
    return sink.write_log(
        events, options(path), metadata=("headers", "timestamp"), exclude=("broker_name", "queue_id"),
        broker=F.col("broker_name"), tag=F.col("event_type"), store_timestamp=F.col("ts"),
        order=["event_id"], stage=False, **more,
    )


def events_log(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, "events", sf_dir, lambda path: write_events(spark, sf_dir, path))


def events_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.messages(spark, events_log(spark, sf_dir), "events")


def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group offsets: known on broker-0, negative or missing on broker-1."""
    bounds = positions.topic_bounds(spark, events_log(spark, sf_dir), "events")
    first = F.col("broker_name") == "broker-0"
    return bounds.where(first | (F.col("queue_id") % 2 == 0)).select(
        "topic", "broker_name", "queue_id",
        F.when(first, F.col("queue_id") * 100).otherwise(-1).cast("bigint").alias("offset"),
    )


SPECIFIC = "partition:0,offset:42;partition:1,offset:300;partition:2,offset:0;partition:3,offset:7"
SPECIFIC_DICT = {0: 42, 1: 300, 2: 0, 3: 7}


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes: each inserted, every third updated, every tenth deleted."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")

    def row(price: Column) -> Column:
        return F.struct("o_orderkey", price.alias("o_totalprice"), "o_orderstatus")

    before = row(F.col("o_totalprice"))
    after = row(F.col("o_totalprice") + 1)
    none = F.lit(None).cast(orders.select(before.alias("r")).schema["r"].dataType)
    last = F.when(key % 3 == 0, after).otherwise(before)

    def change(op: str, b: Column, a: Column, seq: int, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(op).alias("op"), b.alias("before"), a.alias("after"), F.lit(seq).alias("seq")))

    changes = F.array_compact(
        F.array(
            change("c", none, before, 0, F.lit(True)),
            change("u", before, after, 1, key % 3 == 0),
            change("d", last, none, 2, key % 10 == 0),
        )
    )
    return orders.select(F.explode(changes).alias("c")).select(
        "c.*", F.coalesce("c.before.o_orderkey", "c.after.o_orderkey").alias("key")
    )


def change_messages(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """The changes as message bodies of a change-data format."""
    changes = order_changes(spark, sf_dir)
    op, before, after = F.col("op"), F.col("before"), F.col("after")
    now = F.coalesce(after, before)
    # formats that send only what changed
    old = F.when(op == "u", F.struct(F.col("before.o_totalprice").alias("o_totalprice")))

    def named(insert: str, update: str, delete: str) -> Column:
        return F.when(op == "c", insert).when(op == "u", update).otherwise(delete)

    envelope = {
        "debezium-json": F.struct(before, after, op),
        "ogg-json": F.struct(before, after, named("I", "U", "D").alias("op_type")),
        "maxwell-json": F.struct(now.alias("data"), old.alias("old"), named("insert", "update", "delete").alias("type")),
        "canal-json": F.struct(
            F.array(now).alias("data"), F.when(old.isNotNull(), F.array(old)).alias("old"),
            named("INSERT", "UPDATE", "DELETE").alias("type"),
        ),
    }[fmt]
    return changes.select(F.to_json(envelope).cast("binary").alias("body"), "seq", "key")


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes as rows with a kind."""
    from queuelog.functions import cdc

    changes = order_changes(spark, sf_dir)
    schema = changes.schema["after"].dataType
    rows = cdc.expand_before_after(F.struct("before", "after", "op"), schema)
    kinds = changes.select("seq", F.posexplode(rows).alias("at", "r"))
    return kinds.select(F.col("r.kind").alias("row_kind"), "seq", "at", "r.value.*")


def big_endian(c: Column, size: int) -> Column:
    """The low ``size`` bytes of an integer."""
    return F.unhex(F.right(F.lpad(F.hex(c.cast("bigint")), 16, "0"), F.lit(2 * size)))


def _cells(values: pd.Series, dtype: str) -> pd.Series:
    raw, size = values.to_numpy().astype(dtype).tobytes(), int(dtype[-1])
    return pd.Series([raw[i : i + size] for i in range(0, len(raw), size)])


@F.pandas_udf(T.BinaryType())
def float_bytes(values: pd.Series) -> pd.Series:
    return _cells(values, ">f4")


@F.pandas_udf(T.BinaryType())
def double_bytes(values: pd.Series) -> pd.Series:
    return _cells(values, ">f8")


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


# workers may not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
