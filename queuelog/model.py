"""Schemas and names shared by every part of the package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A queue is identified by these three columns.
QUEUE_KEY = ["topic", "broker_name", "queue_id"]

#: One row per message of a topic.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("broker_name", T.StringType()),
        T.StructField("queue_id", T.IntegerType()),
        T.StructField("queue_offset", T.LongType()),
        T.StructField("store_timestamp", T.TimestampType()),
        T.StructField("tags", T.StringType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("headers", T.MapType(T.StringType(), T.BinaryType())),
        T.StructField("msg_timestamp", T.TimestampType()),
    ]
)

#: One row per queue; ``offset`` is the next message to read (or the exclusive end).
OFFSETS_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("broker_name", T.StringType()),
        T.StructField("queue_id", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

#: Written next to the data when a batch commits: one row per queue the topic has by then.
#: ``start``/``end`` are the batch's own range (equal where it holds nothing of the queue);
#: ``end`` and ``seen_ts`` (latest store time so far) only grow from batch to batch.
RANGES_SCHEMA = T.StructType(
    [
        T.StructField("broker_name", T.StringType()),
        T.StructField("queue_id", T.IntegerType()),
        T.StructField("earliest", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("seen_ts", T.TimestampType()),
        T.StructField("ts_quantiles", T.ArrayType(T.LongType())),
    ]
)

#: Row kinds of a changelog.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def as_schema(schema: T.StructType | str) -> T.StructType:
    """Accept a StructType or a DDL string."""
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def same_key_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join on columns of one name in which null equals null. The keys come once."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(other, on, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_right_{k}") for k in keys})
    return joined.drop(*(f"_right_{k}" for k in keys))


def work_dir(spark: SparkSession) -> str:
    """Folder for tables that cut lineage; the one the cluster names, when it names one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="queuelog-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
