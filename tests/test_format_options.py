import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from queuelog import read_log, write_log
from queuelog.plans import fixtures as fx
from queuelog.sources import datasource, positions

T0 = datetime.datetime(2024, 1, 1)


@pytest.fixture
def log(spark, tmp_path):
    """Two batches; times fall back inside a queue, and a third of the messages have no tag."""
    for ids in (range(0, 40), range(40, 70)):
        rows = [(i, i % 3 if i >= 40 else i % 2, T0 + datetime.timedelta(seconds=i - i % 5 * 3), [None, "a", "b"][i % 3]) for i in ids]
        df = spark.createDataFrame(rows, "id bigint, queue_id int, ts timestamp, tag string")
        write_log(df, fx.options(str(tmp_path / "log"), "t"), exclude=("queue_id", "ts", "tag"), order=["id"],
                  store_timestamp=F.col("ts"), tag=F.col("tag"), broker="b")
    datasource.register(spark)
    offsets = spark.createDataFrame([("t", "b", 0, 7), ("t", "b", 1, -1)], "topic string, broker_name string, queue_id int, offset bigint")
    positions.commit_offsets(spark, str(tmp_path / "log"), "g", "t", offsets)
    return str(tmp_path / "log")


MODES = {
    "earliest-offset": {},
    "latest-offset": {},
    "group-offsets": {},
    "specific-offsets": {"scan.startup.specific-offsets": "partition:0,offset:3;partition:1,offset:25;partition:2,offset:0"},
    "timestamp": {"scan.startup.timestamp-millis": str(1704067200000 + 31_000)},
}


def declaration(log, mode, **more):
    return {"properties.nameserver.address": log, "properties.topic": "t", "properties.group.id": "g",
            "format": "json", "scan.startup.mode": mode, **MODES[mode], **more}


def keys(df):
    return sorted((r["queue_id"], r["queue_offset"]) for r in df.select("queue_id", "queue_offset").collect())


@pytest.mark.parametrize("tag", [None, "a"])
@pytest.mark.parametrize("mode", MODES)
def test_batch_equals_read_log(spark, log, mode, tag):
    options = declaration(log, mode, **({"tag": tag} if tag else {}))
    want = keys(read_log(spark, options, "id bigint", metadata=["queue_id", "queue_offset"]))
    assert keys(spark.read.format("queuelog").options(**options).load()) == want
    assert want or mode == "latest-offset"


@pytest.mark.parametrize("mode", ["group-offsets", "timestamp", "specific-offsets"])
def test_stream_equals_batch(spark, log, tmp_path, mode):
    options = declaration(log, mode, tag="b")
    stream = spark.readStream.format("queuelog").options(**options).option("maxMessagesPerTrigger", "10").load()
    query = (stream.select("queue_id", "queue_offset").writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert keys(spark.read.parquet(str(tmp_path / "out"))) == keys(spark.read.format("queuelog").options(**options).load())


@pytest.mark.parametrize("time, none", [("2024-01-01 00:00:00", False), ("2030-01-01 00:00:00", True)])
def test_times_outside(spark, log, time, none):
    """Before all messages, and after all, where reading starts at the first."""
    millis = int(datetime.datetime.fromisoformat(time + "+00:00").timestamp() * 1000)
    options = declaration(log, "timestamp", **{"scan.startup.timestamp-millis": str(millis)})
    assert spark.read.format("queuelog").options(**options).load().count() == (70 if none else len(
        keys(read_log(spark, options, "id bigint", metadata=["queue_id", "queue_offset"]))))


@pytest.mark.parametrize("wrong", [{"scan.start": "x"}, {"scan.startup.mode": "middle"}, {"format": "xml"}, {"tagg": "a"},
                                   {"scan.startup.specific-offsets": "partition:0,offset:3"}])
def test_wrong_options_are_refused(spark, log, wrong):
    with pytest.raises(PySparkException):
        spark.read.format("queuelog").options(**{**declaration(log, "specific-offsets"), **wrong}).load().count()


def test_short_names_are_checked(spark, log):
    assert spark.read.format("queuelog").options(path=log, topic="t").load().count() == 70
    with pytest.raises(PySparkException, match="unknown option"):
        spark.read.format("queuelog").options(path=log, topic="t", start="x").load().count()
