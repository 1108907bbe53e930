import datetime
import os

import pytest
from pyspark.sql import functions as F

from queuelog import read_log, read_log_stream, write_log, write_log_stream
from queuelog.operators import event_time
from queuelog.plans import fixtures as fx
from queuelog.sources import datasource, positions, storage

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "id bigint"


def put(spark, path, ids, queue=lambda i: i % 2, at=lambda i: i, broker="b", topic="t"):
    df = spark.createDataFrame([(i, queue(i), T0 + datetime.timedelta(seconds=at(i))) for i in ids], "id bigint, queue_id int, ts timestamp")
    return write_log(df, fx.options(str(path), topic), exclude=("queue_id", "ts"), order=["id"], store_timestamp=F.col("ts"), broker=broker)


def run(stream, folder, mode="append", rows=None):
    """Process what is there; the sizes of the batches that read something."""
    batches = []

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
        batches.append(batch.count())

    query = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [n for n in batches if n]


def ids(spark, folder, stream):
    return sorted(r["id"] for r in spark.read.schema(stream.schema).parquet(f"{folder}/out").collect())


def options(path, mode="earliest-offset", **more):
    return {**fx.options(str(path), "t"), "scan.startup.mode": mode, **more}


def test_stream_equals_batch(spark, tmp_path):
    put(spark, tmp_path / "log", range(100))
    put(spark, tmp_path / "log", range(100, 150))
    for mode, more in (
        ("earliest-offset", {}),
        ("timestamp", {"scan.startup.timestamp-millis": str(1704067200000 + 60_000)}),
        ("specific-offsets", {"scan.startup.specific-offsets": "partition:0,offset:40;partition:1,offset:70"}),
    ):
        o = options(tmp_path / "log", mode, **more)
        stream = read_log_stream(spark, o, SCHEMA)
        folder = tmp_path / mode
        run(stream, folder)
        assert ids(spark, folder, stream) == sorted(r["id"] for r in read_log(spark, o, SCHEMA).collect())


def test_capped_triggers_and_restarts(spark, tmp_path):
    put(spark, tmp_path / "log", range(200))
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=40)
    first = run(stream, tmp_path)
    assert len(first) >= 4 and max(first) <= 60 and sum(first) == 200
    put(spark, tmp_path / "log", range(200, 300))
    again = run(read_log_stream(spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=40), tmp_path)
    assert max(again) <= 60 and sum(again) == 100
    assert ids(spark, tmp_path, stream) == list(range(300))


def test_stop_in_the_middle_of_a_group(spark, tmp_path):
    put(spark, tmp_path / "log", range(100))
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=20)
    for _ in range(8):  # one batch per run: availableNow takes a single one from this source
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
            "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(100))


def test_one_store_time_is_split(spark, tmp_path):
    """200 messages of one time, in two commits; each queue's messages come in order, none late."""
    put(spark, tmp_path / "log", range(160), at=lambda i: 5)
    put(spark, tmp_path / "log", range(160, 200), at=lambda i: 5)
    stream = read_log_stream(
        spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=40, watermark="1 second",
        metadata=["store_timestamp", "queue_id", "queue_offset"],
    )
    counts = stream.groupBy("id", "queue_id", "queue_offset", "store_timestamp").count()  # would drop what is late
    sizes = run(stream, tmp_path / "a")
    assert sizes == [40] * 5
    assert ids(spark, tmp_path / "a", stream) == list(range(200))
    rows = spark.read.parquet(f"{tmp_path}/a/out").collect()
    for queue in (0, 1):
        met = [r["queue_offset"] for r in sorted(rows, key=lambda r: (r["batch"], r["queue_offset"])) if r["queue_id"] == queue]
        assert met == sorted(met)
    put(spark, tmp_path / "log", [1000], at=lambda i: 100)
    put(spark, tmp_path / "log", [1001], at=lambda i: 200)
    run(counts, tmp_path / "b")
    assert set(range(200)) <= {r["id"] for r in spark.read.schema(counts.schema).parquet(f"{tmp_path}/b/out").collect()}


@pytest.mark.parametrize("cap", [4, 7, 1000])
def test_capped_stream_of_messages_without_time(spark, tmp_path, cap):
    """The first commit of a topic: one queue without any time, one with some."""
    rows = [(i, i % 2, T0 + datetime.timedelta(seconds=i) if i % 2 and i % 3 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, queue_id int, ts timestamp")
    for part in (df, df.withColumn("id", F.col("id") + 20)):
        write_log(part, fx.options(str(tmp_path / "log"), "t"), exclude=("queue_id", "ts"), order=["id"], store_timestamp=F.col("ts"))
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=cap)
    sizes = run(stream, tmp_path)
    assert ids(spark, tmp_path, stream) == list(range(40)) and sum(sizes) == 40
    assert cap == 1000 or len(sizes) >= 4


def test_cuts_stored_by_earlier_versions(spark, tmp_path):
    from queuelog.sources import datasource

    assert datasource._as_cut(5) == (5, datasource.LAST, 1, 1) and datasource._as_cut(None) is None
    assert datasource.side_of((5, 3, 1, 2), 3, [{"broker_name": "b", "queue_id": 0, "start": 10, "end": 15}]) == (5, [("b", 0, 13)])
    assert datasource.side_of((5, 3, 1, 2), 2, []) == (5, True) and datasource.side_of((5, 3, 1, 1), 4, []) == (5, False)


def test_capped_triggers_end_at_a_common_time(spark, tmp_path):
    # queue 1 is written two hours behind queue 0
    put(spark, tmp_path / "log", range(200), at=lambda i: 60 * i - (7200 if i % 2 else 0))
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=30, watermark="1 minute")
    counts = stream.groupBy(F.window("store_timestamp", "10 minutes").alias("w")).agg(F.count("*").alias("n"))
    run(counts, tmp_path)
    got = spark.read.schema(counts.schema).parquet(f"{tmp_path}/out").select("w.start", "n").collect()
    batch = read_log(spark, options(tmp_path / "log"), SCHEMA, metadata=["store_timestamp"])
    want = {r["start"]: r["n"] for r in batch.groupBy(F.window("store_timestamp", "10 minutes").alias("w")).agg(
        F.count("*").alias("n")).select("w.start", "n").collect()}
    last = max(want)
    # every closed window is complete: nothing came too late
    assert {r["start"]: r["n"] for r in got} == {s: n for s, n in want.items() if s < last}


def test_capped_triggers_look_at_all_commits(spark, tmp_path, monkeypatch):
    # six commits, later ones with older times; the old bound of a plan would have cut them in two groups
    from queuelog.sources import datasource

    monkeypatch.setattr(datasource, "MAX_GROUP", 3, raising=False)
    for n in range(6):
        put(spark, tmp_path / "log", range(20 * n, 20 * n + 20), at=lambda i, n=n: 600 * (5 - n) + i % 20 * 60)
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA, max_messages_per_trigger=30, watermark="1 minute")
    counts = stream.groupBy(F.window("store_timestamp", "5 minutes").alias("w")).agg(F.count("*").alias("n"))
    run(counts, tmp_path)
    got = spark.read.schema(counts.schema).parquet(f"{tmp_path}/out").select("w.start", "n").collect()
    batch = read_log(spark, options(tmp_path / "log"), SCHEMA, metadata=["store_timestamp"])
    want = {r["start"]: r["n"] for r in batch.groupBy(F.window("store_timestamp", "5 minutes").alias("w")).agg(
        F.count("*").alias("n")).select("w.start", "n").collect()}
    assert {r["start"]: r["n"] for r in got} == {s: n for s, n in want.items() if s < max(want)}


def test_commits_read_in_full_leave_the_plan(spark, tmp_path):
    from queuelog.sources import datasource

    for n in range(4):
        put(spark, tmp_path / "log", range(20 * n, 20 * n + 20))
    reader = datasource._StreamReader({"path": str(tmp_path / "log"), "topic": "t", "maxMessagesPerTrigger": "25"})
    ends = [reader.latestOffset() for _ in range(4)]
    assert [e["group"] for e in ends] == [ends[-1]["seq"]] * 4 and ends[-1]["cut"] is None
    assert [e["seq"] for e in ends] == sorted({e["seq"] for e in ends}) and not reader.marks.keys() - {ends[-1]["seq"]}


def test_latest_is_kept_across_restarts(spark, tmp_path):
    put(spark, tmp_path / "log", range(10))
    o = options(tmp_path / "log", "latest-offset")
    stream = read_log_stream(spark, o, SCHEMA)
    assert run(stream, tmp_path) == []
    put(spark, tmp_path / "log", range(10, 20))
    # the mode would now resolve to 20, but the position is the checkpoint's
    run(read_log_stream(spark, o, SCHEMA), tmp_path)
    assert ids(spark, tmp_path, stream) == list(range(10, 20))


@pytest.mark.parametrize("interval, seen", [("-1", 30), ("1000", 50)])
def test_discovery(spark, tmp_path, interval, seen):
    o = options(tmp_path / "log", **{"scan.topic-partition-discovery.interval-millis": interval})
    put(spark, tmp_path / "log", range(20))
    stream = read_log_stream(spark, o, SCHEMA)
    run(stream, tmp_path)
    put(spark, tmp_path / "log", range(20, 40), queue=lambda i: i % 2 * 2)  # queue 2 is new
    put(spark, tmp_path / "log", range(40, 50), broker="c")  # and so is a broker
    run(read_log_stream(spark, o, SCHEMA), tmp_path)
    assert len(ids(spark, tmp_path, stream)) == seen


def test_uncommitted_batches_are_not_streamed(spark, tmp_path):
    put(spark, tmp_path / "log", range(10))
    name = put(spark, tmp_path / "log", range(10, 20))
    marker = tmp_path / "log" / "_commits" / "topic=t" / name
    marker.unlink()
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA)
    run(stream, tmp_path)
    assert ids(spark, tmp_path, stream) == list(range(10))
    marker.touch()
    run(stream, tmp_path)
    assert ids(spark, tmp_path, stream) == list(range(20))


def test_file_engine(spark, tmp_path):
    put(spark, tmp_path / "log", range(50))
    o = options(tmp_path / "log", "specific-offsets", **{"scan.startup.specific-offsets": "partition:0,offset:5;partition:1,offset:20"})
    stream = read_log_stream(spark, o, SCHEMA, engine="files")
    run(stream, tmp_path)
    assert len(ids(spark, tmp_path, stream)) == 25
    for mode in ("latest-offset", "group-offsets"):
        with pytest.raises(ValueError, match="engine 'files'"):
            read_log_stream(spark, options(tmp_path / "log", mode), SCHEMA, engine="files")


def test_batch_format(spark, tmp_path):
    put(spark, tmp_path / "log", range(50))
    from queuelog import register

    register(spark)
    got = spark.read.format("queuelog").options(path=str(tmp_path / "log"), topic="t").load()
    want = storage.messages(spark, str(tmp_path / "log"), "t")
    columns = [c for c in want.columns if c != "headers"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def copy(spark, tmp_path, guarantee, checkpoint="checkpoint", **kw):
    o = {**fx.options(str(tmp_path / "copy"), "t"), "sink.delivery-guarantee": guarantee, "sink.transactional-id-prefix": "p"}
    source = options(tmp_path / "log", "group-offsets")
    stream = read_log_stream(spark, {**source, "scan.startup.mode": "earliest-offset"}, SCHEMA,
                             metadata=["store_timestamp", "topic", "broker_name", "queue_id", "queue_offset"])
    query = write_log_stream(
        stream, o, checkpoint=f"{tmp_path}/{checkpoint}", commit_group=(str(tmp_path / "log"), "t", "g1"),
        exclude=("store_timestamp",), store_timestamp=F.col("store_timestamp"), order=["id"], queues=3,
        partitioner=lambda row, *a: F.pmod(row["id"], F.lit(3)), **kw,
    ).start()
    query.processAllAvailable()
    query.stop()


def copied(spark, tmp_path):
    got = read_log(spark, fx.options(str(tmp_path / "copy"), "t"), SCHEMA, metadata=["queue_id", "queue_offset"])
    return sorted((r["queue_id"], r["queue_offset"], r["id"]) for r in got.collect())


@pytest.mark.parametrize("guarantee", ["at-least-once", "exactly-once"])
def test_delivery_and_replay(spark, tmp_path, guarantee):
    put(spark, tmp_path / "log", range(30))
    copy(spark, tmp_path, guarantee)
    put(spark, tmp_path / "log", range(30, 60))
    copy(spark, tmp_path, guarantee)
    want = [(i % 3, i // 3, i) for i in range(60)]
    assert copied(spark, tmp_path) == sorted(want)
    # lose the record of the last batch: Spark runs it again
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    copy(spark, tmp_path, guarantee)
    if guarantee == "exactly-once":
        assert copied(spark, tmp_path) == sorted(want)
    else:
        assert sorted(i for *_, i in copied(spark, tmp_path)) == sorted([*range(60), *range(30, 60)])
    group = positions.committed_offsets(spark, str(tmp_path / "log"), "g1", "t")
    assert {r["queue_id"]: r["offset"] for r in group.collect()} == {0: 30, 1: 30}
    assert read_log(spark, options(tmp_path / "log", "group-offsets"), SCHEMA).count() == 0


def test_exactly_once_with_a_new_checkpoint(spark, tmp_path):
    put(spark, tmp_path / "log", range(10))
    copy(spark, tmp_path, "exactly-once")
    put(spark, tmp_path / "log", range(10, 20))
    copy(spark, tmp_path, "exactly-once", checkpoint="other")  # reads all from the start
    assert sorted(i for *_, i in copied(spark, tmp_path)) == sorted([*range(10), *range(20)])
    copy(spark, tmp_path, "exactly-once", checkpoint="other")
    assert len(copied(spark, tmp_path)) == 30


def test_guarantees_need_a_checkpoint(spark, tmp_path):
    put(spark, tmp_path / "log", range(3))
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA)
    with pytest.raises(ValueError, match="checkpoint"):
        write_log_stream(stream, fx.options(str(tmp_path / "copy"), "t"))


def test_per_queue_watermarks(spark, tmp_path):
    # queue 1 lags by two days; each queue comes in its own trigger
    put(spark, tmp_path / "log", range(0, 100, 2), at=lambda i: i * 60)
    put(spark, tmp_path / "log", range(1, 100, 2), at=lambda i: i * 60 - 172_800)
    stream = read_log_stream(
        spark, options(tmp_path / "log"), SCHEMA, engine="files", max_files_per_trigger=1,
        metadata=["store_timestamp", "broker_name", "queue_id"])
    slow = event_time.per_queue_watermarks(stream, [("b", 0), ("b", 1)], "5 minutes")
    counts = slow.groupBy(F.window("store_timestamp", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    out = tmp_path / "out"
    query = counts.writeStream.format("parquet").option("path", str(out)).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).start()
    query.processAllAvailable()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    marks = [p["eventTime"].get("watermark") for p in query.recentProgress]
    query.stop()
    assert dropped == 0
    # the watermark is that of queue 1, two days back
    assert max(m for m in marks if m) < "2023-12-31"
    with pytest.raises(Exception, match="queue not listed: b-1"):
        missing = event_time.per_queue_watermarks(
            storage.messages(spark, str(tmp_path / "log"), "t"), [("b", 0)], "5 minutes")
        missing.collect()


def test_queue_watermarks(spark, tmp_path):
    put(spark, tmp_path / "log", range(10), at=lambda i: i * 100)
    messages = storage.messages(spark, str(tmp_path / "log"), "t")
    got = {r["queue_id"]: r["watermark"] for r in event_time.queue_watermarks(messages, "1 minute").collect()}
    assert got == {0: T0 + datetime.timedelta(seconds=740), 1: T0 + datetime.timedelta(seconds=840)}
    assert event_time.combined_watermark(messages, "1 minute").first()[0] == got[0]


def _parts(path, **more):
    """Parts of a topic's first trigger, and its reader."""
    given = {"path": str(path), "topic": "t", **more}
    reader = datasource._StreamReader(datasource.declared(given))
    start = reader.initialOffset()
    return reader, reader.partitions(start, reader.latestOffset())


def test_large_file_is_read_in_runs_of_row_groups(spark, tmp_path):
    small = {"parquet.block.size": "2048", "parquet.page.size.row.check.min": "100", "parquet.page.size.row.check.max": "100"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(4000).withColumn("queue_id", F.expr("cast(id % 2 as int)")).withColumn("ts", F.timestamp_seconds("id"))
        write_log(
            df, fx.options(str(tmp_path / "log"), "t", **{"sink.parallelism": "1"}), exclude=("queue_id", "ts"),
            order=["id"], store_timestamp=F.col("ts"),
        )
    finally:
        for name in small:
            spark.conf.unset(name)
    reader, parts = _parts(tmp_path / "log", maxPartitionBytes="1")
    assert len({part.path for part in parts}) == 1 and len(parts) >= 10
    assert [part.groups for part in parts] == [[i] for i in range(len(parts))]
    read = [offset for part in parts for batch in reader.read(part) for offset in batch.column("queue_offset").to_pylist()]
    assert sorted(read) == sorted([*range(2000)] * 2)
    # fewer and longer runs, one for a small file
    size = os.path.getsize(parts[0].path)
    _, runs = _parts(tmp_path / "log", maxPartitionBytes=str(size // 3))
    assert 3 <= len(runs) < len(parts) and [i for run in runs for i in run.groups] == list(range(len(parts)))
    _, whole = _parts(tmp_path / "log")
    assert [part.groups for part in whole] == [None]
    # a start time far back leaves most row groups out by their statistics
    starts = '[["broker-0", 0, 1900], ["broker-0", 1, 1950]]'
    reader, late = _parts(tmp_path / "log", maxPartitionBytes="1", starts=starts)
    assert len(late) < len(parts) / 2
    assert sum(batch.num_rows for part in late for batch in reader.read(part)) == 150
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1kb")
    try:
        stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA)
        run(stream, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids(spark, tmp_path, stream) == list(range(4000))


def test_only_needed_columns_go_through_the_source(spark, tmp_path):
    put(spark, tmp_path / "log", range(10))

    def source(stream):
        plan = stream._jdf.queryExecution().analyzed().collectLeaves().head()
        return [plan.output().apply(i).name() for i in range(plan.output().size())]

    assert source(read_log_stream(spark, options(tmp_path / "log"), SCHEMA)) == ["store_timestamp", "body"]
    tagged = read_log_stream(spark, options(tmp_path / "log", tag="x"), SCHEMA, metadata=["queue_id", "topic"])
    assert source(tagged) == ["topic", "queue_id", "tags", "body"]
    stream = read_log_stream(spark, options(tmp_path / "log"), SCHEMA, metadata={"where": F.concat("topic", F.lit("-"), "queue_id")})
    assert len(source(stream)) == 9
    run(stream, tmp_path)
    rows = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect()
    assert sorted((r["id"], r["where"]) for r in rows) == [(i, f"t-{i % 2}") for i in range(10)]
    datasource.register(spark)
    reader = spark.read.format("queuelog").options(path=str(tmp_path / "log"), topic="t")
    assert sorted(tuple(r) for r in reader.schema("queue_id int, topic string").load().collect()) == [(0, "t")] * 5 + [(1, "t")] * 5
    with pytest.raises(Exception, match="no column 'queue_id' of type bigint"):
        reader.schema("queue_id bigint").load().collect()
