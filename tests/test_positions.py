import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelog import read_log, read_messages, tag_filter, write_log
from queuelog.model import LOG_SCHEMA, OFFSETS_SCHEMA
from queuelog.operators import placement
from queuelog.plans import fixtures as fx
from queuelog.sources import positions, storage


def by_queue(offsets):
    return {(r["broker_name"], r["queue_id"]): r["offset"] for r in offsets.collect()}


@pytest.fixture(scope="module")
def log(spark):
    return fx.events_log(spark, "/root/testdata/sf0.001")


def starts(spark, log, mode, **kw):
    return positions.starting_offsets(spark, log, "events", mode, **kw)


def test_offsets_are_dense(spark, log):
    rows = storage.messages(spark, log, "events").groupBy("broker_name", "queue_id").agg(
        F.count("*").alias("n"), F.count_distinct("queue_offset").alias("d"), F.max("queue_offset").alias("m"))
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in rows.collect())


def test_ranges_agree_with_a_scan(spark, log):
    scanned = positions.queue_bounds(storage.messages(spark, log, "events"))
    known = positions.topic_bounds(spark, log, "events").select(scanned.columns)
    assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, known.collect()))


def test_group_offsets_fall_back_to_latest(spark, log):
    end = by_queue(starts(spark, log, "latest-offset"))
    got = by_queue(starts(spark, log, "group-offsets", group="nobody"))
    assert got == end
    given = spark.createDataFrame([("events", "broker-0", 0, 5), ("events", "broker-0", 1, -1), ("events", "broker-1", 0, 0)], OFFSETS_SCHEMA)
    got = by_queue(starts(spark, log, "group-offsets", committed=given))
    assert got["broker-0", 0] == 5 and got["broker-1", 0] == 0
    assert all(got[q] == end[q] for q in end if q not in (("broker-0", 0), ("broker-1", 0)))


def test_specific_offsets(spark, log):
    got = by_queue(starts(spark, log, "specific-offsets", specific=fx.SPECIFIC_DICT))
    assert len(got) == 8 and all(o == fx.SPECIFIC_DICT[q] for (_, q), o in got.items())
    for bad in ({0: 42}, {0: 1, 1: 1, 2: -1, 3: 1}, {}):
        with pytest.raises(PySparkException, match="queue events-broker-.-. needs an offset"):
            starts(spark, log, "specific-offsets", specific=bad).collect()


def test_timestamp_miss(spark, log):
    late = 4102444800000
    assert set(by_queue(starts(spark, log, "timestamp", timestamp_millis=late)).values()) == {0}
    got = by_queue(starts(spark, log, "timestamp", timestamp_millis=late, on_timestamp_miss="latest"))
    assert got == by_queue(starts(spark, log, "latest-offset"))
    assert set(by_queue(starts(spark, log, "timestamp", timestamp_millis=-1)).values()) == {0}


def test_committed_offsets_keep_the_last(spark, log):
    for offset in (7, 3):
        positions.commit_offsets(spark, log, "g-test", "events", spark.createDataFrame([("events", "broker-0", 1, offset)], OFFSETS_SCHEMA))
    assert by_queue(positions.committed_offsets(spark, log, "g-test", "events")) == {("broker-0", 1): 3}
    options = {**fx.options(log), "properties.group.id": "g-test", "scan.startup.mode": "group-offsets"}
    read = read_messages(spark, options)
    assert {(r["broker_name"], r["queue_id"]) for r in read.select("broker_name", "queue_id").distinct().collect()} == {("broker-0", 1)}
    assert read.agg(F.min("queue_offset")).first()[0] == 3


def test_restrict_gives_the_same_on_every_route(spark, log, monkeypatch):
    messages = storage.messages(spark, log, "events")
    begin = positions.specific_offsets(positions.queue_bounds(messages), {0: 3, 1: 10, 2: 0, 3: 1})
    ends = positions.capped_ends(begin, positions.queue_bounds(messages), 20)
    results = []
    for literal, driver in ((64, 10_000), (0, 10_000), (0, 1)):
        monkeypatch.setattr(positions, "MAX_LITERAL_QUEUES", literal)
        monkeypatch.setattr(positions, "MAX_DRIVER_QUEUES", driver)
        out = positions.restrict(messages, begin, ends)
        results.append(sorted(map(tuple, out.select("broker_name", "queue_id", "queue_offset").collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 160


def test_positions_reach_the_scan(spark, log):
    options = {**fx.options(log, scan__startup__specific_offsets=fx.SPECIFIC), "scan.startup.mode": "specific-offsets"}
    rows = read_log(spark, options, fx.EVENT_SCHEMA, columns=["event_id"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(queue_offset" in plan.split("PushedFilters")[1] and "Exchange" not in plan
    schema = plan.split("ReadSchema: ")[1]
    assert "headers" not in schema and "msg_timestamp" not in schema


def test_tag_filter_is_pushed_down(spark, log):
    plan = tag_filter(storage.messages(spark, log, "events"), "click")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(tags,click)" in plan.split("PushedFilters")[1]


def test_batches_before_the_start_are_not_opened(spark, tmp_path):
    path = str(tmp_path)
    events = fx.placed_events(spark, "/root/testdata/sf0.001")
    for part in range(5):
        rows = events.where(F.col("event_id").between(part * 200, part * 200 + 199))
        if part == 3:  # this one leaves most queues as they are
            rows = rows.where("queue_id = 0")
        write_log(rows, fx.options(path), exclude=("broker_name", "queue_id"), broker=F.col("broker_name"),
                  store_timestamp=F.col("ts"), order=["event_id"], stage=False)
    batches = storage.committed_batches(spark, path, "events")
    bounds = {(r["broker_name"], r["queue_id"]): r["end"] for r in positions.topic_bounds(spark, path, "events").collect()}
    scanned = {(r["broker_name"], r["queue_id"]): r["end"] for r in positions.queue_bounds(storage.messages(spark, path, "events")).collect()}
    assert bounds == scanned and len(bounds) == 8
    latest = starts(spark, path, "latest-offset")
    assert positions.needed_from(spark, path, "events", latest.collect()) > batches[-1]
    one_back = latest.withColumn("offset", F.col("offset") - 1)
    assert positions.needed_from(spark, path, "events", one_back.collect()) == batches[4]
    assert positions.needed_from(spark, path, "events", latest.withColumn("offset", F.lit(0)).collect()) == batches[0]
    third = events.where("event_id = 400").select(F.unix_millis(F.col("ts").cast("timestamp"))).first()[0]
    options = {**fx.options(path), "scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": str(third)}
    read = read_log(spark, options, fx.EVENT_SCHEMA)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert f"batch#" in plan and f">= {batches[2]}" in plan
    want = events.where("event_id >= 400 and (event_id not between 600 and 799 or queue_id = 0)")
    assert sorted(r["event_id"] for r in read.collect()) == sorted(r["event_id"] for r in want.collect())


def test_plain_parquet_folder(spark, log, tmp_path):
    path = str(tmp_path / "plain")
    storage.messages(spark, log, "events").write.partitionBy("topic").parquet(path)
    assert by_queue(positions.starting_offsets(spark, path, "events", "latest-offset")) == by_queue(starts(spark, log, "latest-offset"))
    assert read_log(spark, fx.options(path), fx.EVENT_SCHEMA).count() == 1000


def test_new_queues(spark):
    def queues(*ids):
        return spark.createDataFrame([("t", "b", i, 0) for i in ids], OFFSETS_SCHEMA)

    got = positions.new_queues(queues(1, 2, 3), queues(2, 9))
    assert sorted(r["queue_id"] for r in got.collect()) == [1, 3]


def jvm_hash(s):
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h


def test_owner(spark):
    names = [("t", "b-0", 0), ("topic-é", "broker", 5), ("𝔘nicode", "b", 2), ("", "", 1), ("long" * 30, "x" * 50, 7)]
    df = spark.createDataFrame(names, "topic string, broker_name string, queue_id int")
    for n in (1, 3, 8):
        want = [((jvm_hash(f"{t}-{b}") * 31 & 0x7FFFFFFF) % n + q) % n for t, b, q in names]
        assert [r["owner"] for r in placement.with_owner(df, n).collect()] == want


def test_hot_queue_is_spread_over_lanes(spark):
    df = spark.range(10_000).select(
        F.lit("t").alias("topic"), F.lit("b").alias("broker_name"), F.lit(0).alias("queue_id"), F.col("id").alias("queue_offset"))
    bounds = positions.queue_bounds(df)
    lanes = placement.lanes_for(bounds, 3, 1000)
    assert lanes == 10
    placed = placement.queue_affine_repartition(df, 3, lanes=lanes, rows_per_lane=100)
    sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert placed.rdd.getNumPartitions() == 30 and len(sizes) == 10 and set(sizes) == {1000}
    assert placed.select("owner").distinct().count() == 1


def test_schema_of_a_scan(spark, log):
    got = storage.messages(spark, log, "events").schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in LOG_SCHEMA]
    rows = read_log(spark, fx.options(log), fx.EVENT_SCHEMA, metadata=["topic", "queue_offset"])
    assert rows.columns[-2:] == ["topic", "queue_offset"]
    assert isinstance(rows.schema["topic"].dataType, T.StringType) and not rows.schema["topic"].nullable
    with pytest.raises(ValueError, match="unknown metadata column 'nope'"):
        read_log(spark, fx.options(log), fx.EVENT_SCHEMA, metadata=["nope"])


def test_parse_specific_offsets_column(spark):
    def parse(text):
        df = spark.createDataFrame([(text,)], "s string")
        return [tuple(p) for p in df.select(positions.parse_specific_offsets(F.col("s"))).first()[0]]

    assert parse("partition:0,offset:42;partition:1,offset:300;") == [(0, 42), (1, 300)]
    assert parse("partition:0,offset:42;partition:1,offset:3;partition:0,offset:-1") == [(1, 3), (0, -1)]
    assert parse("partition:0,offset:42") == [(0, 42)]
    for bad in ("", "partition:0", "offset:1,partition:0"):
        with pytest.raises(PySparkException, match="invalid specific offsets"):
            parse(bad)


def test_restrict_takes_collected_starts(spark, log, monkeypatch):
    messages = storage.messages(spark, log, "events")
    known = positions.collect_offsets(positions.specific_offsets(positions.queue_bounds(messages), {0: 3, 1: 10, 2: 0, 3: 1}))
    counts = []
    for literal, driver in ((64, 10_000), (0, 10_000), (0, 1)):
        monkeypatch.setattr(positions, "MAX_LITERAL_QUEUES", literal)
        monkeypatch.setattr(positions, "MAX_DRIVER_QUEUES", driver)
        counts.append(positions.restrict(messages, known).count())
    assert counts == [1000 - 2 * (3 + 10 + 0 + 1)] * 3
