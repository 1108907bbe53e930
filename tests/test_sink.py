import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from queuelog import read_log, write_log
from queuelog.operators import changelog, compaction, partitioners
from queuelog.operators.indexing import dense_index
from queuelog.plans import fixtures as fx
from queuelog.sources import storage
from queuelog.streaming import sink

T0 = datetime.datetime(2024, 1, 1)


def options(path, topic="t", **more):
    return {**fx.options(str(path), topic), **more}


def rows(spark, n, queue=lambda i: i % 3):
    return spark.createDataFrame([(i, f"k{i % 5}", queue(i)) for i in range(n)], "id bigint, key string, queue_id int")


def offsets(spark, path, topic="t"):
    got = read_log(spark, options(path, topic), "id bigint, key string", metadata=["queue_id", "queue_offset"])
    return sorted((r["queue_id"], r["queue_offset"], r["id"]) for r in got.collect())


def dense(spark, df, group, order, **kw):
    return {tuple(r[g] for g in group) + (r[order[-1]],): r["row_index"] for r in dense_index(df, group, order, **kw).collect()}


@pytest.mark.parametrize("per_bucket", [10, 97, 1000, 10**9])
def test_dense_index_is_row_number(spark, per_bucket):
    # group 0 holds a third of all rows, and many rows share the first order column
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("g"),
        (F.col("id") % 7).cast("string").alias("a"), F.col("id").alias("b"))
    got = dense(spark, df, ["g"], ["a", "b"], rows_per_bucket=per_bucket)
    groups = {}
    for r in sorted(df.collect(), key=lambda r: (r["g"], r["a"], r["b"])):
        groups.setdefault(r["g"], []).append(r["b"])
    assert got == {(g, b): i for g, ids in groups.items() for i, b in enumerate(ids)}


def test_dense_index_cuts_a_hot_group(spark):
    df = spark.range(10_000).select(F.lit(1).alias("g"), F.col("id").alias("b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = dense_index(df, ["g"], ["b"], rows_per_bucket=500)
        tasks = plan.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # one group, in all four tasks
    assert sum(r["n"] for r in tasks) == 10_000 and len(tasks) == 4 and max(r["n"] for r in tasks) < 5000


def test_dense_index_by_time_and_date(spark):
    df = spark.range(500).select(
        F.lit("x").alias("g"), F.timestamp_seconds(F.col("id") * 1800).alias("t"), F.col("id").alias("b"))
    got = dense(spark, df, ["g"], ["t", "b"], rows_per_bucket=20)
    assert got == {("x", i): i for i in range(500)}


def test_append_goes_on_from_the_end(spark, tmp_path):
    o = options(tmp_path)
    for part in range(3):
        df = rows(spark, 30).where(f"id >= {part * 10} and id < {part * 10 + 10}")
        write_log(df, o, exclude=("queue_id",), order=["id"])
    got = offsets(spark, tmp_path)
    assert len(got) == 30
    for queue in range(3):
        mine = [(o_, i) for q, o_, i in got if q == queue]
        assert [o_ for o_, _ in mine] == list(range(10)) and [i for _, i in mine] == sorted(i for _, i in mine)


def test_unfinished_batches_are_not_read(spark, tmp_path):
    o = options(tmp_path)
    write_log(rows(spark, 10), o, exclude=("queue_id",), order=["id"])
    lost = write_log(rows(spark, 10), o, exclude=("queue_id",), order=["id"])
    marker = tmp_path / "_commits" / "topic=t" / lost
    marker.unlink()
    assert len(offsets(spark, tmp_path)) == 10
    # the next batch starts where the committed ones end
    write_log(rows(spark, 10), o, exclude=("queue_id",), order=["id"])
    got = offsets(spark, tmp_path)
    assert len(got) == 20 and sorted(o_ for q, o_, _ in got if q == 0) == list(range(8))


def test_repeated_transaction_changes_nothing(spark, tmp_path):
    o = options(tmp_path, **{"sink.delivery-guarantee": "exactly-once", "sink.transactional-id-prefix": "p/1"})
    df = rows(spark, 10)
    first = write_log(df, o, txn="7", exclude=("queue_id",), order=["id"])
    before = offsets(spark, tmp_path)
    assert write_log(df, o, txn="7", exclude=("queue_id",), order=["id"]) is None
    # a writer that died before its commit: the same folder is written again, with the same offsets
    (tmp_path / "_commits" / "topic=t" / first).unlink()
    assert write_log(df, o, txn="7", exclude=("queue_id",), order=["id"]) == first
    assert offsets(spark, tmp_path) == before
    with pytest.raises(ValueError, match="txn"):
        write_log(df, o, exclude=("queue_id",), order=["id"])


def test_message_fields(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, {"a": bytearray(b"x"), "b": None}, datetime.datetime(2024, 1, 1, 0, 0, 0, 123999)), (2, None, None)],
        "id int, headers map<string,binary>, timestamp timestamp")
    write_log(df, options(tmp_path, tag="new"), metadata=("headers", "timestamp"), order=["id"], queues=1)
    got = storage.messages(spark, str(tmp_path), "t").orderBy("queue_offset").collect()
    assert [bytes(r["body"]) for r in got] == [b'{"id":1}', b'{"id":2}']
    assert [r["headers"] for r in got] == [{"a": b"x"}, None]
    assert [r["msg_timestamp"] for r in got] == [datetime.datetime(2024, 1, 1, 0, 0, 0, 123000), None]
    assert {r["tags"] for r in got} == {"new"} and {r["topic"] for r in got} == {"t"}
    assert all(r["store_timestamp"] for r in got)
    with pytest.raises(ValueError, match="cannot be written"):
        write_log(df, options(tmp_path), metadata=("id",), order=["id"])


def test_empty_tag_is_no_tag(spark, tmp_path):
    write_log(rows(spark, 3), options(tmp_path, tag=""), exclude=("queue_id",), order=["id"])
    assert {r["tags"] for r in storage.messages(spark, str(tmp_path), "t").collect()} == {None}


def test_parallelism(spark, tmp_path):
    name = write_log(rows(spark, 300), options(tmp_path, **{"sink.parallelism": "3"}), exclude=("queue_id",), order=["id"])
    files = list((tmp_path / "topic=t" / f"batch={name}").glob("*.parquet"))
    assert len(files) == 3 and len(offsets(spark, tmp_path)) == 300


def test_row_kinds_need_a_changelog_format(spark, tmp_path):
    df = spark.createDataFrame([(1, "+I"), (2, "-D")], "id int, row_kind string")
    with pytest.raises(PySparkException, match="cannot write row kind -D"):
        write_log(df, options(tmp_path / "a"), order=["id"])
    write_log(df, options(tmp_path / "b", format="ogg-json"), order=["id"], primary_key=["id"])
    got = read_log(spark, options(tmp_path / "b", format="ogg-json"), "id int", primary_key=["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "+I"), (2, "-D")]


def test_fixed(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "p int")
    assert [r["queue_id"] for r in partitioners.fixed(df, 4, "p").orderBy("p").collect()] == [0, 1, 2, 3, 0, 1]
    assert partitioners.fixed(df.repartition(3), 2).select("queue_id").distinct().count() <= 2
    with pytest.raises(ValueError, match="no queues"):
        partitioners.fixed(df, 0, "p")
    with pytest.raises(PySparkException, match="negative"):
        partitioners.fixed(df.withColumn("p", F.col("p") - 1), 4, "p").collect()


def test_round_robin(spark):
    df = rows(spark, 100).drop("queue_id")
    for placed in (partitioners.round_robin(df.coalesce(1), 4), partitioners.round_robin(df, 4, "key", ["id"], rows_per_bucket=7)):
        counts = [r["count"] for r in placed.groupBy("queue_id").count().collect()]
        assert counts == [25] * 4
    with pytest.raises(ValueError, match="order"):
        partitioners.round_robin(df, 4, "key")


class ByKey(partitioners.Partitioner):
    def queue(self, row, key, body, topic, n):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


class Wrong:
    pass


def test_custom(spark, tmp_path):
    name = f"{ByKey.__module__}.ByKey"
    o = options(tmp_path, **{"sink.partitioner": name, "key.fields": "key"})
    write_log(rows(spark, 50).drop("queue_id"), o, order=["id"], queues=3)
    got = read_log(spark, options(tmp_path), "id bigint, key string", metadata=["queue_id"])
    assert got.groupBy("key").agg(F.count_distinct("queue_id").alias("n")).where("n > 1").count() == 0
    with pytest.raises(ValueError, match="not a subclass"):
        partitioners.load(f"{Wrong.__module__}.Wrong")
    for missing in ("no.such.Thing", "nodots", f"{Wrong.__module__}.Nothing"):
        with pytest.raises(ValueError, match="no class to import"):
            partitioners.load(missing)
    for bad in (F.lit(3), F.lit(-1), F.lit(None).cast("int")):
        with pytest.raises(PySparkException, match="outside 0..2"):
            partitioners.custom(rows(spark, 3), 3, lambda *a, bad=bad: bad, topic="t").collect()


def reference_buffer(items, max_rows, interval):
    """Row by row: (position, second, key) in order → positions that are sent."""
    sent, held, count, window = [], {}, 0, None
    for position, second, key in items:
        if window is not None and (second // interval != window or count >= max_rows):
            sent += held.values()
            held, count = {}, 0
        window = second // interval
        held[key] = position
        count += 1
    return sorted(sent + list(held.values()))


@pytest.mark.parametrize("max_rows, interval", [(1, 10), (3, 10), (7, 25), (1000, 5), (4, 1000)])
def test_buffer(spark, max_rows, interval):
    items = [(i, (i * i) // 40, f"k{(i * 7) % 4}") for i in range(100)]
    df = spark.createDataFrame([(p, T0 + datetime.timedelta(seconds=s), k) for p, s, k in items], "pos bigint, ts timestamp, key string")
    one = df.withColumn("producer", F.lit(0))
    got = compaction.compact(one, ["producer"], ["pos"], ["key"], "ts", max_rows, interval * 1000, rows_per_bucket=9)
    assert sorted(r["pos"] for r in got.collect()) == reference_buffer(items, max_rows, interval)


def test_buffer_is_off_unless_both_limits_are_set(spark):
    df = rows(spark, 10).withColumn("ts", F.current_timestamp())
    for limits in ((0, 1000), (5, 0)):
        assert compaction.compact(df, ["queue_id"], ["id"], ["key"], "ts", *limits).count() == 10


def test_buffered_write(spark, tmp_path):
    df = rows(spark, 20).drop("queue_id").withColumn("ts", F.lit(T0) + F.make_dt_interval(secs=F.col("id")))
    o = options(tmp_path, **{"sink.buffer-flush.max-rows": "10", "sink.buffer-flush.interval": "1 h", "key.fields": "key"})
    write_log(df, o, order=["id"], queues=1, exclude=("ts",), store_timestamp=F.col("ts"))
    assert [i for _, _, i in offsets(spark, tmp_path)] == [5, 6, 7, 8, 9, 15, 16, 17, 18, 19]


def test_upsert_drops_before_rows_and_deletes(spark):
    changes = spark.createDataFrame(
        [("+I", 0, 1, "a"), ("-U", 1, 1, "a"), ("+U", 1, 1, "b"), ("+I", 0, 2, "x"), ("-D", 3, 2, "x"), ("+I", 0, 3, None)],
        "row_kind string, seq int, id int, v string")
    got = changelog.upsert_materialize(changes, ["id"], ["seq"])
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, "b"), (3, None)]
    with pytest.raises(ValueError, match="primary key"):
        changelog.upsert_materialize(changes, [], ["seq"])


def test_assigned_offsets_do_not_depend_on_partitions(spark):
    df = rows(spark, 1000, lambda i: 0 if i % 3 == 0 else i % 5).withColumns(
        {"topic": F.lit("t"), "broker_name": F.lit("b")})
    results = []
    for parts in (1, 3, 16):
        got = sink.assign_offsets(df.repartition(parts), ["id"], rows_per_bucket=50)
        results.append(sorted((r["queue_id"], r["id"], r["queue_offset"]) for r in got.collect()))
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("per_bucket", [10, 10**9])
def test_dense_index_numbers_null_groups(spark, per_bucket):
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.col("id").alias("b"))
    first = spark.createDataFrame([(None, 1000), (1, 5)], "g bigint, first bigint")
    got = {(r["g"], r["b"]): r["row_index"] for r in dense_index(df, ["g"], ["b"], first=first, rows_per_bucket=per_bucket).collect()}
    begin = {None: 1000, 1: 5, 2: 0}
    assert got == {(i % 3 or None, i): begin[i % 3 or None] + i // 3 for i in range(300)}


def test_buffers_keep_rows_without_time(spark):
    rows = [(i, T0 if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "seq bigint, at timestamp").withColumn("p", F.lit(0))
    assert compaction.compact(df, ["p"], ["seq"], ["seq"], "at", 1, 1000).count() == 40
    assert compaction.compact_interval(df, ["p"], "seq", ["seq"], "at", 1000).count() == 40
    assert compaction.compact(df, ["p"], ["seq"], ["seq"], "at", 1, 1000, rows_per_bucket=7).count() == 40


def test_a_retry_after_another_commit_comes_last(spark, tmp_path, monkeypatch):
    def put(lo, txn):
        df = spark.range(lo, lo + 10).select(F.col("id"), F.lit("k").alias("key"), F.lit(0).alias("queue_id"))
        write_log(df, options(tmp_path), exclude=("queue_id",), order=["id"], txn=txn)

    mark = storage.mark_committed

    def crash(*args):
        raise RuntimeError("lost")

    put(0, "a")
    monkeypatch.setattr(storage, "mark_committed", crash)
    with pytest.raises(RuntimeError, match="lost"):
        put(10, "b")
    monkeypatch.setattr(storage, "mark_committed", mark)
    put(20, "c")
    put(10, "b")
    put(30, "d")
    got = offsets(spark, tmp_path)
    assert [o for _, o, _ in got] == list(range(40))
    assert [i for _, _, i in got] == [*range(10), *range(20, 30), *range(10, 20), *range(30, 40)]
