import datetime

import pytest
from pyspark.sql import functions as F

from queuelog import read_log, write_log
from queuelog.plans import fixtures as fx
from queuelog.sources import positions, storage
from queuelog.streaming import sink

T0 = datetime.datetime(2024, 1, 1)


def put(spark, path, ids, queue=lambda i: i % 2, at=lambda i: i, **more):
    rows = [(i, queue(i), T0 + datetime.timedelta(seconds=at(i))) for i in ids]
    df = spark.createDataFrame(rows, "id bigint, queue_id int, ts timestamp")
    return write_log(df, fx.options(str(path), "t"), exclude=("queue_id", "ts"), order=["id"], store_timestamp=F.col("ts"), **more)


def everything(spark, path):
    rows = read_log(spark, fx.options(str(path), "t"), "id bigint", metadata=["queue_id", "queue_offset"])
    return sorted((r.queue_id, r.queue_offset, r.id) for r in rows.collect())


@pytest.mark.parametrize("begun", [False, True])
def test_two_writers(spark, tmp_path, monkeypatch, begun):
    """A second writer commits while the first is at work: no offset twice, no batch lost."""
    if begun:
        put(spark, tmp_path, range(100, 104))
    plain, calls = sink.assign_offsets, []

    def interrupted(*args, **more):
        calls.append(1)
        if len(calls) == 1:
            put(spark, tmp_path, range(20, 30))
        return plain(*args, **more)

    monkeypatch.setattr(sink, "assign_offsets", interrupted)
    put(spark, tmp_path, range(20))
    rows = everything(spark, tmp_path)
    assert sorted(i for *_, i in rows) == sorted([*range(30), *(range(100, 104) if begun else ())])
    for q in (0, 1):
        assert [o for n, o, _ in rows if n == q] == list(range(len(rows) // 2))
    assert len(calls) == 3  # the overtaken writer numbers its rows anew


def test_a_commit_cut_off_after_its_claim_is_finished(spark, tmp_path, monkeypatch):
    folder = storage.Folder
    with monkeypatch.context() as m:
        m.setattr(folder, "touch", lambda self, name: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            put(spark, tmp_path, range(10))
    assert not storage.committed_batches(spark, str(tmp_path), "t")
    put(spark, tmp_path, range(10, 14))
    assert sorted(i for *_, i in everything(spark, tmp_path)) == list(range(14))


def test_a_time_opens_one_batch_a_queue(spark, tmp_path, monkeypatch):
    """Six batches; queue 1 lags behind queue 0 by two of them."""
    names = [put(spark, tmp_path, range(20 * n, 20 * n + 20), at=lambda i: i - (40 if i % 2 else 0)) for n in range(6)]
    plain, opened = storage.messages, []

    def messages(spark, log, topic, first=None, only=None):
        opened.append(only)
        return plain(spark, log, topic, first, only)

    monkeypatch.setattr(storage, "messages", messages)
    for second in (-100, 0, 30, 61, 62, 79, 99, 200):
        millis = 1704067200000 + 1000 * second
        positions.messages_around(spark, str(tmp_path), "t", millis)
        assert len(opened[-1]) <= 2 and set(opened[-1]) <= set(names)
        bounds = positions.topic_bounds(spark, str(tmp_path), "t")
        want = positions.timestamp_offsets(plain(spark, str(tmp_path), "t"), bounds, millis)
        got = positions.starting_offsets(spark, str(tmp_path), "t", "timestamp", timestamp_millis=millis)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
