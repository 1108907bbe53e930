"""Top-k over many shards and packs: no side goes through the driver, answers are whole."""

import math

import numpy as np
import pytest

from queuelog.llm import topk


def brute(rows, k, asks):
    """Rows as (id, vector); scores by whole numbers of any size."""
    each = {(i, tuple(v)) for i, v in rows if asks(i)}
    rows, out = [(i, [math.floor(64 * x) for x in v]) for i, v in rows], {}
    for i, q in each:
        q = [math.floor(64 * x) for x in q]
        out.setdefault(i, []).extend((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i)
    return {(i, r + 1, j, -s) for i, found in out.items() for r, (s, j) in enumerate(sorted(found)[:k])}


@pytest.fixture
def small(monkeypatch):
    for name, value in {"BLOCK": 4, "SHARD": 2, "QUERIES": 3, "HELD": 400, "ASKED": 300, "FIRST": 4}.items():
        monkeypatch.setattr(topk, name, value, raising=False)


def test_no_table_goes_through_the_driver(spark, small):
    """Packs that are copied to every shard look small to Spark until they are copied."""
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=8)]) for i in range(400)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), topk.F.col("vec_id") % 2 == 0, k=3)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 600


@pytest.mark.parametrize("size", [1.0, 300.0, 1e5, 1e7])
def test_all_cells_together(spark, small, size):
    """Components of one to eight bytes, repeated ids, rows and vectors, vectors of several lengths."""
    r = np.random.default_rng(int(size))
    rows = [(int(r.integers(0, 150)), [float(x) for x in np.round(size * r.normal(size=r.integers(0, 6)), 2)]) for _ in range(200)]
    rows += [*rows[:9], (3, [size, -size]), (3, [-size, size]), (4, [size, -size]), (5, [-2.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(x) for x in topk.top_k(df, df.vec_id % 3 == 0, k=4).collect()]
    want = brute(rows, 4, lambda i: i % 3 == 0)
    assert len(got) == len({x[:2] for x in got}) and set(got) == want


def test_fewer_than_k(spark, small):
    df = spark.createDataFrame([(i, [float(i), -1.0]) for i in range(30)] + [(100, [])], "vec_id bigint, embedding array<float>")
    got = topk.top_k(df, df.vec_id < 2, k=50).groupBy("query_id").count().collect()
    assert {tuple(x) for x in got} == {(0, 30), (1, 30)}
    alone = df.where("vec_id = 1")
    assert topk.top_k(alone, alone.vec_id == 1).count() == topk.top_k(df, df.vec_id < 0).count() == 0
    none = spark.createDataFrame([(1, []), (2, [])], "vec_id bigint, embedding array<float>")
    assert {tuple(x) for x in topk.top_k(none, none.vec_id == 1).collect()} == {(1, 1, 2, 0)}


def test_shards_go_on_from_each_other(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    r = np.random.default_rng(7)
    data, q = r.integers(-128, 128, (300, 5)).astype(np.int8), r.integers(-128, 128, (20, 5)).astype(np.int8)
    data[200:] = data[:100]
    scores = q.astype(int) @ data.T.astype(int)
    want = [sorted((-int(scores[i, j]), j) for j in range(300) if j != i)[:6] for i in range(20)]
    for least in (None, np.array([-w[-1][0] for w in want])):
        top = None
        for at in (200, 0, 100):
            top = topk.search(np.arange(20), q, np.arange(at, at + 100), data[at : at + 100], 6, top, least)
        for i in range(20):
            assert sorted(zip((-top[2][top[0] == i]).tolist(), top[1][top[0] == i].tolist())) == want[i]
