"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.model import scratch_path

#: Words of every contract: runs of bytes other than space and \t \n \v \f \r. On UTF-8 bytes
#: ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, and a lost executor
    costs no earlier work."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of plans that nobody holds go when the driver's JVM collects garbage, which a small
    driver seldom does by itself; executors' disks fill meanwhile. Call it where a large shuffle is behind."""
    gc.collect()
    spark._jvm.System.gc()


def held_out(doc_id: Column) -> Column:
    """The fold of the contracts: crc32 of the id as text, remainder 0 by 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def words_of(text: bytes | str | None) -> list[bytes]:
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).split()


_KEPT: dict[str, object] = {}


def kept(name: str, make):
    """A Python worker's one large object, for the tasks that follow; another name replaces it."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def rows_of(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; few at a time become Python objects. Binary text stays bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links ``a[i] - b[i]``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


#: Links a task contracts at a time.
CONTRACT = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def forest(us: list, vs: list) -> pa.RecordBatch:
        u, v = np.concatenate(us), np.concatenate(vs)
        nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = local_roots(len(nodes), index[: len(u)], index[len(u) :])
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["u", "v"])

    us, vs, held = [], [], 0
    for batch in batches:
        us.append(batch.column(0).to_numpy())
        vs.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= CONTRACT:
            yield forest(us, vs)
            us, vs, held = [], [], 0
    if held:
        yield forest(us, vs)


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (two bigint columns): the smallest node reachable.

    Large-star and small-star steps in turn, each a minimum per node (combined before the shuffle)
    and a join whose other side has one row per node. Tasks first contract their own links. Every
    round is written to the shared folder; the driver only hears whether every link ends at a root, one
    for each node.
    """
    u, v = links.columns
    edges = links.select(F.col(u).cast("bigint").alias("u"), F.col(v).cast("bigint").alias("v"))
    edges = edges.where("u is not null and v is not null and u <> v").mapInArrow(_contract, "u bigint, v bigint")
    edges = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    done = edges.isEmpty()
    while not done:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u")
        large = staged(large.select(F.col("far").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        inner = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_semi")
        torn = edges.groupBy("u").count().where("count > 1")
        done = inner.isEmpty() and torn.isEmpty()  # every node points at one node, which points nowhere
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
