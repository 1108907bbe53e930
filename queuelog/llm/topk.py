"""Exact top-k search by inner product: blocks in order of their bounds, scored until no bound reaches the kth."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelog.llm.common import free_shuffles, staged, table

#: Rows of a block, blocks of a shard, and queries that go through a shard together.
BLOCK, SHARD, QUERIES = 256, 32, 1024
#: Bytes of shards and of query packs that a task gets; lanes that few shards are dealt to, for more tasks.
HELD, ASKED, LANES = 16 << 20, 4 << 20, 16
#: One shard in so many is searched first.
FIRST = 16
PACKED = "part bigint, seq bigint, dim int, size bigint, ids binary, data binary"
FOUND = "pack bigint, ids binary, query binary, near binary, score binary"
LEAST = np.iinfo(np.int64).min


def finite(v: Column) -> Column:
    """Not null and without null or non-finite components."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def _batch(kinds: str, *values) -> pa.RecordBatch:
    """One row; ``kinds`` in the form of a schema of Spark."""
    of = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in kinds.split(", ")]
    arrays = [pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], of[t]) for v, (_, t) in zip(values, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _most(a: np.ndarray) -> float:
    return max(float(a.max(initial=0)), -float(a.min(initial=0)))


def _pack(scale: int, rows: int):
    """Consecutive rows as one: ids and whole-number components, row by row, zeros at the end of
    shorter vectors; as small integers where these hold them, else as doubles."""

    def emit(held: list[pa.RecordBatch], seq: int) -> pa.RecordBatch:
        ids = np.concatenate([b.column(0).to_numpy() for b in held])
        lengths = np.concatenate([b.column(1).value_lengths().to_numpy() for b in held])
        values = np.floor(scale * np.concatenate([b.column(1).flatten().to_numpy() for b in held]))
        dim, most = int(lengths.max()), _most(values)
        kind = next((t for t in (np.int8, np.int16, np.int32) if most <= np.iinfo(t).max), np.float64)
        data = np.zeros((len(ids), dim), kind)
        data[np.arange(dim) < lengths[:, None]] = values
        return _batch(PACKED, TaskContext.get().partitionId(), seq, dim, data.nbytes + ids.nbytes, ids, data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seq = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, rows - n))
                at, n = at + held[-1].num_rows, n + held[-1].num_rows
                if n == rows:
                    yield emit(held, seq)
                    held, n, seq = [], 0, seq + 1
        if held:
            yield emit(held, seq)

    return run


def _unpacked(dim: int, ids: np.ndarray, data: pa.Buffer) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32}.get(data.size // max(1, len(ids) * dim), np.float64)
    return np.frombuffer(data, kind).reshape(len(ids), dim)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Where the k highest scores of each query are, ties to smaller ids."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.concatenate([first, [len(q)]])))
    return order[rank < k]


def _kth(query: np.ndarray, score: np.ndarray, n: int, k: int) -> np.ndarray:
    """Of each of ``n`` queries the least of its scores, if there are k of them; else the least number."""
    lowest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(lowest, query, score)
    return np.where(np.bincount(query, minlength=n) >= k, lowest, LEAST)


def search(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int,
    top: tuple[np.ndarray, ...] | None = None, least: np.ndarray | None = None,
) -> tuple[np.ndarray, ...]:
    """Best ``k`` rows of a shard per query, as (query index, id, score); with ``top``, what other
    shards gave, those of all, and only such as reach the query's ``least`` score.

    A block's bound for a query is the sum over terms of the larger of its products with the block's
    highest and lowest component. Each query takes the blocks by falling bound, few and then more at a
    time, and stops at the first bound below its kth score so far; in a step, queries that want the
    same block score it together.
    """
    dim = min(q.shape[1], data.shape[1])  # what one side lacks is zero
    q, data = q[:, :dim], data[:, :dim]
    most = _most(q) * _most(data) * max(1, dim)
    # sums that neither kind of float holds exactly are 64-bit integers, as a long would hold them
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    q, data = q.astype(kind), data.astype(kind)
    cuts = range(0, len(data), BLOCK)
    high = np.array([data[c : c + BLOCK].max(0) for c in cuts])
    low = np.array([data[c : c + BLOCK].min(0) for c in cuts])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    least = np.full(len(q), LEAST) if least is None else least
    top = top or (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    kth = np.maximum(least, _kth(top[0], top[2], len(q), k)).astype(kind)
    open_, step, width = np.arange(len(q)), 0, 1 if (kth == kind(LEAST)).any() else 8
    while step < len(high):
        want = order[open_, step : step + width]
        reach = bound[open_[:, None], want] >= kth[open_][:, None]
        open_, want, reach = (x[reach[:, 0]] for x in (open_, want, reach))
        step, width = step + width, 4 * width
        found = []
        for block in np.unique(want[reach]):
            who, at = open_[(reach & (want == block)).any(1)], block * BLOCK
            part = q[who] @ data[at : at + BLOCK].T
            i, j = divmod(np.flatnonzero(part >= kth[who][:, None]), part.shape[1])  # faster than nonzero of two dimensions
            found.append((who[i], ids[at + j], part[i, j].astype(np.int64)))
        if not found:
            break
        query, near, score = (np.concatenate(x) for x in zip(*found))
        other = near != q_ids[query]
        hit = np.zeros(len(q), bool)
        hit[query[other]] = True
        again = hit[top[0]]
        query, near, score = (np.concatenate([t[again], x[other]]) for t, x in zip(top, (query, near, score)))
        keep = _best(query, near, score, k)
        query, near, score = query[keep], near[keep], score[keep]
        top = tuple(np.concatenate([t[~again], x]) for t, x in zip(top, (query, near, score)))
        kth = np.maximum(kth, _kth(query, score, len(q), k).astype(kind))
    return top


def _meet(k: int):
    """The query packs of a task through its shards, which come after them; a row for each pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs = []
        for batch in batches:
            for at in range(batch.num_rows):
                pack, dim, ids, data, least = (c[at] for c in batch.columns)
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                data = _unpacked(dim.as_py(), ids, data.as_buffer())
                if pack.is_valid:
                    least = np.frombuffer(least.as_buffer(), np.int64).copy() if least.is_valid else None
                    packs.append([pack.as_py(), ids.copy(), data.copy(), least, None])
                    continue
                for one in packs:
                    one[4] = search(one[1], one[2], ids, data, k, one[4], one[3])
        for pack, ids, _, _, top in packs:
            if top is not None:
                yield _batch(FOUND, pack, ids, *top)

    return run


def _merged(k: int):
    """Of rows in the order of their packs the best of each pack, and its queries' kth scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best() -> list[np.ndarray]:
            query, near, score = (np.concatenate(x) for x in zip(*held))
            keep = _best(query, near, score, k)
            return [query[keep], near[keep], score[keep]]

        def emit() -> pa.RecordBatch:
            query, near, score = best()
            return _batch(f"{FOUND}, least binary", pack, ids, query, near, score, _kth(query, score, len(ids), k))

        pack, ids, held = None, None, []
        for batch in batches:
            for at in range(batch.num_rows):
                number, own, *top = (c[at] for c in batch.columns)
                if held and number.as_py() != pack:
                    yield emit()
                    held = []
                pack, ids = number.as_py(), np.frombuffer(own.as_buffer(), np.int64).copy()
                held.append([np.frombuffer(x.as_buffer(), np.int64).copy() for x in top])
                if sum(len(x[0]) for x in held) >= 1 << 20:
                    held = [best()]
        if held:
            yield emit()

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            ids, query, near, score = (np.frombuffer(c[at].as_buffer(), np.int64) for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(near), pa.array(score)], ["query_id", "vec_id", "score"])


def _numbered(packed: DataFrame) -> tuple[DataFrame, int, int]:
    """Packed rows with a number ``at``, about consecutive; how many they are, and their bytes."""
    n, parts, size = packed.agg(F.count("*"), F.max("part") + 1, F.sum("size")).first()
    at = F.floor(F.col("part") * F.lit(n) / F.lit(parts or 1)) + F.col("seq")
    return packed.withColumn("at", at.cast("bigint")), n, size or 0


def top_k(
    rows: DataFrame, queries: Column, *, k: int = 20, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds, the ``k`` other rows
    with the highest inner product of floor(scale * component); all, if there are fewer.

    Ties go to the smaller vec_id; rows with the query's own vec_id are not candidates, and a repeated
    query id asks once per different vector. Vectors that are null or hold null or non-finite components, and
    rows without vec_id, take no part. Shorter vectors count as ending in zeros.

    Candidates are sorted into id ranges, whose blocks are packed into shards (the forward index).
    Query packs meet every shard in the cells of a grid, a task each: some ``ASKED`` bytes of packs go
    through some ``HELD`` bytes of shards and keep k rows per query on their way. One shard in ``FIRST``
    is met first, and the kth scores found there hold for the others. Packs and shards are copied to their
    cells by a shuffle and answers are merged by pack; neither side is held whole anywhere, and only counts pass the driver.
    """
    spark = rows.sparkSession
    own = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    doubles = F.col("v").cast("array<double>").alias("v")
    own = own.where(finite(doubles) & F.col("vec_id").isNotNull())
    ranged = own.select("vec_id", "v").repartitionByRange("vec_id").sortWithinPartitions("vec_id").select("vec_id", doubles)
    shards, n, size = _numbered(staged(ranged.mapInArrow(_pack(scale, BLOCK * SHARD), PACKED), "shards"))
    asked = own.where("asks").select("vec_id", doubles).distinct().repartition("vec_id")
    packs, m, asked_size = _numbered(staged(asked.mapInArrow(_pack(scale, QUERIES), PACKED), "queries"))
    packs = packs.withColumn("pack", F.shiftleft("part", 32) + F.col("seq"))
    groups = max(1, min(m, -(-asked_size // ASKED)))

    def met(shards: DataFrame, n: int, size: int, best: DataFrame | None) -> DataFrame:
        """Packs and the shards, ``n`` by ``at``, in their cells; with what was found before."""
        tasks = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // groups)
        lanes = max(1, min(n, max(-(-size // HELD), min(LANES, tasks))))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        bounds = packs.withColumn("least", F.lit(None).cast("binary")) if best is None else packs.join(best.select("pack", "least").hint("merge"), "pack", "left")
        bounds = bounds.withColumn("lane", each(lanes)).withColumn("group", F.pmod("at", F.lit(groups)))
        sides = shards.withColumns({"pack": F.lit(None).cast("bigint"), "least": F.lit(None).cast("binary"), "lane": F.pmod("at", F.lit(lanes))})
        sides = sides.withColumn("group", each(groups))
        cell = (F.col("group") * lanes + F.col("lane")).cast("int").alias("cell")
        names = ["pack", "dim", "ids", "data", "least"]
        both = bounds.select(cell, "at", *names).unionByName(sides.select(cell, "at", *names))
        dealt = both.repartitionById(groups * lanes, F.col("cell")).sortWithinPartitions(F.col("pack").isNull(), "at")
        found = dealt.select(*names).mapInArrow(_meet(k), FOUND)
        if best is not None:
            found = found.unionByName(best.drop("least"))
        return found.repartition("pack").sortWithinPartitions("pack").mapInArrow(_merged(k), f"{FOUND}, least binary")

    if not n or not m:
        found = spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    else:
        best, lot = None, F.floor(F.col("at") / FIRST)
        if n > FIRST:
            first = shards.where(F.col("at") % FIRST == 0).withColumn("at", lot)
            best = staged(met(first, n // FIRST, size // FIRST, None), "first")
            shards = shards.where(F.col("at") % FIRST != 0).withColumn("at", F.col("at") - lot - 1)
            free_shuffles(spark)
        found = met(shards, n, size, best).select("ids", "query", "near", "score")
        found = found.mapInArrow(_rows, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor(64 * CAST(e AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda e:
    CASE WHEN e IS NULL OR isnan(e) OR isinf(e) THEN 1 ELSE 0 END), 'sum') = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
