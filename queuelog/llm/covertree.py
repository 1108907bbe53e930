"""Embedding near-duplicates: cover trees and dual traversal."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import components, local_roots, staged, table

#: Vectors per top-level node that are aimed at, most top-level nodes of a label, vectors per block.
NODE, MOST_NODES, BLOCK = 2048, 256, 4096
#: Radii of the levels below the root of a block's tree, halving; nodes of at most LEAF are not split.
RADII, LEAF = (1.0, 0.5, 0.25, 0.125), 8
#: Pairs or products held at a time, and slack for rounding in bounds.
SLAB, SLACK = 1 << 20, 1e-7


def usable(v: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(rows):
        return np.zeros((0, 1))
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    flat = flat / np.abs(flat).max(1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


class CoverTree:
    """Levels of nodes over unit vectors. Each level divides the members of the nodes above among
    centers that cover them within the level's radius; a node knows its true covering radius."""

    def __init__(self, vectors: np.ndarray):
        self.v = vectors
        members, parents = [np.arange(len(vectors))], [0]
        self.levels = [self._level(members, parents)]
        for radius in RADII:
            nodes, parents = [], []
            for i, own in enumerate(members):
                small = len(own) <= LEAF or self.levels[-1][1][i] <= radius
                parts = [own] if small else self._net(own, radius)
                nodes += parts
                parents += [i] * len(parts)
            members = nodes
            self.levels.append(self._level(members, parents))
        self.sizes = np.array(list(map(len, members)))
        self.starts, self.order = np.cumsum(self.sizes) - self.sizes, np.concatenate(members)

    def _level(self, members: list[np.ndarray], parents: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centers, radii and parents of a level's nodes; a center is its node's first member."""
        order, sizes = np.concatenate(members), np.array(list(map(len, members)))
        centers = order[np.cumsum(sizes) - sizes]
        far = np.empty(len(order))
        for at in range(0, len(order), 65536):
            part = slice(at, at + 65536)
            dots = np.einsum("ij,ij->i", self.v[order[part]], self.v[np.repeat(centers, sizes)[part]])
            far[part] = np.sqrt(np.maximum(0, 2 - 2 * dots))
        return centers, np.maximum.reduceat(far, np.cumsum(sizes) - sizes), np.array(parents)

    def _net(self, own: np.ndarray, radius: float) -> list[np.ndarray]:
        parts, rest = [], own
        while len(rest):
            head = rest[:64]
            near, free, chosen = distances(self.v[head], self.v[head]) <= radius, np.ones(len(head), bool), []
            for i in range(len(head)):
                if free[i]:
                    chosen.append(i)
                    free &= ~near[i]
            to = distances(self.v[rest], self.v[head[chosen]])
            best = to.argmin(1)
            covered = to[np.arange(len(rest)), best] <= radius
            covered[chosen], best[chosen] = True, np.arange(len(chosen))
            inside, of = rest[covered], best[covered]
            first = np.ones(len(inside), bool)
            first[np.isin(inside, head[chosen])] = False  # the center leads its node
            by = np.lexsort((first, of))
            parts += np.split(inside[by], np.cumsum(np.bincount(of, minlength=len(chosen)))[:-1])
            rest = rest[~covered]
        return parts


def dual(a: CoverTree, b: CoverTree, reach: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members (index in a, index in b) that may lie within ``reach``: from the roots down,
    a pair of nodes goes on only if its parents did and the distance of the centers is at most both
    covering radii and ``reach``. A level is done for all its pairs at once, in slabs. With ``same``
    the trees are one, and each pair comes once."""
    on = np.ones((1, 1), bool)
    for (ca, ra, pa_), (cb, rb, pb) in zip(a.levels[1:], b.levels[1:]):
        below = np.empty((len(ca), len(cb)), bool)
        step = max(1, SLAB // len(cb))
        for at in range(0, len(ca), step):
            part = slice(at, at + step)
            limit = ra[part][:, None] + (rb + reach + SLACK)[None, :]
            below[part] = (distances(a.v[ca[part]], b.v[cb]) <= limit) & on[pa_[part]][:, pb]
            if same:
                below[part] = np.triu(below[part], at)
        on = below
    x, y = np.nonzero(on)
    many = a.sizes[x] * b.sizes[y]
    ends = np.cumsum(many)
    at = 0
    while at < len(x):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLAB, side="right")))
        i, j, n = x[at:to], y[at:to], many[at:to]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(b.sizes[j], n)
        left = a.order[np.repeat(a.starts[i], n) + nth // wide]
        right = b.order[np.repeat(b.starts[j], n) + nth % wide]
        if same:
            inner = np.repeat(i == j, n)
            ok = ~inner | (left < right)
            left, right = left[ok], right[ok]
        yield left, right
        at = to


def _compare(threshold: float):
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Links of one pair of blocks: per node the number of vectors linked, and a forest."""
        same = bool(left.num_rows and left["same"][0].as_py())
        right = left if same else right
        a = CoverTree(unit(left["v"]))
        b = a if same else CoverTree(unit(right["v"]))
        ids = np.concatenate([left["node"].to_numpy()] if same else [left["node"].to_numpy(), right["node"].to_numpy()])
        n = np.concatenate([left["n"].to_numpy()] if same else [left["n"].to_numpy(), right["n"].to_numpy()])
        shift = 0 if same else left.num_rows
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for x, y in dual(a, b, reach, same):
            near = np.einsum("ij,ij->i", a.v[x], b.v[y]) >= threshold
            x, y = x[near], y[near] + shift
            np.add.at(links, x, n[y])
            np.add.at(links, y, n[x])
            root = local_roots(len(ids), np.concatenate([x, np.arange(len(ids))]), np.concatenate([y, root]))
        own = np.flatnonzero(links)
        return pa.table({"node": ids[own], "links": links[own], "root": ids[root[own]]})

    return run


def _assign(vectors: pa.Table, centers: pa.Table) -> pa.Table:
    """Nearest top-level center of every vector and the distance to it; ties to the smaller center."""
    order = np.argsort(centers["center"].to_numpy())
    ids, near = centers["center"].to_numpy()[order], unit(centers["cv"])[order]
    v, cell, far = unit(vectors["v"]), [], []
    for at in range(0, len(v), 1024):
        d = distances(v[at : at + 1024], near)
        best = d.argmin(1)
        cell.append(ids[best])
        far.append(d[np.arange(len(best)), best])
    out = vectors.select(["label", "dim", "node", "n", "v"])
    return out.append_column("cell", pa.array(np.concatenate(cell))).append_column("far", pa.array(np.concatenate(far)))


def _node_pairs(threshold: float):
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))

    def run(cells: pa.Table) -> pa.Table:
        """Pairs of blocks of one label whose top-level nodes may hold a link."""
        v, radius, blocks = unit(cells["cv"]), cells["radius"].to_numpy(), cells["blocks"].to_numpy()
        ids, out = cells["cell"].to_numpy(), []
        for i in range(len(v)):
            d = distances(v[i : i + 1], v[i:])[0]
            for j in np.flatnonzero((d <= radius[i] + radius[i:] + reach + SLACK) | (np.arange(len(d)) == 0)) + i:
                for a in range(blocks[i]):
                    for b in range(a if i == j else 0, blocks[j]):
                        out.append((ids[i], a, ids[j], b))
        ca, a, cb, b = (np.array(x, np.int64) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 4
        n = len(ca)
        fixed = {k: pa.array([cells[k][0].as_py()] * n, cells.schema.field(k).type) for k in ("label", "dim")}
        return pa.table({**fixed, "ca": ca, "a": a, "cb": cb, "b": b})

    return run


def near_vectors(
    rows: DataFrame, *, threshold: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows``.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is at
    least ``threshold``; vectors of different length never do. Vectors that are null, zero or hold
    null or non-finite components, and rows without label, link with nothing: no links, their own
    component. Equal vectors of a label are one weighted node, so copies are never paired. Rows that
    share a vec_id are one vector to components. Other columns are ignored.

    Level by level: a label's nodes are covered by centers drawn by hash (about one in ``NODE``,
    ``MOST_NODES`` at most); every vector goes to its nearest center, and pairs of top-level nodes
    that are too far apart for their covering radii are dropped. What is left of a node is cut into
    blocks of about ``BLOCK``; each remaining pair of blocks is a task's work, with a cover tree of halving
    radii for either block and a dual traversal. Links are counted and contracted in the task.
    """
    spark = rows.sparkSession
    own = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    own = own.withColumn("ok", usable(F.col("v")) & F.col("label").isNotNull())
    found = own.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    hashed = F.xxhash64("label", "v")
    found = found.select(
        "label", F.size("v").alias("dim"), F.coalesce("first", hashed).alias("node"), "first", "n", "v",
        hashed.alias("h"),
    )
    nodes = staged(found, "vectors")
    stats = nodes.groupBy("label", "dim").agg(F.count("*").alias("members"), F.min("h").alias("least"))
    stats = stats.withColumn("step", F.greatest(F.lit(NODE), F.ceil(F.col("members") / MOST_NODES)))
    stats = staged(stats.withColumn("salts", F.ceil(F.col("members") / (4 * BLOCK))), "labels")
    key = ["label", "dim"]
    drawn = nodes.join(stats, key).where((F.pmod("h", "step") == 0) | (F.col("h") == F.col("least")))
    centers = staged(drawn.select(*key, F.col("node").alias("center"), F.col("v").alias("cv"), "salts"), "centers")
    dealt = nodes.join(stats.select(*key, "salts"), key).withColumn("salt", F.pmod(F.xxhash64("h", F.lit(1)), F.col("salts")))
    spread = centers.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    kind = f"label {rows.schema[label].dataType.simpleString()}, dim int"
    both = dealt.groupBy(*key, "salt").cogroup(spread.groupBy(*key, "salt"))
    placed = staged(both.applyInArrow(_assign, f"{kind}, node bigint, n bigint, v array<double>, cell bigint, far double"), "placed")
    cells = placed.groupBy(*key, "cell").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / BLOCK).alias("blocks"))
    cells = cells.join(centers.select(*key, F.col("center").alias("cell"), "cv"), [*key, "cell"])
    cells = staged(cells, "cells")
    pairs = cells.groupBy(*key).applyInArrow(_node_pairs(threshold), f"{kind}, ca bigint, a bigint, cb bigint, b bigint")
    pairs = staged(pairs.withColumn("same", (F.col("ca") == F.col("cb")) & (F.col("a") == F.col("b"))), "pairs")
    placed = placed.join(cells.select(*key, "cell", "blocks"), [*key, "cell"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")))
    placed = placed.select(*key, "node", "n", "v", "cell", "block")
    at = [*key, "ca", "a", "cb", "b"]
    left = placed.withColumnsRenamed({"cell": "ca", "block": "a"}).join(pairs, [*key, "ca", "a"])
    right = placed.withColumnsRenamed({"cell": "cb", "block": "b"}).join(pairs.where("not same"), [*key, "cb", "b"])
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of their own, as both sides come from one table
    both = left.groupBy(*at).cogroup(right.groupBy(*at))
    linked = staged(both.applyInArrow(_compare(threshold), "node bigint, links bigint, root bigint"), "linked")
    roots = components(linked.select("node", "root"))
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("first").alias("component"))
    known = known.join(least, "root").select(F.col("label").alias("l"), F.col("v").alias("w"), "n", "links", "component")
    out = own.join(known, F.col("ok") & (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left")
    links = F.when(F.col("ok"), F.col("n") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("bigint")
    out = out.select("vec_id", links.alias("n_links"), F.when(F.col("ok"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda e:
    CASE WHEN e IS NULL OR isnan(e) OR isinf(e) THEN 1 ELSE 0 END), 'sum') = 0
    AND list_aggregate(list_transform(embedding, lambda e: CASE WHEN e <> 0 THEN 1 ELSE 0 END), 'sum') > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (
  SELECT u AS vec_id, u AS reached FROM l UNION SELECT r.vec_id, l.w FROM r JOIN l ON l.u = r.reached),
c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM l GROUP BY u)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
  coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""
