"""Near-duplicates by the Jaccard similarity of word shingles: every pair within it, and no other.

Sets that are similar enough differ in few shingles. Shingles are dealt by their hash into more parts
than may differ, so two similar sets agree wholly in one part at least, and a part's hash is a key.
A set that shares fewer keys than it must with a similar one is compared with nothing.
Keys only say which sets to compare; every link is then confirmed on the shingles themselves.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from queuelog.llm import simhash
from queuelog.llm.common import components, free_shuffles, rows_of, staged
from queuelog.llm.simhash import shingle_hashes

#: Shingles of a block; groups of candidates beyond it are compared block by block.
BLOCK = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, shingle)]))


def set_id(grams: np.ndarray) -> int:
    """One number for all texts with the same shingles."""
    return xxhash.xxh64_intdigest(grams.tobytes()) - (1 << 63)


class Classes:
    """Sizes of sets, cut so that similar sets lie in one class or in neighbouring ones."""

    def __init__(self, similarity: Fraction):
        self.p, self.q = similarity.numerator, similarity.denominator
        self.lows = [1]

    def of(self, size: int) -> int:
        while self.lows[-1] <= size:
            self.lows.append(self.lows[-1] * self.q // self.p + 1)
        return bisect.bisect_right(self.lows, size) - 1

    def differ(self, number: int) -> int:
        """Most shingles in which a set of this class and a similar one, not smaller, differ."""
        return (self.lows[number + 1] - 1) * (self.q - self.p) // self.p

    def met(self, size: int) -> range:
        """Classes of the smaller set in pairs that a set of this size can be in: its own, or the one below."""
        return range(self.of(-(-size * self.p // self.q)), self.of(size) + 1)

    def parts(self, number: int) -> int:
        most = self.differ(number)
        return most + most // 8 + 3

    def needs(self, grams: np.ndarray) -> list[int]:
        """For each class that a set meets others in: how many of its keys a similar set there has at
        least. All its filled parts agree but one for each shingle in which the two may differ, with
        their sizes and not the largest of the class in mind."""
        size, needs = len(grams), []
        for number in self.met(size):
            if number == self.of(size):
                differ = size * (self.q - self.p) // self.p
            else:
                differ = (self.lows[number + 1] - 1 + size) * (self.q - self.p) // (self.q + self.p)
            filled = len(np.unique(grams % np.uint64(self.parts(number))))
            needs.append(max(1, filled - differ))
        return needs

    def keys(self, grams: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Hashes of the parts of a set, for each class that it meets others in.

        A differing shingle spoils one part, so a set with more filled parts than may differ agrees
        with a similar one in a filled part. Only sets with fewer need their empty parts as well."""
        if not len(grams):
            return
        for number in self.met(len(grams)):
            most = self.differ(number)
            if not most:
                continue  # only equal sets, which are one node
            parts = self.parts(number)
            part = (grams % np.uint64(parts)).astype(np.int64)
            total = np.zeros(parts, np.uint64)
            np.add.at(total, part, _mixed(grams))
            filled = np.bincount(part, minlength=parts) > 0
            label = np.uint64(number << 40) + np.arange(parts, dtype=np.uint64)
            key = _mixed(_mixed(label + np.uint64(1)) ^ total)
            yield number, (key if filled.sum() <= most else key[filled]).view(np.int64)


def _sets(docs: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """For every row its set's id, size, first class and needs in its classes, and a hash of its text to find it by."""
    names = ["doc_id", "source", "node", "size", "low", "needs"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(similarity)
        for batch in batches:
            found = []
            for _, text, _ in rows_of([batch], 64):
                grams = shingle_set(text, shingle)
                found.append((set_id(grams), len(grams), classes.met(len(grams))[0], classes.needs(grams)))
            own = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *own], names)

    return _texts(docs).mapInArrow(compute, ", ".join(f"{name} bigint" for name in names[:-1]) + ", needs array<bigint>")


def _keyed(docs: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """``key, node`` for the keys of every set, ``node`` being the set in the key's class: its id with
    the class's number in the low bits (exclusive or). They go straight into the shuffle, not to disk before."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(similarity)
        for batch in batches:
            met = set()  # copies in a batch send keys once
            for at in range(0, batch.num_rows, 64):
                keys, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                for (text,) in rows_of([batch.slice(at, 64)], 64):
                    grams = shingle_set(text, shingle)
                    node = set_id(grams)
                    if node not in met:
                        met.add(node)
                        for number, found in classes.keys(grams):
                            keys.append(found)
                            nodes.append(np.full(len(found), node ^ number))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], ["key", "node"])

    return docs.select("text").mapInArrow(compute, "key bigint, node bigint")


def text_hash(text: Column) -> Column:
    """What ``source`` holds of a text."""
    return F.xxhash64(text.cast("binary"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", text_hash(F.col("text")).alias("source"))


def _shared(keyed: DataFrame) -> DataFrame:
    """``key, node``, once each, for the keys that several sets have."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row waits for the next one; ``before`` says whether the row before it has its key
        key, node, before = np.empty(0, np.int64), np.empty(0, np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node = (np.concatenate([held, c.to_numpy()]) for held, c in zip((key, node), batch.columns))
            once = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])]))
            key, node = key[once], node[once]
            same = np.concatenate([[before], key[1:] == key[:-1]])
            own = np.flatnonzero(same[:-1] | same[1:])
            yield pa.RecordBatch.from_arrays([pa.array(key[own]), pa.array(node[own])], ["key", "node"])
            key, node, before = key[-1:], node[-1:], bool(same[-1])
        own = slice(0, len(key) if before else 0)
        yield pa.RecordBatch.from_arrays([pa.array(key[own]), pa.array(node[own])], ["key", "node"])

    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(find, "key bigint, node bigint")


def _stars(keyed: DataFrame) -> DataFrame:
    """Links from every set with a key to the first one with it, a row at a time."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for batch in batches:
            key, node = (c.to_numpy() for c in batch.columns)
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            heads = node[starts]
            if key[0] == last:
                heads[0] = first
            head = np.repeat(heads, np.diff(np.append(starts, len(key))))
            last, first = key[-1], head[-1]
            own = np.flatnonzero(node != head)
            yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(head[own])], ["u", "v"])

    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(link, "u bigint, v bigint")


def similar(sets: list[np.ndarray], similarity: Fraction) -> Iterator[tuple[int, int]]:
    """Links that join sets with this similarity into the right components, one per set reached.

    Each set met is compared with all not met yet whose size allows it."""
    p, q = similarity.numerator, similarity.denominator
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    rows, sizes = np.array(order), np.array([len(sets[i]) for i in order])
    names, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    ids = ids.astype(np.int32)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    own = {int(rows[i]): ids[edges[i] : edges[i + 1]] for i in range(len(rows))}
    marked = np.zeros(len(names), bool)
    left = np.ones(len(rows), bool)
    for seed in order:
        at = np.flatnonzero(rows == seed)
        if not len(at) or not left[at[0]]:
            continue
        left[at[0]], front = False, [seed]
        while front and left.any():
            if 2 * left.sum() < len(rows):  # what was met goes
                ids = ids[np.repeat(left, sizes)]
                rows, sizes = rows[left], sizes[left]
                edges, left = np.concatenate([[0], np.cumsum(sizes)]), np.ones(len(rows), bool)
            row = front.pop()
            n = len(own[row])
            low, high = np.searchsorted(sizes, -(-n * p // q)), np.searchsorted(sizes, n * q // p, "right")
            if low >= high:
                continue
            marked[own[row]] = True
            common = np.add.reduceat(marked[ids[edges[low] : edges[high]]], edges[low:high] - edges[low], dtype=np.int64)
            marked[own[row]] = False
            found = low + np.flatnonzero(left[low:high] & ((p + q) * common >= p * (n + sizes[low:high])))
            left[found] = False
            for other in rows[found].tolist():
                yield row, other
                front.append(other)


def _confirmed(texts: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """Links between the sets of each group, from their texts."""
    names = ["root", "low", "high"]
    texts = texts.repartition(*names).sortWithinPartitions(*names, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            found = list(similar(sets, similarity)) if len(sets) > 1 else []
            u, v = ([nodes[pair[i]] for pair in found] for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        group, nodes, sets = None, [], []
        for *key, node, text in rows_of(batches):
            if key != group:
                yield links(nodes, sets)
                group, nodes, sets = key, [], []
            nodes.append(node)
            sets.append(shingle_set(text, shingle))
        yield links(nodes, sets)

    return texts.mapInArrow(compare, "u bigint, v bigint")


def grouped(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, source, root`` for every row of ``docs``: a hash of its text and the
    number of its component; see ``similar_documents``."""
    least = Fraction(str(similarity))
    if not 0 < least < 1:
        raise ValueError(f"similarity must lie between 0 and 1, not {similarity}")
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    sets = staged(_sets(docs, shingle, least), "sets")
    own = [F.max(name).alias(name) for name in ("size", "low", "needs")]
    nodes = staged(sets.groupBy("node").agg(F.min("source").alias("source"), *own), "nodes")
    near = _fingerprinted(docs, nodes)
    free_shuffles(docs.sparkSession)
    shared = staged(_shared(_keyed(docs, shingle, least)), "shared")
    free_shuffles(docs.sparkSession)
    placed = near.unionByName(_candidates(nodes, shared))
    # both kinds of groups in one go, as every set's text moves once to be met with its places
    found = components(_links_of(docs, placed, shingle, least)).withColumnRenamed("node", "_node")
    free_shuffles(docs.sparkSession)
    roots = nodes.join(found, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("root", "node").alias("root"))
    return sets.select("doc_id", "source", "node").join(roots, "node").drop("node")


def _fingerprinted(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The components of SimHash fingerprints as groups ``root, node, source, size``."""
    near = simhash.near_duplicates(_texts(docs).select("source", "text"), doc_id="source")
    near = near.select(F.col("doc_id").alias("source"), F.col("component_id").alias("root")).distinct()
    placed = staged(nodes.where("size > 0").select("node", "source", "size").join(near, "source"), "fingerprinted")
    several = placed.groupBy("root").count().where("count > 1").select("root")
    return placed.join(several, "root", "left_semi").select("root", "node", "source", "size")


def _candidates(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """Groups ``root, node, source, size`` of sets that share keys of one class, directly or by others; as no
    group spans several classes, sets of very different sizes never meet. Passages that many texts have
    give a set fewer keys than it must share with a similar one; such a set joins no group."""
    met = nodes.select("node", "source", "size", "low", F.posexplode("needs").alias("at", "need"))
    met = met.select(
        F.col("node").bitwiseXOR(F.col("low") + F.col("at")).alias("place"), F.col("node").alias("own"), "source", "size", "need"
    )
    keys = F.count("*").over(Window.partitionBy("node"))
    left = shared.withColumn("keys", keys).join(met.select("place", "need"), F.col("node") == F.col("place"))
    left = left.where("keys >= need").select("key", "node")
    groups = staged(components(staged(_stars(left), "stars")), "candidates")
    return groups.join(met, F.col("node") == F.col("place")).select("root", F.col("own").alias("node"), "source", "size")


def _links_of(docs: DataFrame, placed: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """Confirmed links inside groups given as ``root, node, source, size``. A group is cut into blocks by its
    size, and a set meets every block."""
    blocks = placed.groupBy("root").agg(F.ceil(F.sum("size") / F.lit(BLOCK)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: (i != F.col("block")) | (F.col("blocks") == 1))
    placed = placed.join(blocks, "root").withColumn("block", block).withColumn("other", F.explode(others))
    placed = placed.select("root", "node", "source", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    # one text of each set meets its places; equal texts lie together, so leaving them out moves nothing
    texts = _texts(docs).select("source", "text").join(placed, "source").dropDuplicates(["source", "root", "low", "high"])
    return staged(_confirmed(texts.select("root", "low", "high", "node", "text"), shingle, similarity), "confirmed")


def similar_documents(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs``.

    Options: ``shingle`` 5 words, ``similarity`` 0.8, and the column names ``doc_id`` and ``text``. Documents
    link where the sets of their word shingles (A-Z lower-cased) have a Jaccard similarity
    of ``similarity`` or more: every such pair and no other, up to equal 64-bit hashes of different
    shingles, sets or texts. ``component_id`` is the smallest doc_id reachable, the row's own included;
    null where no member has an id. Texts without words link with each other. Repeated rows are rows.
    Other columns are ignored.
    """
    rows = staged(grouped(docs, **options).select("doc_id", "root"), "grouped")
    return rows.join(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "component_id")
