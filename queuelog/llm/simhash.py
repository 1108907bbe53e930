"""SimHash near-duplicates with candidates from chains of fingerprint segments (pigeonring)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import components, local_roots, rows_of, staged, table

SEED, BITS = 42, 64
#: Segments of the ring and how many of them, from the start of a chain, a key looks at.
SEGMENTS, CHAIN = 9, 6
#: Low bits of a key that name the start and the set of segments.
TAG = 10
#: Words hashed at a time, and fingerprints compared at a time.
SLAB, BLOCK = 1 << 16, 2048
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 values of a text's word shingles, A-Z lower-cased, some at a time; none without words."""
    words = text.translate(_LOWER).split() if text else []
    n = max(1, len(words) - shingle + 1) if words else 0
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, SLAB):
        part = words[at : at + SLAB + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = np.concatenate([[0], ends[:-1]]).tolist()
        ends = (ends - 1)[min(shingle, len(part)) - 1 :].tolist()
        yield np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits of the XXH64 values of a text's word shingles; 0 without words."""
    votes, n = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(text, shingle):
        n += len(h)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (bigint, the bits of the unsigned value) for every row; null text has 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle) for _, t in rows_of([batch])), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(compute, "doc_id bigint, fp bigint")


def budgets(most: int, segments: int = SEGMENTS) -> list[int]:
    """Differences that the first 1, 2, ... segments of some chain stay within: the proportional share
    of ``most``. Going round the ring, one start keeps to all of them whenever the total is at most
    ``most``."""
    return [length * most // segments for length in range(1, segments + 1)]


def equal_sets(most: int) -> list[tuple[int, ...]]:
    """For a chain: sets of segments, one of which must agree wholly. They are what remains beside the
    largest sets of differing segments that the budgets of the first ``CHAIN`` segments allow."""
    allowed = budgets(most)
    fits = [
        set(d) for k in range(CHAIN + 1) for d in itertools.combinations(range(CHAIN), k)
        if all(sum(x <= i for x in d) <= allowed[i] for i in range(CHAIN))
    ]
    largest = [d for d in fits if not any(d < other for other in fits)]
    return [tuple(i for i in range(CHAIN) if i not in d) for d in largest]


def _segments() -> list[tuple[int, int]]:
    """Lowest bit and width of each segment."""
    edges = [BITS * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(most: int, fp: Column) -> list[Column]:
    """One key per start of the ring and set of segments that must agree; the start is in the key."""
    parts, keys = _segments(), []
    for start in range(SEGMENTS):
        for kind, chosen in enumerate(equal_sets(most)):
            key, at = F.lit(start * 64 + kind).cast("bigint"), TAG
            for i in chosen:
                low, width = parts[(start + i) % SEGMENTS]
                part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
                key = key.bitwiseOR(F.shiftleft(part, at))
                at += width
            assert at <= BITS
            keys.append(key)
    return keys


def _turned(fp: np.ndarray, start: int) -> np.ndarray:
    """Fingerprints turned so that the chain from ``start`` begins at bit 0."""
    low = np.uint64(_segments()[start][0])
    return fp if not low else (fp >> low) | (fp << (np.uint64(BITS) - low))


def _prefixes(start: int) -> list[np.uint64]:
    parts, bits, out = _segments(), 0, []
    for i in range(SEGMENTS):
        bits += parts[(start + i) % SEGMENTS][1]
        out.append(np.uint64((1 << bits) - 1))
    return out


def _near(a: np.ndarray, b: np.ndarray, start: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index of a, index of b) whose chain from ``start`` keeps its budgets; the last budget is
    the whole Hamming distance."""
    diff = _turned(a, start)[:, None] ^ _turned(b, start)[None, :]
    i, j = np.nonzero(diff >= 0)
    x = diff.ravel()
    for mask, allowed in zip(_prefixes(start)[1:], budgets(most)[1:]):
        ok = np.bitwise_count(x & mask) <= allowed
        i, j, x = i[ok], j[ok], x[ok]
    return i, j


def _links_within(fp: np.ndarray, start: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between fingerprints of one key, as a forest per pair of blocks."""
    for at in range(0, len(fp), BLOCK):
        a = fp[at : at + BLOCK]
        for other in range(at, len(fp), BLOCK):
            b = fp[other : other + BLOCK]
            i, j = _near(a, b, start, most)
            if other == at:
                i, j = i[i < j], j[i < j]
            if len(i):
                both = a if other == at else np.concatenate([a, b])
                root = local_roots(len(both), i, j if other == at else j + len(a))
                own = np.flatnonzero(root != np.arange(len(both)))
                yield both[own], both[root[own]]


def links(distinct: DataFrame, most: int) -> DataFrame:
    """Links ``u, v`` that join all fingerprints within ``most`` bits into the right components.

    A fingerprint goes to one key per start and set of agreeing segments (45 for four bits), each of
    about 28 bits, so groups stay small; in a group, chains are followed segment by segment and pairs
    fall out at the first budget they break. A group gives a forest, not its pairs, and is read in
    blocks. Groups of copies are one fingerprint here.
    """
    keyed = distinct.select(F.explode(F.array(*_keys(most, F.col("fp")))).alias("key"), "fp")
    keyed = keyed.repartition("key").sortWithinPartitions("key", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.empty(0, np.int64), np.empty(0, np.int64)
        for last, batch in _with_last(batches):
            if batch is not None:
                held_key = np.concatenate([held_key, batch.column(0).to_numpy()])
                held = np.concatenate([held, batch.column(1).to_numpy()])
            if not len(held):
                continue
            cut = len(held) if last else int(np.searchsorted(held_key, held_key[-1]))
            edges = np.flatnonzero(np.diff(held_key[:cut])) + 1
            starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [cut]])
            us, vs = [], []
            for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                for u, v in _links_within(held[a:b].view(np.uint64), (int(held_key[a]) & ((1 << TAG) - 1)) // 64, most):
                    us.append(u)
                    vs.append(v)
            if us:
                u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
            held_key, held = held_key[cut:], held[cut:]

    return keyed.mapInArrow(compare, "u bigint, v bigint")


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        if batch.num_rows:
            yield False, batch
    yield True, None


def near_duplicates(
    docs: DataFrame, *, shingle: int = 4, most: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Fingerprints link at ``most`` or fewer differing bits; ``component_id`` is the smallest doc_id
    reachable over links, the row's own included. Null and empty texts have fingerprint 0 and link
    like others. A null doc_id keeps its row; its component may have another id, or null where no
    member has one. Repeated rows are rows. Other columns are ignored.
    """
    fps = staged(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    firsts = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    # links are staged, so that no stage runs two Python functions: each would hold a worker of its own
    found = components(staged(links(firsts.select("fp"), most), "linked"))
    roots = firsts.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    component = roots.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    rows = fps.join(component, F.col("fp") == F.col("_fp"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
