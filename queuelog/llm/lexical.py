"""Ranked lexical search: posting lists cut into geometric blocks, skipped by exact summary bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelog.llm.common import rows_of, staged, table

#: Documents of a shard, documents of a block about, and entries of a sketch that tells similar documents.
SHARD, BLOCK, SKETCH = 2048, 64, 32
#: Distinct terms that one index knows, and items searched together; more items take further rounds.
TERMS, PACK = 1 << 18, 4096
#: One document in so many is searched first; the kth scores found are lower bounds for the others.
FIRST = 16
#: ASCII bytes that are no letter or digit; what they separate is a term.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, repeats included: bytes above 127 belong to characters beyond ASCII."""
    return (text or b"").translate(_BYTES).split()


def distinct_terms(text: Column) -> Column:
    """The same as an expression, each term once."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.filter(F.split(low, BETWEEN), lambda t: t != ""))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """A term's part of the score before its weight; ``n`` is the length of its document."""
    if 50 * n_docs * int(n.max(initial=0)) >= 2**63:
        m = np.array([50 + 50 * int(x) * n_docs // length for x in n], np.int64)
    else:
        m = 50 + 50 * n * n_docs // length
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def counted(docs: DataFrame, vocabulary: list[bytes], doc_id: str, text: str) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: its length, and of the terms in
    ``vocabulary`` their numbers, ascending, and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary)}
        known = number.__contains__
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, found, owner = [], [], []
                for i, (_, t) in enumerate(rows_of([part])):
                    words = terms_of(t)
                    sizes.append(len(words))
                    own = [number[w] for w in filter(known, words)]
                    found.append(np.array(own, np.int64))
                    owner.append(np.full(len(own), i))
                key = np.concatenate(owner) * len(number) + np.concatenate(found) if number else np.empty(0, np.int64)
                key, tf = np.unique(key, return_counts=True)
                ends = np.searchsorted(key, np.arange(len(sizes) + 1) * len(number)).astype(np.int32)
                terms = (key % max(1, len(number))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (terms, tf.astype(np.int64))]
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(np.array(sizes) > 0))

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of several ranges, one after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive pieces, 0 for empty ones."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


@dataclass
class Shard:
    """A forward index of some documents, and for each term its posting list in blocks.

    Terms have ranks, rarest first. A block of a term holds documents that resemble each other, and its
    summary the highest impact of every term from the block's own rank on. That is enough: a document
    needs to be found only under its rarest term of a query, and there all its terms of the query are in
    the summary. A summary's product with a query is therefore at least the score of every such document.
    """

    ids: np.ndarray
    has_id: np.ndarray
    doc_ends: np.ndarray
    terms: np.ndarray
    values: np.ndarray
    block_terms: np.ndarray
    block_ends: np.ndarray
    members: np.ndarray
    summary_ends: np.ndarray
    summary_terms: np.ndarray
    summary_values: np.ndarray


def _sketches(ends: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Unit vectors of documents whose products follow those of the weighted term vectors: every term has
    random signs."""
    signs = (np.random.default_rng(7).integers(0, 2, (len(weights), SKETCH), np.int8) * 2 - 1).astype(np.float32)
    out = np.zeros((len(ends) - 1, SKETCH), np.float32)
    for a in range(0, len(out), 512):
        b = min(a + 512, len(out))
        own = slice(ends[a], ends[b])
        part = signs[terms[own]] * (values[own] * weights[terms[own]]).astype(np.float32)[:, None]
        full = np.flatnonzero(np.diff(ends[a : b + 1]))
        if len(full):
            out[a + full] = np.add.reduceat(part, ends[a:b][full] - ends[a], axis=0)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def build(ids: np.ndarray, has_id: np.ndarray, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray) -> Shard:
    """The index of documents whose terms are ranks, ascending within each."""
    sketch = _sketches(ends, terms, values, weights)
    terms, values, slot = terms.astype(np.int32), values.astype(np.int32), np.zeros(len(weights), np.int64)
    owner = np.repeat(np.arange(len(ids)), np.diff(ends))
    order = np.argsort(terms, kind="stable")
    names, starts = np.unique(terms[order], return_index=True)
    cuts = np.append(starts, len(order))
    block_terms, block_sizes, members, summaries = [], [], [], []
    for t, a, b in zip(names.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
        at = order[a:b]
        docs = owner[at]
        count = -(-len(docs) // BLOCK)
        if count > 1:  # to the most similar of evenly chosen documents
            centers = docs[np.arange(count) * len(docs) // count]
            nearest = np.concatenate([(sketch[docs[c : c + 4096]] @ sketch[centers].T).argmax(1) for c in range(0, len(docs), 4096)])
            by = np.argsort(nearest, kind="stable")
            docs, at = docs[by], at[by]
            sizes = np.bincount(nearest, minlength=count)
            sizes = sizes[sizes > 0]
        else:
            sizes = np.array([len(docs)])
        # from the term's own place in a document on, terms of its rank and above
        tail = ends[docs + 1] - at
        entries = _ranges(at, ends[docs + 1])
        own = terms[entries]
        each = np.arange(len(own))
        slot[own] = each
        seen = np.sort(own[slot[own] == each])  # one place of each term
        slot[seen] = np.arange(len(seen))
        block = np.repeat(np.arange(len(sizes)) * len(seen), np.add.reduceat(tail, np.cumsum(sizes) - sizes))
        most = np.zeros(len(sizes) * len(seen), np.int32)
        np.maximum.at(most, block + slot[own], values[entries])
        filled = np.flatnonzero(most)
        summaries.append((np.bincount(filled // len(seen), minlength=len(sizes)), seen[filled % len(seen)], most[filled]))
        block_terms.append(np.full(len(sizes), t))
        block_sizes.append(sizes)
        members.append(docs)
    empty = [np.empty(0, np.int64)]
    join = lambda parts: np.concatenate(empty + list(parts))
    upto = lambda sizes: np.concatenate([[0], np.cumsum(sizes)])
    return Shard(
        ids, has_id, ends, terms, values, join(block_terms), upto(join(block_sizes)), join(members).astype(np.int32),
        upto(join(s[0] for s in summaries)), join(s[1] for s in summaries).astype(np.int32), join(s[2] for s in summaries).astype(np.int32),
    )


def search(shard: Shard, terms: np.ndarray, weights: np.ndarray, k: int, least: int, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard and scores: the ``k`` best for a query, of those that reach ``least``.

    Blocks of the query's terms are scored by falling bound, through the forward index, until no bound
    reaches the kth score so far. ``vector`` is zero before and after, one entry per rank."""
    vector[terms] = weights
    first, last = np.searchsorted(shard.block_terms, terms), np.searchsorted(shard.block_terms, terms, "right")
    blocks = _ranges(first, last)
    a, b = shard.summary_ends[blocks], shard.summary_ends[blocks + 1]
    entries = _ranges(a, b)
    bound = _sums(shard.summary_values[entries] * vector[shard.summary_terms[entries]], b - a)
    reach = np.flatnonzero(bound >= max(1, least))
    reach = reach[np.argsort(-bound[reach], kind="stable")]
    blocks, bound = blocks[reach], bound[reach]
    fresh = np.ones(len(shard.ids), bool)
    docs, scores, at, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, 4
    while at < len(blocks) and bound[at] >= least:
        now = blocks[at : at + step][bound[at : at + step] >= least]
        at, step = at + step, step * 2
        new = np.unique(shard.members[_ranges(shard.block_ends[now], shard.block_ends[now + 1])])
        new = new[fresh[new]]
        fresh[new] = False
        a, b = shard.doc_ends[new], shard.doc_ends[new + 1]
        entries = _ranges(a, b)
        score = _sums(shard.values[entries] * vector[shard.terms[entries]], b - a)
        good = score >= max(1, least)
        docs, scores = np.concatenate([docs, new[good]]), np.concatenate([scores, score[good]])
        if len(docs) > k:
            best = np.lexsort((docs, -scores))[:k]  # documents of a shard are numbered by id
            docs, scores = docs[best], scores[best]
        if len(docs) == k:
            least = max(least, int(scores.min()))
    vector[terms] = 0
    return docs, scores


def _shard(parts: list[pa.RecordBatch], rank: np.ndarray, weights: np.ndarray, n_docs: int, length: int) -> Shard:
    """The index of some rows of ``counted``; its documents are numbered by id, null last."""
    ids, n, terms, tfs = (pa.chunked_array([p.column(i) for p in parts]).combine_chunks() for i in range(4))
    has_id = ids.is_valid().to_numpy(zero_copy_only=False)
    ids, n = ids.fill_null(0).to_numpy(), n.to_numpy()
    sizes = np.diff(terms.offsets.to_numpy())
    owner = np.repeat(np.arange(len(ids)), sizes)
    values = impacts(tfs.flatten().to_numpy(), n[owner], n_docs, length)
    by_id = np.lexsort((ids, ~has_id))
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    ranks = rank[terms.flatten().to_numpy()]
    order = np.lexsort((ranks, place[owner]))
    ends = np.concatenate([[0], np.cumsum(sizes[by_id])])
    return build(ids[by_id], has_id[by_id], ends, ranks[order], values[order], weights)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """``SHARD`` rows at a time; the last ones may be fewer."""
    parts, held = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, SHARD - held)
            batch = batch.slice(part.num_rows)
            parts.append(part)
            held += part.num_rows
            if held == SHARD:
                yield parts
                parts, held = [], 0
    if held:
        yield parts


def _asked(
    rows: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], rank: np.ndarray, weights: np.ndarray,
    n_docs: int, length: int, k: int, least: dict[int, int],
) -> DataFrame:
    """``q, doc_id, score``: up to ``k`` documents of every shard of ``rows`` (``counted``) for each query.

    ``rank`` renumbers the vocabulary, ``weights`` go by rank. A task cuts its own rows into shards, one of
    which is in memory at a time, so nothing is shuffled and no index goes through the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(weights), np.int64)
        for parts in _shards(batches):
            shard = _shard(parts, rank, weights, n_docs, length)
            q, docs, scores = [], [], []
            for number, terms, own in queries:
                found, score = search(shard, terms, own, k, least.get(number, 1), vector)
                q.append(np.full(len(found), number))
                docs.append(found)
                scores.append(score)
            docs = np.concatenate(docs)
            ids = pa.array(shard.ids[docs], mask=~shard.has_id[docs])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q)), ids, pa.array(np.concatenate(scores))], ["q", "doc_id", "score"])

    return rows.where(F.size("terms") > 0).mapInArrow(run, "q bigint, doc_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(docs: DataFrame, items: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """Best documents of ``items`` (q, terms), whose terms fit one index."""
    words = [r["term"] for r in items.select(F.explode("terms").alias("term")).distinct().sort("term").collect()]
    vocabulary = [w.encode() for w in words]
    rows = staged(counted(docs, vocabulary, doc_id, text), "counted")
    size = rows.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    df = np.zeros(len(words), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    order = np.argsort(df, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    weights = np.array([weight(size["n"], d) for d in df[order].tolist()], np.int64)
    index = rank, weights, size["n"], size["length"] or 1, k
    number = {w: int(rank[i]) for i, w in enumerate(words)}
    packs = -(-items.count() // PACK)
    found = None
    for pack in range(packs):
        queries = []
        for r in items.where(F.pmod(F.xxhash64("q"), F.lit(packs)) == pack).select("q", "terms").collect():
            own = np.unique([number[t] for t in r["terms"]])
            own = own[weights[own] > 0]
            queries.append((r["q"], own, weights[own]))
        lot = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(FIRST))
        first = staged(_best(_asked(rows.where(lot == 0), queries, *index, {}), k).drop("rank"), "first")
        kth = first.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") == k)
        rest = _asked(rows.where(lot != 0), queries, *index, {r["q"]: r["score"] for r in kth.collect()})
        both = first.unionByName(rest)
        found = both if found is None else found.unionByName(both)
    return found


def ranked(
    docs: DataFrame, items: DataFrame, *, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents with the highest score above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, only A-Z lower-cased; a
    null text has none. Equal scores go by ascending doc_id, null last; rows that repeat a doc_id are
    ranked one by one. Items without a term find nothing; different texts under one item_id ask on their
    own, equal rows once. Without documents there are no rows. Other columns are ignored.

    Documents are read once: each keeps its length and the terms that any item asks for. Shards of
    ``SHARD`` documents hold a forward index and, per term, blocks of similar documents with
    coordinatewise highest impacts; all products are whole numbers, so a block is left out only when no
    document in it can reach the kth score. One document in ``FIRST`` is searched first, and the
    kth scores found there hold for the others. Each shard is indexed once for ``PACK`` items. Items are
    taken by lots whose terms fit ``TERMS``; only they, their terms' frequencies and one score per item
    pass the driver.
    """
    own = items.select(F.col(item_id).alias("item_id"), distinct_terms(F.col(item_text).cast("string")).alias("terms"))
    own = staged(own.where(F.size("terms") > 0).distinct().withColumn("q", F.monotonically_increasing_id()), "items")
    out, lots, n = None, 1, own.count()
    lot = F.pmod(F.xxhash64("q"), F.lit(lots))
    while lots < n:  # as many lots as leave each few enough terms
        lot = F.pmod(F.xxhash64("q"), F.lit(lots))
        most = own.select(lot.alias("lot"), F.explode("terms").alias("term")).distinct().groupBy("lot").count().agg(F.max("count")).first()[0]
        if most <= TERMS:
            break
        lots *= 2
    for i in range(lots):
        part = own.where(lot == i)
        if part.isEmpty():
            continue
        found = _searched(docs, part, k, doc_id, text)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "q bigint, doc_id bigint, score bigint")
    names = own.select("q", "item_id")
    return _best(out, k).join(names, "q").select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT doc_id, len(terms) AS n, terms, count(*) OVER () AS docs, sum(len(terms)) OVER () AS length FROM d WHERE len(terms) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
e AS (SELECT doc_id, n, docs, length, unnest(terms) AS term FROM s),
p AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n, any_value(docs) AS docs, any_value(length) AS length
  FROM e WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p GROUP BY term),
i AS (
  SELECT doc_id, term, CAST((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)) AS BIGINT) AS impact FROM p),
r AS (
  SELECT item_id, doc_id, CAST(sum(weight * impact) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN i USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 50
"""
