"""Substring deduplication: recurring phrases, sharded Aho-Corasick automata, every occurrence."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelog.llm.common import rows_of, table

#: Words of a window and of an anchor within it; bytes of text in a block of documents.
WINDOW, ANCHOR, BLOCK_BYTES = 13, 5, 8 << 20
#: Phrases of one automaton.
SHARD = 30_000
NO_ID = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, n: int, factor: int) -> np.ndarray:
    """A hash of every ``n`` neighbouring values."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(factor) + values[i : len(values) - n + 1 + i]
    return _mix(out)


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every ``n`` neighbouring values."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


class _Numbers(dict):
    """Numbers words in the order they are asked for."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.fresh.append(word)
        self[word] = n = len(self)
        return n


class Words:
    """Numbers and hashes of words, given out as they come."""

    def __init__(self):
        self.number, self.hashes = _Numbers(), np.empty(0, np.uint64)

    def numbers(self, text: bytes | None) -> np.ndarray:
        words = text.split() if text else []
        out = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if fresh := self.number.fresh:
            own = np.fromiter(map(xxhash.xxh64_intdigest, fresh), np.uint64, len(fresh))
            self.hashes = np.concatenate([self.hashes, own])
            fresh.clear()
        return out

    def first(self, numbers: np.ndarray) -> np.ndarray:
        """64 bits of the hash of every window."""
        return rolling(self.hashes[numbers], WINDOW, 0x9E3779B97F4A7C15)

    def second(self, numbers: np.ndarray) -> np.ndarray:
        """32 more bits."""
        return rolling(self.hashes[numbers], WINDOW, 0xD6E8FEB86659FD93) >> np.uint64(32)

    def anchor(self, numbers: np.ndarray) -> np.ndarray:
        """The least hash of the phrases of ``ANCHOR`` words in every window; equal windows agree."""
        if len(numbers) < WINDOW:
            return np.empty(0, np.uint64)
        return least_of(rolling(self.hashes[numbers], ANCHOR, 0xC2B2AE3D27D4EB4F), WINDOW - ANCHOR + 1)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, anchor`` of every document, each anchor once."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            words, blocks, anchors = Words(), [], []
            part = batch.slice(at, 512)
            own = part.column(1).to_numpy()
            for i, text in enumerate(part.column(2).to_pylist()):
                found = np.unique(words.anchor(words.numbers(text)))
                anchors.append(found)
                blocks.append(np.full(len(found), own[i]))
            yield _batch(block=np.concatenate(blocks), anchor=np.concatenate(anchors).view(np.int64))


def _candidates(key: tuple, docs: pa.Table, anchors: pa.Table) -> pa.Table:
    """Windows of a block's documents whose anchor recurs, each once, with the smallest and, where it
    differs, the largest doc_id that has it here."""
    known, words = np.unique(anchors["anchor"].to_numpy().view(np.uint64)), Words()
    found = [(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))]
    for doc_id, text in _texts(docs):
        numbers = words.numbers(text)
        hit = np.flatnonzero(_isin(words.anchor(numbers), known))
        if len(hit):
            found.append((words.first(numbers)[hit], words.second(numbers)[hit], np.full(len(hit), doc_id, np.int64)))
    first, second, doc = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((doc, second, first))
    first, second, doc = first[order], second[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])) if len(doc) else np.empty(0, np.int64)
    last = np.concatenate([new[1:], [len(doc)]])[: len(new)] - 1
    also = last[doc[last] != doc[new]] if len(new) else new
    take = np.concatenate([new, also])
    return pa.table({
        "w": first[take].view(np.int64), "x": second[take].astype(np.int64), "doc_id": doc[take],
        "block": np.full(len(take), key[0].as_py(), np.int64),
    })


def _isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _texts(docs: pa.Table) -> Iterator[tuple[int, bytes | None]]:
    yield from rows_of(docs.select(["doc_id", "text"]).to_batches())


def _phrases(hit: np.ndarray) -> Iterator[int]:
    """Starts of windows that together cover all the windows marked in ``hit``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    for a, b in edges.reshape(-1, 2):
        yield from range(a, b - 1, WINDOW)
        yield b - 1


def spell(numbers: np.ndarray) -> str:
    """Word numbers as text of four characters each, the k-th from the k-th quarter of 256: so the
    nodes of an automaton have few branches, and a match begins where a word does."""
    digits = (numbers[:, None] >> np.array([0, 6, 12, 18])) & 63
    return (digits + np.array([0, 64, 128, 192])).astype(np.uint8).tobytes().decode("latin-1")


def locate(texts: list[tuple[int, str]], phrases: dict[str, int]) -> list[np.ndarray]:
    """Per text (doc_id, spelled words) which words lie in an occurrence of a phrase that belongs to a
    smaller doc_id. Phrases go into automata of ``SHARD``; every text streams through each."""
    covered = [np.zeros(len(text) // 4 + 1, np.int64) for _, text in texts]
    todo = list(phrases.items())
    for at in range(0, len(todo), SHARD):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, (phrase, _) in enumerate(todo[at : at + SHARD], at):
            automaton.add_word(phrase, i)
        automaton.make_automaton()
        for (doc_id, text), marks in zip(texts, covered):
            for end, i in automaton.iter(text):
                if todo[i][1] < doc_id:
                    marks[(end + 1) // 4 - WINDOW] += 1
                    marks[(end + 1) // 4] -= 1
    return [np.cumsum(marks[:-1]) > 0 for marks in covered]


def _remove(docs: pa.Table, recurring: pa.Table) -> pa.Table:
    """The block's documents without the words that recurring phrases cover.

    Phrases are cut where a confirmed window stands in the block, so the automata compare whole words,
    not hashes; a phrase belongs to the smallest doc_id of all documents that has it.
    """
    known, first = recurring["w"].to_numpy(), recurring["first"].to_numpy()
    order = np.argsort(known.view(np.uint64))
    known, first = known.view(np.uint64)[order], first[order]
    words, texts, spelled, phrases = Words(), [], [], {}
    for doc_id, text in _texts(docs):
        numbers = words.numbers(text)
        texts.append((doc_id, numbers))
        spelled.append((doc_id, spell(numbers)))
        window = words.first(numbers)
        if not len(window) or not len(known):
            continue
        at = np.minimum(np.searchsorted(known, window), len(known) - 1)
        for a in _phrases((known[at] == window) & (first[at] < doc_id)):
            phrase = spelled[-1][1][4 * a : 4 * (a + WINDOW)]
            phrases[phrase] = min(phrases.get(phrase, NO_ID), int(first[at[a]]))
    out = {"n_words": [], "n_removed": [], "kept": []}
    names = list(words.number)
    for (_, numbers), gone in zip(texts, locate(spelled, phrases)):
        kept = b" ".join(map(names.__getitem__, numbers[~gone].tolist()))
        out["n_words"].append(len(numbers))
        out["n_removed"].append(int(gone.sum()))
        out["kept"].append(kept)
    ids = pa.array([None if d == NO_ID else d for d, _ in texts], pa.int64())
    n, gone, kept = pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), out["kept"]
    digest = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
    return pa.table({"doc_id": ids, "n_words": n, "n_removed": gone, "kept_sha256": digest, "kept": pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())})


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def drop_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs``.

    Words are runs of non-space characters. A word goes if it lies in a window of ``WINDOW`` words
    whose sequence also starts in a document with a smaller doc_id; windows are those of the input.
    Null and short texts lose nothing. A row without doc_id counts as larger than all others, and rows
    with the same doc_id do not take words from each other. Other columns are ignored.

    1. Every window has an anchor, the phrase of ``ANCHOR`` words in it with the least hash, so about a
       fifth of the words send an anchor to the shuffle, and a window recurs only if its anchor does.
    2. Windows with a recurring anchor are confirmed by 96 bits of hash, combined per block of
       documents first; the smallest doc_id of all that has a window owns it.
    3. A block gets the confirmed windows that an earlier document owns, compiles the phrases into
       Aho-Corasick automata and streams all its documents through them.

    A passage in a third of all documents costs one row per block and window. The text is shuffled
    once, by block; nothing is collected.
    """
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id"), F.lit(size // BLOCK_BYTES + 1))
    rows = rows.select("doc_id", block.alias("block"), "text")
    anchors = rows.mapInArrow(_anchors, "block bigint, anchor bigint")
    several = F.count("*").over(Window.partitionBy("anchor"))
    shared = anchors.withColumn("n", several).where("n > 1").select("block", "anchor")
    blocks = rows.groupBy("block")
    found = blocks.cogroup(shared.groupBy("block")).applyInArrow(_candidates, "w bigint, x bigint, doc_id bigint, block bigint")
    window = Window.partitionBy("w", "x")
    found = found.withColumns({"first": F.min("doc_id").over(window)}).where("doc_id > first").select("block", "w", "first")
    return blocks.cogroup(found.groupBy("block")).applyInArrow(_remove, RESULT)


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_passages(table(spark, sf_dir, "documents")).drop("kept")


OP1_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
w AS (
  SELECT r, doc_id, p, array_to_string(words[p : p + 12], ' ') AS phrase
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM d)),
f AS (SELECT phrase, min(doc_id) AS first FROM w GROUP BY phrase),
g AS (
  SELECT DISTINCT r, p + unnest(range(0, 13)) AS p FROM w JOIN f USING (phrase) WHERE doc_id > first),
s AS (SELECT r, list(p) AS gone FROM g GROUP BY r),
k AS (
  SELECT d.doc_id, words, list_filter(words, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept
  FROM d LEFT JOIN s USING (r))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - len(kept) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
"""
