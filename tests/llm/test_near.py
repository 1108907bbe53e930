"""The pipeline's near-duplicates begin with the fingerprints of operator 2."""

import random
from fractions import Fraction

import numpy as np

import corpus_pipeline
from queuelog.llm import shingles


def test_copies_are_found_by_fingerprints(spark, monkeypatch):
    """Without any shingle key, copies with a changed word are still linked, and links are confirmed."""
    monkeypatch.setattr(shingles, "_keyed", lambda docs, *_: docs.sparkSession.createDataFrame([], "key bigint, node bigint"))
    r, rows = random.Random(3), []
    for i in range(6):
        words = [f"{i}x{r.randrange(10**6)}" for _ in range(2000)]
        rows.append((2 * i, " ".join(words), "s"))
        words[r.randrange(2000)] = "other"
        rows.append((2 * i + 1, " ".join(words), "s"))
    rows += [(50, "", "s"), (51, None, "s"), (52, "a b", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()}
    assert got == {0, 2, 4, 6, 8, 10, 50, 52}


def test_a_shared_passage_makes_no_candidates(spark, monkeypatch):
    """Texts that share a fifth of their words with the next one are not compared; near copies still are."""
    compared, plain = [], shingles._confirmed

    def confirmed(texts, *options):
        compared.extend(r.node for r in texts.select("node").collect())
        return plain(texts, *options)

    monkeypatch.setattr(shingles, "_confirmed", confirmed)
    r, rows, tail = random.Random(5), [], []
    word = lambda: f"w{r.randrange(10**9)}"
    for i in range(40):
        words = [*tail, *(word() for _ in range(500 - len(tail)))]
        tail = words[-100:]
        rows.append((i, " ".join(words), "s"))
    copy = rows[7][1].split()
    copy[50::60] = [word() for _ in copy[50::60]]  # 8 words, so 40 of 496 shingles
    rows.append((90, " ".join(copy), "s"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect()}
    assert got == set(range(40))
    assert set(compared) == {shingles.set_id(shingles.shingle_set(rows[i][1].encode(), 5)) for i in (7, 40)}


def test_similar_sets_share_the_keys_they_need():
    """Sets at the bound, and around it, in every class they have in common."""
    least, r = Fraction("0.8"), np.random.default_rng(4)
    classes = shingles.Classes(least)
    for _ in range(3000):
        a = int(r.integers(1, 400))
        b = int(r.integers(a, a * 5 // 4 + 1))
        common = -(-4 * (a + b) // 9)  # the fewest that make them similar
        if common > a or a + b == 2 * common:
            continue
        names = r.integers(0, 1 << 63, a + b - common).astype(np.uint64)
        sets = [np.unique(names[:a]), np.unique(names[a - common :])]
        keys = [dict(classes.keys(s)) for s in sets]
        needs = [dict(zip(classes.met(len(s)), classes.needs(s))) for s in sets]
        number = classes.of(a)
        if not classes.differ(number):
            continue
        shared = len(np.intersect1d(keys[0][number], keys[1][number]))
        assert shared >= max(needs[0][number], needs[1][number])


def test_shared_keys_across_batches(spark):
    """Repeated rows are one; a key may go over several batches."""
    r = random.Random(2)
    rows = [(r.randrange(60), r.randrange(9)) for _ in range(400)] + [(1000, 1)] * 5 + [(1001, i) for i in range(30)]
    by_key = {}
    for key, node in rows:
        by_key.setdefault(key, set()).add(node)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("1", "7", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            got = shingles._shared(spark.createDataFrame(rows, "key bigint, node bigint")).collect()
            assert sorted(map(tuple, got)) == sorted((k, n) for k, ns in by_key.items() if len(ns) > 1 for n in ns)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
