import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from queuelog.llm import lexical

DOCS = "doc_id bigint, text string, n bigint, terms int, q string, shard int, score bigint"
ITEMS = "item_id bigint, text string, q int, terms string"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split(text):
    return re.findall(TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    docs = [(d, Counter(split(t))) for d, t in docs]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(split(text)) if t in c)
            if s > 0:
                scores.append((-s, math.inf if d is None else d))
        out += [(item, i + 1, None if d == math.inf else d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def corpus(n, seed=1):
    r = random.Random(seed)
    word = lambda: f"w{min(int(r.paretovariate(0.6)), 400)}"
    texts = [" ".join(word() for _ in range(r.choice([1, 5, 30, 60]))) for _ in range(n)]
    texts += [None, "", " .,! ", "Über-Größe é naïve w1 W1", "w2 " * 5000, "w1 w2 w3 " * 20_000] + texts[:20] * 3
    rows = list(enumerate(texts)) + [(None, "w1 w2 w9"), (None, "w1 w2 w9"), (3, "w3 w4"), (3, texts[3])]
    items = [(i, " ".join(word() for _ in range(r.choice([1, 3, 20])))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "nowhere"), (54, "ÜBER über É"), (54, "w5"), (0, items[0][1]), (None, "w7 w8")]
    return rows, items


@pytest.mark.parametrize("shard, block, first, k, terms, pack", [(8192, 64, 16, 50, 1 << 18, 4096), (50, 4, 2, 3, 1 << 18, 7), (300, 8, 3, 10, 40, 4096)])
def test_against_brute_force(spark, monkeypatch, shard, block, first, k, terms, pack):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("FIRST", first), ("TERMS", terms), ("PACK", pack)):
        monkeypatch.setattr(lexical, name, value)
    rows, items = corpus(600)
    docs = spark.createDataFrame([(i, t, 1, 2, "q", 3, 4) for i, t in rows], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1, "t") for i, t in items], ITEMS)
    got = lexical.ranked(docs, asked, k=k).collect()
    want = brute(rows, items, k)
    assert sorted(map(tuple, got), key=str) == want


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "word", 1, "t")], ITEMS)
    some = spark.createDataFrame([(1, "word", 1, 2, "q", 3, 4)], DOCS)
    assert lexical.ranked(docs, items).count() == lexical.ranked(docs, one).count() == lexical.ranked(some, items).count() == 0


def test_summaries_bound_every_score_and_blocks_are_skipped():
    r = np.random.default_rng(4)
    n, size = 3000, 300
    lists = [np.unique(np.minimum(r.zipf(1.3, 20), size) - 1) for _ in range(n)]
    # documents of a topic share terms, so that blocks differ
    lists = [np.unique(np.concatenate([own, r.integers(0, 15, 5) + 15 * (i % 20)])) for i, own in enumerate(lists)]
    ends = np.concatenate([[0], np.cumsum(list(map(len, lists)))])
    df = np.bincount(np.concatenate(lists), minlength=size)
    rank = np.empty(size, int)
    rank[np.argsort(df, kind="stable")] = np.arange(size)
    terms = np.concatenate([np.sort(rank[own]) for own in lists])
    values = r.integers(1, 10**6, len(terms))
    weights = np.array([lexical.weight(n, int(d)) for d in np.sort(df)], np.int64)
    shard = lexical.build(np.arange(n), np.ones(n, bool), ends, terms, values, weights)
    assert len(shard.members) == len(terms)
    dense = np.zeros((n, size), np.int64)
    dense[np.repeat(np.arange(n), np.diff(ends)), terms] = values
    for b, t in enumerate(shard.block_terms):
        own = shard.members[shard.block_ends[b] : shard.block_ends[b + 1]]
        summary = np.zeros(size, np.int64)
        at = slice(shard.summary_ends[b], shard.summary_ends[b + 1])
        summary[shard.summary_terms[at]] = shard.summary_values[at]
        assert (summary[t:] == dense[own, t:].max(0)).all() and (dense[own, t] > 0).all()
    vector, looked = np.zeros(size, np.int64), 0
    for _ in range(40):
        q = np.unique(r.integers(0, size, 8))
        scores = dense[:, q] @ weights[q]
        best = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:5]
        docs, found = lexical.search(shard, q, weights[q], 5, 1, vector)
        assert sorted(zip((-found).tolist(), docs.tolist())) == best and not vector.any()
        kth = -best[-1][0] if len(best) == 5 else 1
        again, found = lexical.search(shard, q, weights[q], 5, kth, vector)
        assert sorted(zip((-found).tolist(), again.tolist())) == best
        if len(best) == 5:
            assert not len(lexical.search(shard, q, weights[q], 5, -best[0][0] + 1, vector)[0])
