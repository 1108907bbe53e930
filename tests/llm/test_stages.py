"""Stages of the pipeline, and what they call, on odd rows and against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from queuelog.llm import language, mixing, pieces

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdeilnorst") for _ in range(r.randint(1, 8)))
    texts = [" ".join(word() for _ in range(r.choice([1, 6, 40, 200]))) for _ in range(60)]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(None, texts[0], "en", None, 1), (None, texts[1] + " more", None, None, None), (None, None, None, None, None)]
    rows += [(7, "another text under the same id", "en", "s1", 5), (7, "and a third one there, unlike both", "en", "s1", 5)]
    rows += [rows[3], rows[3], (100, None, "en", "s", 1), (101, "", "en", "s", 0), (102, " \t", "en", "s", 1), (103, "long " * 50_000, "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def shown(rows):
    return sorted((str(tuple(r)) for r in rows.collect()))


def test_one_document_of_each_group(spark, odd):
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = stage(spark, odd, "")
    assert got.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    grams = [brute_grams(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:  # as many rounds as a chain can be long
        for i, j in ((i, j) for i in range(len(rows)) for j in range(i)):
            if grams[i] == grams[j] or 10 * len(grams[i] & grams[j]) >= 8 * len(grams[i] | grams[j]):
                root[i] = root[j] = min(root[i], root[j])
        if all(root[root[i]] == root[i] for i in range(len(rows))):
            break
    assert len(kept) == len(set(root))
    for group in set(root):
        ids = [d for (d, _), g in zip(rows, root) if g == group]
        least = min((d for d in ids if d is not None), default=None)
        texts = [t for (d, t), g in zip(rows, root) if g == group and d == least]
        assert sum((d, t) == (least, u) for d, t in kept for u in set(texts)) == 1
    # three texts under one id are three documents
    assert sum(d == 7 for d, _ in kept) == 3


def brute_grams(text, shingle=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))) if w else frozenset()


def test_mixed_takes_what_the_mix_says(spark, odd):
    """Repeated ids, and rows without one, are neither lost nor taken too often."""
    def sizes(rows):
        return Counter((r["doc_id"], r["size"]) for r in rows for _ in range(r["copies"]))

    for docs in (odd, spark.createDataFrame([(None if i < 50 else i, f"a b c{i}", "en", "s", 1) for i in range(100)], DOCS)):
        want = sizes(mixing.mix(docs).collect())
        got = mixing.mixed(docs)
        assert got.columns == docs.columns
        assert Counter((r["doc_id"], r["size"]) for r in got.select("doc_id", mixing.n_words(got.text).alias("size")).collect()) == want
        most = max(Counter(map(tuple, got.collect())).values())
        per = max(Counter(tuple(r) for r in docs.collect()).values())
        assert most <= 3 * per
    assert mixing.mixed(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    none = stage(spark, odd.limit(0), "")
    assert none.count() == 0
    got = stage(spark, odd, "")
    assert none.columns == got.columns
    if name != "pieces":
        assert got.columns == odd.columns
    else:
        assert got.count() == odd.count() and all(r.round_trip for r in got.collect())
    if name == "mix":
        assert shown(got) == shown(stage(spark, odd, ""))


def test_run_on_odd_tables(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() > 0
    odd.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def segmentations(lattices, word):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in lattices.ids:
            for rest in segmentations(lattices, word[n:]):
                yield [lattices.ids[word[:n]], *rest]


def test_expected_uses_against_every_segmentation():
    lattices = language.lattices_of(pieces.MODEL)
    logp = np.log(np.random.default_rng(8).dirichlet(np.ones(lattices.size), 2).T)
    words, counts, lang = ["▁the", "▁stone", "tion", "▁ab", "▁the"], np.array([3, 1, 4, 2, 5]), np.array([0, 1, 0, 1, 1])
    want = np.zeros(logp.shape)
    for word, c, g in zip(words, counts.tolist(), lang.tolist()):
        all_ = list(segmentations(lattices, word))
        p = np.array([math.exp(logp[s, g].sum()) for s in all_])
        for s, w in zip(all_, p / p.sum()):
            np.add.at(want[:, g], s, c * w)
    assert np.allclose(language.expected(lattices, words, counts, lang, logp), want)


def test_scripts_without_spaces_are_learned(spark):
    """Runs longer than any word count too, cut into pieces."""
    r = random.Random(1)
    text = lambda letters: " ".join("".join(r.choice(letters) for _ in range(60)) for _ in range(5))
    rows = [(i, text("日本語人一大中" if i % 2 else "가나다라마바사"), "ja" if i % 2 else "ko") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = language.identify(docs, *language.fit(docs)).collect()
    assert sum(r.lang == r.lang_pred for r in got) == 40


def test_the_sample_is_bounded_by_hash(spark):
    """With more documents than the sample, so many are read of each language, and the same ones each time."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('word', id % 50) AS text", "if(id % 3 = 0, 'a', 'b') AS lang")
    first, second = language.fit(docs, sample=100, rounds=1), language.fit(docs.repartition(7), sample=100, rounds=1)
    assert first[0] == second[0] == ["a", "b"] and np.allclose(first[1], second[1])


def test_long_words_have_the_same_score():
    lattices = language.lattices_of(pieces.MODEL)
    logp = np.log(np.random.default_rng(3).dirichlet(np.ones(lattices.size), 3).T)
    word = pieces.SPACE + "".join(random.Random(4).choice("abcnt中éß") for _ in range(70))
    edges, rare = lattices.edges([word])
    alpha = language.forward(edges, np.exp(lattices.table(logp, rare)[edges[3]]), 1, len(word))
    assert np.allclose(language.score_long(lattices, word, logp), np.log(alpha[0, len(word)]))
