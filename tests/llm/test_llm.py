import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
import check
import corpus_pipeline
from queuelog.llm import boilerplate, common, covertree, language, mixing, passages, pieces, quality, queries, shingles, simhash, topk, transducer, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, block bigint, fp string, _draw int"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty, blank and long texts, repeated rows, clashing names."""
    r = random.Random(1)
    passage = " ".join(r.choice("abcdefgh") + r.choice("xyz") for _ in range(40))
    long = " ".join(r.choice("qwertzuiop") * r.randint(1, 5) for _ in range(30_000))
    texts = [None, "", " \t\n ", passage, f"Intro {passage} end", passage, "x" * 5000, long, long, "12 34 !!", "naïve café über\nline\n\nline", "line\nother"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None, 7, "f", 1) for i, t in enumerate(texts)]
    rows += [(None, passage, "de", None, 1, None, None, None), (3, passage, "en", "s", 2, 1, "g", 0), (3, passage, "en", "s", 2, 1, "g", 0)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, db, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), db.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.normal(got) == check.normal(want)


def brute_passages(rows):
    words = [(math.inf if d is None else d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, math.inf), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((None if d == math.inf else d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block, shard", [(8 << 20, 30_000), (500, 3)])
def test_passages(odd, monkeypatch, block, shard):
    monkeypatch.setattr(passages, "BLOCK_BYTES", block)
    monkeypatch.setattr(passages, "SHARD", shard)
    got = passages.drop_passages(odd).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_passages([(r.doc_id, r.text) for r in odd.collect()])


def test_passages_negative_ids_and_empty(spark, none):
    text = " ".join(map(str, range(20)))
    rows = spark.createDataFrame([(-5, text), (2, text)], "doc_id bigint, text string")
    assert {r.doc_id: r.n_removed for r in passages.drop_passages(rows).collect()} == {-5: 0, 2: 20}
    assert passages.drop_passages(none).count() == 0


def brute_fingerprint(text, shingle=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(common.WORD, low)
    grams = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def linked(nodes, near):
    root = {n: n for n in nodes}
    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in itertools.combinations(nodes, 2):
        if near(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def test_simhash(spark, odd, none):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(odd).collect()}
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in odd.collect()]
    root = linked({f for _, f in rows}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root[f]] = min(least.get(root[f], math.inf), d)
    assert got == {(d, f"{f:016x}"): least[root[f]] for d, f in rows}
    assert simhash.near_duplicates(none).count() == 0


def test_pigeonring_finds_every_link(spark):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for flips in range(1, 6):
            fps.add(b ^ sum(1 << int(i) for i in r.choice(64, flips, replace=False)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.links(spark.createDataFrame(signed, "fp bigint"), 4).collect()
    root = linked({f for (f,) in signed}, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    got = linked({f for (f,) in signed}, lambda a, b, s={frozenset(x) for x in links}: frozenset((a, b)) in s)
    assert got == root


def brute_grams(text, shingle=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()


def brute_jaccard(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b)


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_shingle_sets_are_joined_exactly(spark, odd, none, monkeypatch, block):
    """All pairs at four fifths and no other: short and long texts, one edit and many, in one block or several."""
    monkeypatch.setattr(shingles, "BLOCK", block)
    r = random.Random(2)
    rows = [(r.doc_id, r.text) for r in odd.where("length(text) < 10000 or text is null").collect()]
    for n in [*range(1, 30), *range(30, 400, 15)]:
        base = [f"w{r.randrange(5000)}" for _ in range(n)]
        for copies in range(6):
            rows.append((r.randrange(10_000), " ".join(base)))
            at = r.randrange(len(base) + 1)
            base[at : at + r.randint(0, 1 + n // 40)] = [f"n{r.randrange(5000)}" for _ in range(r.randint(0, 1 + n // 40))]
            base = base or ["w"]
    grams = [brute_grams(t) for _, t in rows]
    root = linked(range(len(rows)), lambda a, b: brute_jaccard(grams[a], grams[b]))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(least.get(root[i], math.inf), d)
    want = sorted(((d, least.get(root[i])) for i, (d, _) in enumerate(rows)), key=str)
    got = shingles.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert shingles.similar_documents(none).count() == 0


def test_pipeline_drops_pairs_at_four_fifths_and_no_other(spark):
    r = random.Random(12)
    rows, drops = [], set()
    for i in range(120):
        words = [f"{i}x{k}" for k in range(r.randint(60, 300))]
        copy, pairs = list(words), []
        while not pairs or pairs[-1][0] > 0.7:
            copy[r.randrange(len(copy))] = f"{i}y{len(pairs)}"
            a, b = brute_grams(" ".join(words)), brute_grams(" ".join(copy))
            pairs.append((len(a & b) / len(a | b), " ".join(copy)))
        above = [t for j, t in pairs if j >= 0.8]
        below = [t for j, t in pairs if j < 0.8]
        near = i % 2 == 0 and above
        rows += [(2 * i, " ".join(words), "s"), (2 * i + 1, above[-1] if near else below[0], "s")]
        drops |= {2 * i + 1} if near else set()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()}
    assert got == {d for d, _, _ in rows} - drops and len(drops) > 40


def test_lines(odd, none):
    got = boilerplate.drop_boilerplate(odd, ratio=0.1, min_pages=3)
    assert got.columns[: len(odd.columns)] == odd.columns and got.count() == odd.count()
    rows = got.where("text is null").collect()
    assert [(r.n_lines, r.n_dropped) for r in rows] == [(0, 0)]
    assert got.where("n_dropped > 0").count() >= 3
    assert boilerplate.drop_boilerplate(none).count() == 0


def test_mixing(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd).collect()))
    assert mixing.mix(none).count() == 0
    assert mixing.mixed(odd).columns == odd.columns
    docs = common.table(spark, SF, "documents")
    for r in mixing.mix(docs).groupBy("source_size", "target").agg({"taken": "sum", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r.target) <= r["max(size)"]
    taken = mixing.mixed(docs).select(mixing.n_words(docs.text).alias("n")).agg({"n": "sum"}).first()[0]
    assert taken == sum(r.taken for r in mixing.mix(docs).collect()) > 0


def test_topk(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0], "a"), (20, [1.0, 2.0], "b"), (1, [1.0, 2.0], "c"), (2, None, None), (3, [nan, 1.0], ""), (4, [None, 1.0], "d"), (None, [9.0, 9.0], "e"), (5, [-0.5, 0.01], "f"), (6, [3.0], "g"), (1, [1.0, 2.0], "c"), (7, [], "h")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, part string")
    got = [tuple(r) for r in topk.top_k(df, df.vec_id % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    full = 64 * 64 + 128 * 128
    assert got == [(0, 1, 1, full), (0, 2, 1, full), (0, 3, 20, full), (20, 1, 0, full), (20, 2, 1, full), (20, 3, 1, full)]
    assert topk.top_k(df.limit(0), df.vec_id % 20 == 0).count() == 0


def test_topk_blocks(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    r = np.random.default_rng(5)
    data, q = r.integers(-9, 9, (100, 6)).astype(float), r.integers(-9, 9, (9, 6)).astype(float)
    query, ids, score = topk.search(np.arange(9), q, np.arange(100), data, 5)
    for i in range(9):
        s = data @ q[i]
        want = sorted((-int(s[j]), j) for j in range(100) if j != i)[:5]
        assert sorted((-int(b), int(a)) for a, b in zip(ids[query == i], score[query == i])) == want


def test_warc(spark, tmp_path):
    rows = [(1, "http://a", "x" * 10), (2, None, "x" * 10), (3, "u\r\nv", None), (4, "http://d", ""), (None, "http://e", "é"), (2, None, "x" * 10), (5, "http://f", "\x1f\x8b\x08" + "z" * 300_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = f"{tmp_path}/w"
    manifest = warc.write_archives(df.repartition(2), folder)
    got = warc.read_archives(manifest, folder, range_bytes=101).collect()
    found = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str)
    assert found == sorted([(1, 10, "revisit", 2), (2, 10, "response", None), (2, 10, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (None, 2, "response", None), (5, 300_004, "response", None)], key=str)
    assert {bytes(r.payload) for r in got if r.page_id == 5} == {rows[-1][2].encode()}
    assert warc.read_archives(warc.write_archives(df.limit(0), folder), folder).count() == 0


def test_covertree(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.99, 0.05], 1), (4, [1.0, 0.0], 2), (5, [0.0, 0.0], 1), (6, None, 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, 0.0], None), (10, [2.0, 0.0], 1), (11, [1.0, None], 1), (12, [1.0], 1), (None, [0.0, 1.0], 1), (2, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in covertree.near_vectors(df).collect()}
    alone = {(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 11, 12)}
    assert got == alone | {(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (10, 4, 1, False), (None, 0, None, True)}
    assert covertree.near_vectors(df.limit(0)).count() == 0


def test_covertree_splits(spark, monkeypatch):
    monkeypatch.setattr(covertree, "NODE", 20)
    monkeypatch.setattr(covertree, "BLOCK", 16)
    r = np.random.default_rng(2)
    centers = r.normal(size=(12, 8))
    v = np.concatenate([centers[r.integers(0, 12, 150)] + 0.25 * r.normal(size=(150, 8)), r.normal(size=(50, 8))])
    labels = r.integers(0, 2, 200)
    df = spark.createDataFrame([(i, v[i].tolist(), int(labels[i])) for i in range(200)], "vec_id bigint, embedding array<double>, label int")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (labels[:, None] == labels[None, :]) & ~np.eye(200, dtype=bool)
    root = linked(range(200), lambda a, b: near[a, b])
    got = {r.vec_id: (r.n_links, r.component_id) for r in covertree.near_vectors(df).collect()}
    assert got == {i: (int(near[i].sum()), root[i]) for i in range(200)}


def brute_probability(lattices, word, p):
    """Sum over all segmentations, one by one."""
    if not word:
        return 1.0
    return sum(p[lattices.ids[word[:n]]] * brute_probability(lattices, word[n:], p) for n in range(1, len(word) + 1) if word[:n] in lattices.ids)


def test_segmentations_are_summed():
    lattices = language.Lattices(pieces.MODEL)
    logp = np.log(np.random.default_rng(1).dirichlet(np.ones(lattices.size), 2).T)
    scorer = language.Scorer(pieces.MODEL, logp)
    for word in ("the", "station", "ab"):
        want = [math.log(brute_probability(lattices, pieces.SPACE + word, np.exp(logp[:, g]))) for g in range(2)]
        assert np.allclose(scorer.texts([[word]])[0], want)
        assert np.allclose(language.score_long(lattices, pieces.SPACE + word, logp), want)
    long = "ab中" * 30
    assert np.allclose(scorer.texts([[long, "the"]])[0], language.score_long(lattices, pieces.SPACE + long, logp) + scorer.texts([["the"]])[0])


def test_language(spark, odd, none):
    rows = [tuple(r) for r in language.identify(odd, *language.fit(odd)).select("text", "lang_pred", "score").collect()]
    assert len(rows) == odd.count()
    assert all((p == "und" and s == 0) == (not t or not re.search(r"[^\W\d_]", t)) and 0 <= s <= 1 for t, p, s in rows)
    assert language.identify(none, *language.fit(none)).count() == 0
    got = queries.QUERIES["op7_language"](spark, SF).toPandas().merge(common.table(spark, SF, "documents").select("doc_id", "lang").toPandas())
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got[got.held_out].lang == got[got.held_out].lang_pred).mean() > 0.9


def test_quality(spark, odd, none):
    scores = [r.score for r in quality.quality(odd, odd.select("doc_id").where("doc_id in (3, 4)")).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert {r.score for r in quality.quality(odd, odd.select("doc_id").limit(0)).collect()} == {0.5}
    assert quality.quality(none, odd.select("doc_id")).count() == 0
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op8_quality"](spark, sf).toPandas().merge(common.table(spark, sf, "labels").toPandas())
    got = got[got.held_out]
    assert (got.predicted == got.quality).mean() > 0.85


def test_pieces(spark, odd, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = transducer.decode(transducer.encode(odd)).collect()
    assert all(r.ids == (None if r.text is None else model.encode(r.text)) and r.decoded == r.text for r in rows)
    assert transducer.decode(transducer.encode(none)).count() == 0
    machine, r = transducer.Transducer(), random.Random(4)
    for _ in range(2000):
        text = "".join(r.choice("aeiostrn lhd  \n\tXQ.,é▁中😀0123<>/s") for _ in range(r.randint(0, 30)))
        assert machine.encode(text).tolist() == model.encode(text)


def test_pieces_checked_in_one_pass(spark, odd, none):
    both = transducer.decode(transducer.encode(odd)).collect()
    got = transducer.encode_and_check(odd).collect()
    key = lambda r: (str(r.doc_id), r.ids or [])
    assert sorted(map(key, got)) == sorted(map(key, both))
    want = sorted((str(r.doc_id), r.decoded == r.text) for r in both)
    assert sorted((str(r.doc_id), r.round_trip) for r in got) == want
    assert "text" not in got[0] and transducer.encode_and_check(none).count() == 0


def test_components(spark):
    r = random.Random(7)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(r.randint(0, 50), r.randint(0, 50)) for _ in range(30)] + [(900, i) for i in range(901, 930)]
    nodes = sorted({n for p in pairs for n in p if p[0] != p[1]})
    want = linked(nodes, lambda a, b, s={frozenset(p) for p in pairs}: frozenset((a, b)) in s)
    got = common.components(spark.createDataFrame(pairs, "a bigint, b bigint").repartition(5)).collect()
    assert dict(map(tuple, got)) == want and len(got) == len(want)


@pytest.mark.parametrize("seed", range(5))
def test_components_of_paths(spark, seed):
    """Tasks that can contract nothing: every link of a path lies in a task of its own."""
    r, paths = random.Random(seed), []
    for i in range([0, 1, 1, 2, 40][seed]):
        paths.append([100 * i + n for n in r.sample(range(100), r.randint(5, 12))])
    tasks = [[p[i : i + 2] for p in paths if i + 1 < len(p)] for i in range(11)]
    if not seed:
        tasks = [[(5, 1), (4, 3)], [(5, 4), (3, 2)]]
    links = spark.sparkContext.parallelize(tasks, len(tasks)).flatMap(lambda task: [tuple(p) for p in task])
    got = common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    pairs = {frozenset(p) for task in tasks for p in task}
    want = linked(sorted(set().union(*pairs)), lambda a, b: frozenset((a, b)) in pairs)
    assert dict(map(tuple, got)) == want and len(got) == len(want)


def test_pipeline(spark):
    docs = common.table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language"](spark, docs, SF)
    assert known.columns == docs.columns
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    lines = common.staged(stages["lines"](spark, known, SF), "lines")
    one = common.staged(stages["near_duplicates"](spark, lines, SF), "one")
    grams = {r.doc_id: brute_grams(r.text) for r in lines.collect()}
    root = linked(sorted(grams), lambda a, b: brute_jaccard(grams[a], grams[b]))
    assert {r.doc_id for r in one.collect()} == set(root.values()) and one.columns == docs.columns
    mix = stages["mix"](spark, one, SF)
    assert mix.columns == docs.columns
    assert corpus_pipeline.run(spark, SF).count() == mix.count()
