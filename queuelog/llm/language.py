"""Language identification: unigram piece models per language, all segmentations of a text summed."""

from __future__ import annotations

import functools
import itertools
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelog.llm import pieces
from queuelog.llm.common import held_out, kept, rows_of, staged, table

#: Labelled documents that are read per language to fit the models, and rounds of fitting.
SAMPLE, ROUNDS, SMOOTH = 1000, 4, 0.01
#: Words a task keeps scores of, words scored at a time, and the length from which a word goes alone.
CACHE, SLAB, LONG = 200_000, 20_000, 40
LETTER = re.compile(r"[^\W\d_]")
#: ASCII signs and digits, which say little about a language, are left out of words.
DROP = bytes(b for b in range(33, 127) if not chr(b).isalpha())


def words_of(text: str) -> list[str]:
    """Words of a text as the models see them: lower case, without ASCII signs and digits."""
    return text.lower().encode().translate(None, DROP).decode().split()


class Lattices:
    """Segmentations of words over the pieces of a vocabulary; a character without a piece stands for
    its UTF-8 bytes. Words are lower-cased and begin with the space mark, so no piece spans two."""

    def __init__(self, path: str):
        vocabulary = pieces.load(path)
        self.ids = {p: i for p, i in vocabulary.ids.items() if p == p.lower() and pieces.SPACE not in p[1:]}
        self.trie, self.bytes_, self.size = pieces.Trie(self.ids), vocabulary.bytes_, vocabulary.size
        self.alone = np.zeros(self.trie.size + 1, bool)  # characters that are pieces
        self.alone[[self.trie.letter[ord(p)] for p in self.ids if len(p) == 1]] = True

    def edges(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """Rows (word, from, to, piece) by word and start, and the characters without a piece; those
        have numbers from ``size`` on."""
        codes, sizes = pieces.codes_of("".join(words)), np.fromiter(map(len, words), np.int64, len(words))
        word, ends = np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes)
        letters = self.trie.letter[codes]
        start, end, piece = self.trie.arcs(letters, ends[word])
        raw = np.flatnonzero(~self.alone[letters])
        rare, number = np.unique(codes[raw], return_inverse=True)
        start, end, piece = np.concatenate([start, raw]), np.concatenate([end, raw + 1]), np.concatenate([piece, self.size + number])
        order = np.argsort(start, kind="stable")
        start, own = start[order], word[start[order]]
        first = (ends - sizes)[own]
        return np.array([own, start - first, end[order] - first, piece[order]], np.int64), [chr(c) for c in rare.tolist()]

    def table(self, logp: np.ndarray, rare: list[str]) -> np.ndarray:
        """Log-probabilities with rows for the characters without a piece."""
        extra = [logp[[self.bytes_[b] for b in c.encode("utf-8", "surrogatepass")]].sum(0) for c in rare]
        return np.vstack([logp, *extra]) if extra else logp


def _sums(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows with the same, already sorted, ``at``."""
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(values, first, axis=0)


def forward(edges: np.ndarray, prob: np.ndarray, n: int, length: int) -> np.ndarray:
    """alpha[word, position, ...]: sum over segmentations of the first characters. ``prob`` per edge."""
    order = np.argsort(edges[2], kind="stable")
    w, s, t, _ = edges[:, order]
    prob = prob[order]
    alpha = np.zeros((n, length + 1, prob.shape[1]))
    alpha[:, 0] = 1
    cuts = np.searchsorted(t, np.arange(1, length + 2))
    for at in range(1, length + 1):
        a, b = cuts[at - 1], cuts[at]
        if a < b:
            word, total = _sums(alpha[w[a:b], s[a:b]] * prob[a:b], w[a:b])
            alpha[word, at] = total
    return alpha


def backward(edges: np.ndarray, prob: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """beta[word, position]: sum over segmentations of what follows."""
    n, length = len(lengths), int(lengths.max())
    order = np.argsort(-edges[1], kind="stable")
    w, s, t, _ = edges[:, order]
    prob = prob[order]
    beta = np.zeros((n, length + 1))
    beta[np.arange(n), lengths] = 1
    cuts = np.searchsorted(-s, np.arange(-length, 2))
    for k in range(length + 1):
        a, b = cuts[k], cuts[k + 1]
        if a < b:
            word, total = _sums(prob[a:b] * beta[w[a:b], t[a:b]], w[a:b])
            beta[word, length - k] = total
    return beta


def score_long(lattices: Lattices, word: str, logp: np.ndarray) -> np.ndarray:
    """Log-probability of a long word: the same sums with a running scale, in bounded memory."""
    widest = max(map(len, lattices.ids))
    total, ring = np.zeros(logp.shape[1]), {0: np.ones(logp.shape[1])}
    for begin in range(0, len(word), SLAB):
        edges, rare = lattices.edges([word[begin : begin + SLAB + widest]])
        probs, ends = np.exp(lattices.table(logp, rare)[edges[3]]), (begin + edges[2]).tolist()
        cuts = np.searchsorted(edges[1], np.arange(SLAB + 1)).tolist()
        for at in range(begin, min(begin + SLAB, len(word))):
            here = ring.pop(at)
            top = here.max()
            total, here = total + math.log(top), here / top
            ring = {k: v / top for k, v in ring.items()}
            for k in range(cuts[at - begin], cuts[at - begin + 1]):
                ring[ends[k]] = ring.get(ends[k], 0) + here * probs[k]
    with np.errstate(divide="ignore"):
        return total + np.log(ring[len(word)])


@functools.lru_cache(1)
def lattices_of(path: str) -> Lattices:
    """One per process."""
    return Lattices(path)


class Scorer:
    """Log-probabilities of words under every language; those of recent words are kept."""

    def __init__(self, path: str, logp: np.ndarray):
        self.lattices, self.logp = lattices_of(path), logp
        self.reset()

    def reset(self) -> None:
        self.index, self.rows, self.used = {}, np.zeros((1024, self.logp.shape[1])), 0

    def _put(self, words: list[str], values: np.ndarray) -> None:
        while self.used + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used : self.used + len(words)] = values
        self.index.update(zip(words, range(self.used, self.used + len(words))))
        self.used += len(words)

    def learn(self, words: list[str]) -> None:
        marked = sorted((w for w in words if len(w) < LONG), key=len)
        for at in range(0, len(marked), SLAB):
            part = marked[at : at + SLAB]
            full = [pieces.SPACE + w for w in part]
            edges, rare = self.lattices.edges(full)
            prob = np.exp(self.lattices.table(self.logp, rare)[edges[3]])
            alpha = forward(edges, prob, len(full), len(full[-1]))
            ends = alpha[np.arange(len(full)), np.array(list(map(len, full)))]
            with np.errstate(divide="ignore"):
                self._put(part, np.maximum(np.log(ends), -700))
        for w in words:
            if len(w) >= LONG:
                self._put([w], score_long(self.lattices, pieces.SPACE + w, self.logp)[None])

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """Log-probability of each list of words, a row each."""
        if self.used > CACHE:
            self.reset()
        missing = set(itertools.chain.from_iterable(texts)).difference(self.index)
        if missing:
            self.learn(list(missing))
        out, get = np.zeros((len(texts), self.logp.shape[1])), self.index.__getitem__
        for i, words in enumerate(texts):
            if words:
                out[i] = self.rows[np.fromiter(map(get, words), np.int64, len(words))].sum(0)
        return out


def expected(lattices: Lattices, words: list[str], counts: np.ndarray, lang: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Expected uses of every piece per language over all segmentations of ``words``, marks included."""
    out = np.zeros(logp.shape)
    order = np.argsort(np.array(list(map(len, words))), kind="stable")
    for at in range(0, len(order), SLAB):
        part = order[at : at + SLAB]
        full = [words[i] for i in part]
        g, c, lengths = lang[part], counts[part], np.array(list(map(len, full)))
        edges, rare = lattices.edges(full)
        prob = np.exp(lattices.table(logp, rare)[edges[3], g[edges[0]]])
        alpha = forward(edges, prob[:, None], len(full), int(lengths.max()))[:, :, 0]
        beta = backward(edges, prob, lengths)
        w, s, t, p = edges
        z = alpha[np.arange(len(full)), lengths][w]
        gamma = np.divide(alpha[w, s] * prob * beta[w, t], z, out=np.zeros_like(z), where=z > 0) * c[w]
        plain = p < lattices.size
        np.add.at(out, (p[plain], g[w[plain]]), gamma[plain])
        for k, char in enumerate(rare):
            sel = p == lattices.size + k
            uses = np.bincount(g[w[sel]], gamma[sel], logp.shape[1])
            for b in char.encode("utf-8", "surrogatepass"):
                out[lattices.bytes_[b]] += uses
    return out


def fit(labelled: DataFrame, *, path: str = pieces.MODEL, sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (piece, language) from ``doc_id, text, lang``.

    Expectation-maximisation over all segmentations, from equal probabilities. It reads, per language,
    the ``sample`` documents with the lowest hash of the id (a documented bound; every text whole).
    Words of ``LONG`` characters or more, as scripts without spaces have them, are counted in pieces of
    fewer. Counting and expectation run as Spark jobs; the driver gets the model, whose size is the
    vocabulary times the number of languages.
    """
    spark = labelled.sparkSession
    rows = labelled.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((0, 0))
    # twice the sample and more by hash, whatever a language's size, so that few rows are ranked
    share = F.create_map(*[F.lit(x) for g, n in sizes.items() for x in (g, int(min(1.0, (2 * sample + 100) / n) * (1 << 30)))])
    some = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash")).where(F.shiftrightunsigned("hash", 34) <= share[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("hash", 34), "hash", "doc_id"))
    chosen = some.distinct().withColumn("n", rank).where(F.col("n") <= sample).select("doc_id", "lang")
    chosen = staged(chosen, "chosen")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for text, lang in rows_of(batches):
            for word, n in Counter(words_of(text)).items():
                full = pieces.SPACE + word
                for at in range(0, len(full), LONG):
                    found[lang, full[at : at + LONG]] += n
            if len(found) > CACHE:
                yield from _counts(found)
                found = Counter()
        yield from _counts(found)

    texts = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).select("text", "lang")
    words = texts.mapInArrow(count, "lang string, word string, n bigint")
    words = staged(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    size, number = pieces.load(path).size, {g: i for i, g in enumerate(langs)}
    logp = np.full((size, len(langs)), -math.log(size))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(logp)

        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            lattices, total = lattices_of(path), None
            for batch in batches:
                lang = np.array([number[g] for g in batch.column(0).to_pylist()])
                part = expected(lattices, batch.column(1).to_pylist(), batch.column(2).to_numpy(), lang, model.value)
                total = part if total is None else total + part
            if total is not None:
                p, g = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(g), pa.array(total[p, g])], ["piece", "lang", "n"])

        sums = words.mapInArrow(expect, "piece bigint, lang bigint, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        found = sums.toPandas()
        counts = np.full(logp.shape, SMOOTH)
        counts[found["piece"].to_numpy(), found["lang"].to_numpy()] += found["n"].to_numpy()
        logp = np.log(counts) - np.log(counts.sum(0))
        model.unpersist()
    return langs, logp


def _counts(found: Counter) -> Iterator[pa.RecordBatch]:
    if found:
        langs, words = zip(*found)
        yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(words), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])


def identify(
    docs: DataFrame, langs: list[str], logp: np.ndarray, *, path: str = pieces.MODEL, text: str = "text"
) -> DataFrame:
    """``docs`` with ``lang_pred, score``: the likeliest language and its posterior probability.

    A text's probability under a language is the sum over all segmentations into pieces, words apart
    (white space by Unicode; lower case; without ASCII signs and digits). Languages are equally likely beforehand; ties go to the first in order.
    Null texts and texts without any letter are ``und`` with score 0; so is everything if no language
    was learned. Rows, repeated ones too, and other columns are kept; ``lang_pred`` and ``score`` are
    replaced.
    """
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    model = docs.sparkSession.sparkContext.broadcast((path, logp))
    name = uuid.uuid4().hex
    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, at = kept(name, lambda: Scorer(*model.value)), rest.index(text)
        try:
            yield from _predicted(batches, scorer, at)
        finally:
            scorer.reset()  # workers live on, and the next stage needs their memory

    def _predicted(batches: Iterator[pa.RecordBatch], scorer: Scorer, at: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(at).to_pylist()
                known = [bool(t and langs and LETTER.search(t)) for t in texts]
                scores = scorer.texts([words_of(t) if k else [] for t, k in zip(texts, known)]) if langs else None
                names, values = ["und"] * len(texts), [0.0] * len(texts)
                for i in np.flatnonzero(known):
                    best = int(scores[i].argmax())
                    names[i], values[i] = langs[best], float(1 / np.exp(scores[i] - scores[i, best]).sum())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(values, pa.float64())], [*rest, "lang_pred", "score"]
                )

    return docs.select(*rest).mapInArrow(predict, schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, logp = fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), langs, logp).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
