"""Quality classifier from positive and unlabelled texts: non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import held_out, rows_of, staged, table

#: Bins of a feature, weight of the ridge in positives, most Newton steps, bins of a score histogram.
BINS, RIDGE, STEPS, GRID = 12, 10, 8, 200
#: Part of the estimated prior that is used: the estimate bounds the prior from above, and a prior
#: that is too high makes the risk of negatives fall below zero.
MARGIN = 0.75
#: Tasks that add up the sums of all tasks.
MEET = 16
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".",
    "comma": b",;:", "shout": b"!?", "bar": b"|", "sign": b"*#$%&@^~=_+<>{}[]\\/", "quote": b"\"'()-", "space": b" \t\n\v\f\r",
}
FEATURES = 20


def features(text: bytes | None) -> list[float]:
    """Style of a text, from all of it: shares of kinds of characters, words, lines and repeats."""
    if not text:
        return [0.0] * FEATURES
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = {k: int(count[list(v)].sum()) for k, v in _CLASSES.items()}
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, m, size = max(1, len(words)), max(1, len(lines)), len(text)
    letters = max(1, kinds["upper"] + kinds["lower"])
    distinct = len(set(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    return [
        kinds["upper"] / letters, kinds["digit"] / size, kinds["stop"] / n, kinds["comma"] / n, kinds["shout"] / n,
        kinds["bar"] / n, kinds["sign"] / n, kinds["quote"] / n, kinds["space"] / size, int(count[128:].sum()) / size,
        float(np.log1p(len(words))), float(lengths.mean()), float(lengths.std()), distinct / n, float(np.log1p(m)),
        n / m, len(set(lines)) / m, kinds["stop"] / m, float(lengths.max()), (kinds["sign"] + kinds["shout"] + kinds["bar"]) / n,
    ]


def styled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, x``: the features of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t) for _, t in rows_of([batch])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, x array<float>")


def design(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """One column per bin of each feature, and a constant."""
    out = [np.ones((len(x), 1))]
    for k, e in enumerate(edges):
        out.append(np.eye(len(e) + 1)[np.searchsorted(e, x[:, k], side="right")])
    return np.concatenate(out, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), FEATURES)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = sum(np.frombuffer(s) for (s,) in rows_of(batches, 16))
    if isinstance(total, np.ndarray):
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])


def _total(parts: DataFrame) -> np.ndarray:
    """Sum of the vectors that tasks give, by way of a few tasks; so many rows reach the driver."""
    return np.sum([np.frombuffer(r[0]) for r in parts.repartition(MEET).mapInArrow(_add, "s binary").collect()], axis=0)


def _sums(rows: DataFrame, edges: list[np.ndarray], w: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over all rows at weights ``w``: gradient and curvature of the unlabelled part, the mean
    design of the positives, losses and counts."""
    size = len(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grad, curve, pos = np.zeros(size), np.zeros((size, size)), np.zeros(size)
        tail = np.zeros(4)  # unlabelled, positives, loss of unlabelled as negative, of positives as negative
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                d, known = design(_matrix(part.column(0)), edges), part.column(1).to_numpy(zero_copy_only=False)
                g = d @ w
                p = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
                grad += d.T @ p
                curve += (d * (p * (1 - p))[:, None]).T @ d
                pos += d[known].sum(0)
                loss = np.logaddexp(0, g)
                tail += [len(d), known.sum(), loss.sum(), loss[known].sum()]
        packed = np.concatenate([grad, curve.ravel(), pos, tail])
        yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary())], ["s"])

    total = _total(rows.select("x", "known").mapInArrow(run, "s binary"))
    cuts = np.cumsum([size, size * size, size])
    grad, curve, pos, tail = np.split(total, cuts)
    return {"grad": grad, "curve": curve.reshape(size, size), "pos": pos, "tail": tail}


def _newton(rows: DataFrame, edges: list[np.ndarray], prior: float) -> np.ndarray:
    """Minimum of prior * E_p[loss(g)] + max(0, E_u[loss(-g)] - prior * E_p[loss(-g)]) with the
    logistic loss, where the sum of both is convex; steps end where the second term would fall below
    zero, which is where the risk stops being an estimate and starts to overfit."""
    size = 1 + sum(len(e) + 1 for e in edges)
    w = np.zeros(size)
    for _ in range(STEPS):
        s = _sums(rows, edges, w)
        n, n_pos, loss, loss_pos = s["tail"]
        if not n_pos or loss / n - prior * loss_pos / n_pos < 0:
            break
        grad = s["grad"] / n - prior * s["pos"] / n_pos + RIDGE / n_pos * w
        step = np.linalg.solve(s["curve"] / n + RIDGE / n_pos * np.eye(size), grad)
        step *= min(1.0, 4 / max(1e-9, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    return w


def class_prior(rows: DataFrame, edges: list[np.ndarray], w: np.ndarray) -> float:
    """An upper bound of the share of positives among ``rows``: the least ratio, over score thresholds,
    of the share of rows above to the share of trusted positives above. Where negatives vanish the
    ratio is the prior; thresholds with few positives above are left out by their sampling error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, GRID))
        for batch in batches:
            g = design(_matrix(batch.column(0)), edges) @ w
            at = np.clip((GRID / (1 + np.exp(-np.clip(g, -500, 500)))).astype(int), 0, GRID - 1)
            known = batch.column(1).to_numpy(zero_copy_only=False)
            total += [np.bincount(at, minlength=GRID), np.bincount(at[known], minlength=GRID)]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    every, known = _total(rows.select("x", "known").mapInArrow(run, "s binary")).reshape(2, GRID)
    above, above_known = np.cumsum(every[::-1]) / max(1, every.sum()), np.cumsum(known[::-1]) / max(1, known.sum())
    noise = np.sqrt(1 / np.maximum(1, np.cumsum(known[::-1])))
    ratio = np.where(above_known > 0.05, above / np.maximum(above_known, 1e-9) * (1 + noise), 1.0)
    return float(ratio.min())


def fit(rows: DataFrame) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Bin edges, weights and prior from ``x`` and ``known`` (a trusted positive) of all rows."""
    cuts = [i / BINS for i in range(1, BINS)]
    quantiles = rows.select([F.percentile_approx(F.col("x")[k], cuts, 10_000) for k in range(FEATURES)]).first()
    edges = [np.unique(np.array(q if q else [0.0])) for q in quantiles]
    size = 1 + sum(len(e) + 1 for e in edges)
    n, n_pos = rows.agg(F.count("*"), F.count(F.when(F.col("known"), 1))).first()
    if not n or not n_pos:
        return edges, np.zeros(size), 0.5
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0  # of the positives rank, the others estimate
    taught = F.col("known") & half
    ranked = _newton(rows.select("x", taught.alias("known")), edges, 0.5)
    n_taught = rows.where(taught).count()
    bound = class_prior(rows.where(~taught), edges, ranked)
    prior = MARGIN * float(np.clip((bound * (n - n_taught) + n_taught) / n, 0.01, 1))
    return edges, _newton(rows, edges, prior), prior


def quality(docs: DataFrame, trusted: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` for every row of ``docs``: the probability that it is of good quality.

    ``trusted`` holds the doc_ids known to be good; all texts count as unlabelled. The score is
    logistic in binned style features of the whole text (bins by quantiles over all rows). First a
    model of half of the positives ranks texts, and the other half gives the class prior by it; then
    the non-negative unbiased risk is minimised at that prior by Newton steps, each a pass of Spark over the features of
    all rows that brings sums of fixed size back. Null and empty texts have all features 0 and a score
    like others. Without positives every score is 1/2. Rows, repeated ones too, are kept.
    """
    good = trusted.select(F.col(trusted.columns[0]).alias("_good")).where("_good is not null").distinct()
    rows = styled(docs, doc_id, text).join(good, F.col("doc_id") == F.col("_good"), "left")
    rows = staged(rows.select("doc_id", "x", F.col("_good").isNotNull().alias("known")), "styles")
    edges, w, _ = fit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = design(_matrix(batch.column(1)), edges) @ w
            score = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~held_out(F.col("doc_id")))
    scored = quality(table(spark, sf_dir, "documents"), labels.select("doc_id"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
