"""Quality scores by positive-unlabelled learning with the non-negative risk estimator."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import grams, sampling, words

SAMPLE_DOCS = 5000
TRIGRAM_BUCKETS = 1024
#: Gain of each kind of standardised feature: the few dense ones are not to drown in the many hashed ones.
GAINS = ((256, 1.0), (TRIGRAM_BUCKETS, 0.1), (4, 3.0))
EPOCHS, BATCH, RATE, DECAY = 40, 250, 0.003, 1e-3
THRESHOLD = 0.3


def featurize(texts: pa.Array) -> Iterator[np.ndarray]:
    """Rows of features of whole texts: shares of bytes and of hashed trigrams, of words that repeat the word before,
    of distinct trigrams, and the logarithm of the length."""
    offsets, data = grams.flat(texts)
    for a, b, counts in grams.histograms(texts, (3,), TRIGRAM_BUCKETS):
        own = offsets[a : b + 1]
        n = np.diff(own)
        chars = np.zeros((b - a, 256), np.float32)
        for row, (lo, hi) in enumerate(zip(own, own[1:])):
            chars[row] = np.bincount(data[lo:hi], minlength=256)
        total = np.maximum(n, 1)[:, None]
        dense = np.stack([
            words.repeats(own, data), np.log1p(n) / 10, ((counts / np.maximum(counts.sum(1), 1)[:, None]) ** 2).sum(1) * 10,
            chars[:, 65:91].sum(1) / total[:, 0],
        ], 1)
        yield np.concatenate([np.sqrt(chars / total), grams.features(counts, 1), dense], 1).astype(np.float32)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Lower confidence limit of the share of positives among the unlabelled, by the best-bin rule.

    The ratio of the tail shares of unlabelled and held-back positive scores bounds the share from above at every
    threshold; the threshold with the smallest upper limit is taken. The lower limit there is returned, since a prior
    above the truth lets the clipped risk take the kind of bad text nearest to good text for positive.
    """
    cuts = np.sort(positive)
    tail_p = 1 - np.searchsorted(cuts, cuts, "left") / len(cuts)
    tail_u = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    chance = np.sqrt(np.log(4 / confidence) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = np.argmin((tail_u + chance) / tail_p)
    return float(np.clip((tail_u[best] - chance) / tail_p[best], 0.05, 0.99))


def _sigmoid(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -30, 30)))


def minimise_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear score of standardised features under the non-negative risk with the logistic loss.

    The risk is ``prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])``. A batch whose second part is negative
    takes a step that raises it, as the estimator prescribes.
    """
    gain = np.concatenate([np.full(n, g, np.float32) for n, g in GAINS])
    mean, scale = unlabelled.mean(0), (unlabelled.std(0) + 1e-2) / (gain if len(gain) == unlabelled.shape[1] else 1)
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    w, b, t = np.zeros(p.shape[1]), 0.0, 0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    rng = np.random.default_rng(seed)
    loss = lambda f: np.logaddexp(0, f)
    for _ in range(EPOCHS):
        p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
        steps = max(1, min(len(p), len(u)) // BATCH)
        for xp, xu in zip(np.array_split(p, steps), np.array_split(u, steps)):
            fp, fu = xp @ w + b, xu @ w + b
            pull, gu, gn = -prior * _sigmoid(-fp) / len(fp), _sigmoid(fu) / len(fu), -prior * _sigmoid(fp) / len(fp)
            if loss(fu).mean() - prior * loss(fp).mean() < 0:
                pull, gu, gn = 0 * pull, -gu, -gn
            g = np.append(xp.T @ (pull + gn) + xu.T @ gu + DECAY * w, (pull + gn).sum() + gu.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    return (w / scale).astype(np.float32), float(b - (mean / scale) @ w)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(x @ self.weights + self.bias).astype(float)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """A model from features of trusted positives and of unlabelled rows; the prior is estimated where none is given.

    For the estimate a first model is fitted on two thirds of both and looks at the rest. With no positive or no
    unlabelled row nothing can be learnt: every score is then 0.5.
    """
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(positive.shape[1] or unlabelled.shape[1] or 1, np.float32), 0.0, 0.5)
    if prior is None:
        back_p, back_u = np.arange(len(positive)) % 3 == 0, np.arange(len(unlabelled)) % 3 == 0
        if back_p.all() or back_u.all():
            prior = 0.5
        else:
            w, b = minimise_risk(positive[~back_p], unlabelled[~back_u], 0.5)
            prior = estimate_prior(positive[back_p] @ w + b, unlabelled[back_u] @ w + b)
    return Model(*minimise_risk(positive, unlabelled, prior), prior)


def train(positives: DataFrame, unlabelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on at most about ``sample_docs`` rows, half of each kind, sampled evenly by hash of the id."""
    both = positives.select(id_col, text_col, F.lit(1).alias("_s")).unionByName(unlabelled.select(id_col, text_col, F.lit(0).alias("_s")))
    kind, x = sampling.vectors(sampling.thinned(both, id_col, "_s", sample_docs), text_col, "_s", featurize)
    return fit(x[kind == 1], x[kind == 0])


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every whole text. A null text scores as an empty one, a repeated
    row like the first; other columns are never read."""
    kept = docs.select(*(F.col(c) for c in keep), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            scores = [model.score(x) if x.shape[1] == len(model.weights) else np.full(len(x), 0.5) for x in featurize(text)]
            values = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*batch.schema.names[:-1], "score"])

    return grams.map_batches(kept, run, ", ".join([*kinds, "score double"]))


def held_out_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Train on documents whose crc32 of the id modulo 5 is not 0, score all. Positives are those labelled 1;
    unlabelled are documents of the same folds, whatever their label. A document with a null id is scored and
    counts as held out."""
    learn = docs.where(sampling.crc("doc_id") % 5 != 0)
    trusted = labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("_id")).distinct()
    positives = learn.join(trusted, F.col("doc_id") == F.col("_id"), "left_semi")
    model = train(positives, learn)
    return score(docs, model).select(
        "doc_id", F.coalesce(sampling.crc("doc_id") % 5 == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
