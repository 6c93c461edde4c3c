"""Language identification with error-correcting output codes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import grams, sampling

SAMPLE_DOCS = 4096
MOST_LANGUAGES = 512
ORDERS, BUCKETS = (3,), 4096
STEPS, DECAY = 150, 1e-3
UNKNOWN = "und"
AMBIGUOUS = 0.05
_LETTER = re.compile(r"[^\W\d_]")


def featurize(texts: pa.Array) -> Iterator[np.ndarray]:
    for _, _, counts in grams.histograms(texts, ORDERS, BUCKETS):
        yield grams.features(counts, len(ORDERS))


def has_letter(text: str | None) -> bool:
    found = _LETTER.search(text or "")
    return bool(found) and (found.group().isalpha() or any(map(str.isalpha, text)))


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language. Up to seven languages have every split into two parts (the exhaustive
    code); more have the random code, of ten bits for each doubling, whose closest rows are farthest apart among 64."""
    if languages <= 7:
        bits = max(0, 2 ** (languages - 1) - 1)
        table = (np.arange(1, bits + 1)[None, :] >> np.arange(languages)[:, None] - 1) & 1 if bits else np.zeros((languages, 0), int)
        if bits:
            table[0] = 0
        return (1 - 2 * table).astype(np.float32)
    rng = np.random.default_rng(11)
    best, apart = None, -1
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (languages, 10 * int(np.ceil(np.log2(languages)))))
        near = (code @ code.T - 2 * np.eye(languages) * code.shape[1]).max()
        if best is None or -near > apart:
            best, apart = code, -near
    return best.astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(best, score, margin)``: the language whose codeword has the smallest weighted logistic loss against the
        bits' margins, its share, and its lead over the runner-up."""
        n = len(self.languages)
        if n < 2:
            return np.zeros(len(x), int), np.full(len(x), float(n)), np.full(len(x), float(n))
        loss = np.logaddexp(0, -(x @ self.weights + self.bias)[:, None, :] * self.code[None]) @ self.trust
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, 1)
        return share.argmax(1), order[:, -1], order[:, -1] - order[:, -2]


def fit(names: np.ndarray, x: np.ndarray) -> Model:
    """Binary logistic classifiers of every bit, by accelerated gradient steps on all sampled rows; a bit weighs
    as much as its classifier is better than chance."""
    languages = tuple(sorted(set(names.tolist())))
    code = codewords(len(languages))
    want = code[np.searchsorted(languages, names)] if len(languages) > 1 else np.zeros((len(x), 0), np.float32)
    w = np.zeros((x.shape[1], want.shape[1]), np.float32)
    ahead, b, b_ahead, speed = w, np.zeros(want.shape[1], np.float32), np.zeros(want.shape[1], np.float32), 2.0
    for t in range(STEPS if want.shape[1] else 0):
        pull = -want / (1 + np.exp(np.clip(want * (x @ ahead + b_ahead), -30, 30))) / len(x)
        w_next, b_next = ahead - speed * len(languages) * (x.T @ pull + DECAY / len(languages) * ahead * 0.1), b_ahead - speed * pull.sum(0)
        ahead, b_ahead = w_next + t / (t + 3) * (w_next - w), b_next + t / (t + 3) * (b_next - b)
        w, b = w_next, b_next
    right = ((x @ w + b) * want > 0).mean(0) if want.shape[1] else np.zeros(0)
    trust = np.maximum(2 * right - 1, 0.01)
    return Model(languages, code, w, b, (trust / trust.mean()).astype(np.float32) if len(trust) else trust)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample_docs`` labelled rows, evenly over the languages. Rows without label or letter teach nothing."""
    rows = docs.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != UNKNOWN) & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(id_col, text_col, F.col(lang_col).alias("_lang"))
    names, x = sampling.vectors(sampling.thinned(rows, id_col, "_lang", sample_docs, MOST_LANGUAGES), text_col, "_lang", featurize)
    return fit(names, x)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` and ``ambiguous`` of every whole text.

    A text that is null or has no letter, and every text if no language was learnt, is ``und`` with score 0 and not
    ambiguous. ``ambiguous`` marks a lead over the runner-up below ``AMBIGUOUS``; equal codewords go to the language
    first by name. Only the text is looked at.
    """
    kept = docs.select(*(F.col(c) for c in keep), F.col(text_col).alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            best, score, lead = np.zeros(len(text), int), np.zeros(len(text)), np.ones(len(text))
            at = 0
            for x in featurize(text) if len(model.languages) else ():
                best[at : at + len(x)], score[at : at + len(x)], lead[at : at + len(x)] = model.decode(x)
                at += len(x)
            blank = ~np.fromiter((has_letter(t.as_py()) for t in text), bool, len(text)) | (not model.languages)
            best[blank], score[blank], lead[blank] = len(names) - 1, 0, 1
            found = [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(lead < AMBIGUOUS)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=[*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"])

    return grams.map_batches(kept, run, ", ".join([*kinds, "lang_pred string", "score double", "ambiguous boolean"]))


def keep_decided(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with their own columns only, whose language is told: neither ``und`` nor ambiguous. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_col)
            told = np.fromiter((has_letter(t.as_py()) for t in text), bool, len(text)) & bool(model.languages)
            at = 0
            for x in featurize(text) if len(model.languages) else ():
                told[at : at + len(x)] &= model.decode(x)[2] >= AMBIGUOUS
                at += len(x)
            yield batch.filter(pa.array(told))

    return grams.map_batches(docs, run, docs.schema)


def train_on_folds(docs: DataFrame) -> Model:
    """Learn from documents whose crc32 of the id modulo 4 is not 2."""
    return train(docs.where(sampling.crc("doc_id") % 4 != 2))


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """Predictions for all documents of the model above; a null id counts as held out, as it taught nothing."""
    return predict(docs, train_on_folds(docs)).select(
        "doc_id", F.coalesce(sampling.crc("doc_id") % 4 == 2, F.lit(True)).alias("held_out"), "lang_pred", "score", "ambiguous",
    )
