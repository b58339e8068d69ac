"""Quality rules with a learned verdict.

Fixed rules count words, symbols, repeated lines and repeated 8-word windows
of a whole text. The verdict is a logistic regression over hashed word and
character n-grams, trained on labelled rows, calibrated on rows kept out of
the training, and scored in Arrow batches against a fixed threshold.

An n-gram's hash is a polynomial over its code points modulo 2**64, taken
from prefix sums, so all of a text's n-grams come from a few array operations.
A text's features are the shares of its n-grams in each of ``2**bits`` slots
(separate ones for words, word pairs and each character length).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.labelled import fit_logistic, probability, sample
from terrapipe.llm.shared import pieces

SYMBOLS = "#*$%&|<>"
BITS = 16
CHARACTERS = (3, 5)
WINDOW = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xBF58476D1CE4E5B9)

_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling, kept per process."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(1 << max(12, n.bit_length()), base)
        have[0] = 1
        have = _powers[int(base)] = np.cumprod(have)
    return have[:n]


def _hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-free hashes of the spans, by prefix sums of code point x base**position."""
    h = (prefix[ends] - prefix[starts]) * _power(INVERSE, len(prefix))[starts] + (ends - starts).astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Shape:
    """A text's code points with its words' bounds and hashes."""

    codes: np.ndarray
    prefix: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray

    @classmethod
    def of(cls, text: str) -> Shape:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        gap = (codes == 32) | ((codes >= 9) & (codes <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True]))))
        prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power(BASE, len(codes)), out=prefix[1:])
        return cls(codes, prefix, edge[0::2], edge[1::2], _hashes(prefix, edge[0::2], edge[1::2]))


def repeated_words(words: np.ndarray, size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    if len(words) <= size:
        return 0
    n = len(words) - size + 1
    window = np.zeros(n, np.uint64)
    for k in range(size):
        window = window * BASE + words[k:k + n]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    delta = np.zeros(len(words) + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + size, -1)
    return int((np.cumsum(delta)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    return len(lines) - len(set(lines))


def base(text: str, shape: Shape) -> tuple[int, int, int, int, int, bool]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    n, repeat = len(shape.words), repeated_words(shape.words)
    return (n, int((shape.ends - shape.starts).sum()), sum(map(text.count, SYMBOLS)), repeated_lines(text), repeat,
            n < 20 or 100 * repeat > 30 * n)


def slots(shape: Shape) -> list[np.ndarray]:
    """The slots of the text's n-grams, by kind: words, word pairs, then each character length."""
    found = [shape.words, shape.words[1:] * BASE + shape.words[:-1]]
    for k in CHARACTERS:
        starts = np.arange(max(0, len(shape.codes) - k + 1))
        found.append(_hashes(shape.prefix, starts, starts + k))
    return [(h >> np.uint64(64 - BITS)).astype(np.intp) + (i << BITS) for i, h in enumerate(found)]


@dataclass
class Model:
    weights: np.ndarray  # of the slots
    calibration: np.ndarray

    def margin(self, shape: Shape) -> float:
        return float(sum(self.weights[s].mean() for s in slots(shape) if len(s)))

    def probability(self, shape: Shape) -> float:
        return float(probability(np.array([[self.margin(shape)]]), self.calibration)[0])


def train(drawn: list[tuple[str, int]], passes: int = 60, rate: float = 0.5, ridge: float = 1e-6) -> Model:
    """AdaGrad over all training rows at once; every fifth row calibrates the margin instead (Platt scaling)."""
    size = (2 + len(CHARACTERS)) << BITS
    if len({y for _, y in drawn}) < 2:
        y = np.array([y for _, y in drawn] or [1], float)
        return Model(np.zeros(size, np.float32), fit_logistic(np.zeros((len(y), 1)), y))
    shapes = [Shape.of(t) for t, _ in drawn]
    labels = np.array([y for _, y in drawn], float)
    fitted = np.arange(len(drawn)) % 5 != 0
    index, value, row = [], [], []
    for i in np.flatnonzero(fitted):
        for s in slots(shapes[i]):
            if len(s):
                at, n = np.unique(s, return_counts=True)
                index.append(at.astype(np.int32))
                value.append((n / len(s)).astype(np.float32))
                row.append(np.full(len(at), i, np.int32))
    index, value, row = map(np.concatenate, (index, value, row))
    slices = [slice(i, i + (1 << 20)) for i in range(0, len(index), 1 << 20)]  # bounds what is held besides the features
    weights, squares, intercept = np.zeros(size), np.full(size, 1e-12), 0.0
    for _ in range(passes):
        margin = sum(np.bincount(row[s], weights[index[s]] * value[s], len(drawn)) for s in slices) + intercept
        off = np.where(fitted, 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels, 0.0)
        grad = sum(np.bincount(index[s], off[row[s]] * value[s], size) for s in slices) / fitted.sum() + ridge * weights
        squares += grad * grad
        weights -= rate * grad / np.sqrt(squares)
        intercept -= rate * off.sum() / fitted.sum()
    model = Model(weights.astype(np.float32), np.zeros(2))
    apart = np.flatnonzero(~fitted)
    model.calibration = fit_logistic(np.array([[model.margin(shapes[i])] for i in apart]), labels[apart])
    return model


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, rows: int = 3000, chars: int = 8000) -> Model:
    """Train on at most ``rows`` labelled documents of ``chars`` characters; without both kinds, one verdict for all."""
    return train(sample(docs, labels, "quality", rows, chars, where))


def judge(docs: DataFrame, model: Model, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, base counts, ``base_failed``, ``quality`` (calibrated probability) and ``kept``.

    ``kept`` needs the base rules passed and ``quality >= threshold``. Null and
    empty texts have no words and fail; null ids and repeated rows stay; other
    columns are not read. The model is of fixed size (1 MB) and is broadcast.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    out = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, quality double, kept boolean")
    names = [c.split()[0] for c in out.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shape = Shape.of(text or "")
                counts = base(text or "", shape)
                good = shipped.value.probability(shape)
                rows.append((doc, *counts, good, not counts[-1] and good >= threshold))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, out)
