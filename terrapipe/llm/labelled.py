"""Bounded samples of labelled documents, and small logistic models fitted on them."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int,
           where: Column | None = None) -> list[tuple[str, int]]:
    """``(text, label)`` of at most ``rows`` labelled documents, each cut after ``chars`` characters.

    The labels are drawn in the order of a hash of ``doc_id``, so the sample
    depends on the rows alone. Rows without id, label or document are left
    out; of several labels of one id the greatest counts; ``where`` filters
    the labels. Only this sample, at most ``rows`` x ``chars``, reaches the driver.
    """
    drawn = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("_label"))
    if where is not None:
        drawn = drawn.where(where)
    drawn = drawn.dropna().groupBy("doc_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.substring(F.coalesce("text", F.lit("")), 1, chars).alias("_text"))
    found = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "_label").agg(F.min("_text").alias("_text"))
    return [(r["_text"], int(r["_label"] != 0)) for r in sorted(found.collect(), key=lambda r: r["doc_id"])]


def without_copies(drawn: list[tuple[str, int]], shared: float = 0.2) -> list[tuple[str, int]]:
    """The texts that share at most ``shared`` of their word triples with those before them.

    A text copied a hundred times would otherwise vouch a hundred times for
    its rare words. Long texts are compared by a quarter of their triples,
    chosen by hash.
    """
    seen: set[int] = set()
    out = []
    for text, label in drawn:
        words = text.lower().split()
        triples = {xxhash.xxh3_64_intdigest(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))}
        if len(triples) > 64:
            triples = {t for t in triples if t % 4 == 0}
        if len(triples & seen) <= shared * len(triples):
            out.append((text, label))
        seen |= triples
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights (the last one the intercept) of a logistic model, by Newton's method. One class only: its smoothed rate."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    if len(set(y.tolist())) < 2:
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
