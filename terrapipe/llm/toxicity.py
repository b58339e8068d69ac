"""Toxicity by compression distance.

Two Zstandard dictionaries are learned: one from windows of ordinary
documents, one from what sets toxic documents apart (word beginnings far more
frequent among them, by document frequency, each grown as long as its support
holds). A window of words is compressed with the ordinary dictionary alone
and with the toxic one in front of it: the bytes that the toxic dictionary
saves are the window's distance. A document's distances (their sum against
its length, the largest) give a probability through a logistic model
calibrated on the same labelled rows.

Fitting sees a bounded sample (``rows`` documents of ``chars`` characters);
scoring sees every whole text, in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.labelled import fit_logistic, probability, sample, without_copies
from terrapipe.llm.shared import pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEVEL = 6


def windows(text: str, size: int) -> list[bytes]:
    """Lower-cased runs of ``size`` words, each between spaces."""
    words = WORD.findall(text.lower())
    return [(" " + " ".join(words[i:i + size]) + " ").encode() for i in range(0, len(words), size)]


def _beginnings(words: set[str]) -> set[str]:
    return {shown[:k] for w in words for shown in [f" {w} "] for k in range(4, min(12, len(shown)) + 1)}


def distinctive(toxic: list[str], ordinary: list[str], least: int = 8, most: int = 256, ratio: float = 1.5) -> list[str]:
    """Word beginnings that mark toxic documents, weakest first."""
    seen = [Counter(), Counter()]
    for text in toxic:
        seen[1].update(_beginnings(set(WORD.findall(text.lower()))))
    support = {g: c for g, c in seen[1].items() if c >= min(least, max(2, len(toxic) // 8))}
    for text in ordinary:
        seen[0].update(_beginnings(set(WORD.findall(text.lower()))) & support.keys())
    odds = {}
    for g, c in support.items():
        log_odds = math.log((c + 0.5) / (len(toxic) + 1)) - math.log((seen[0][g] + 0.5) / (len(ordinary) + 1))
        if log_odds >= ratio and log_odds * math.sqrt(c) >= 8:
            odds[g] = log_odds * math.sqrt(c)
    kept: list[str] = []
    for g in sorted(odds, key=lambda g: (len(g), g)):
        if not any(g.startswith(k) and odds[k] >= 0.6 * odds[g] for k in kept):
            kept.append(g)
    longer: dict[str, list[str]] = {}
    for g in support:
        longer.setdefault(g[:-1], []).append(g)
    grown = []
    for g in kept:
        while fits := [h for h in longer.get(g, ()) if support[h] >= 0.85 * support[g]]:
            g = max(fits, key=lambda h: (support[h], h))
        grown.append(g)
    order = sorted(set(grown), key=lambda g: (odds.get(g, 8.0), g))
    return order[-most:]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    window: int

    def __getstate__(self):
        return self.ordinary, self.toxic, self.weights, self.window

    def __setstate__(self, state):
        self.ordinary, self.toxic, self.weights, self.window = state

    def _compressors(self):
        if "_both" not in self.__dict__:
            made = []
            for content in (self.ordinary, self.toxic + self.ordinary):
                params = zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, window_log=17, min_match=4, write_content_size=0, write_checksum=0, write_dict_id=0)
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
                made.append(zstandard.ZstdCompressor(dict_data=known, compression_params=params).compress)
            self._both = made
        return self._both

    def features(self, text: str) -> tuple[float, float, float, float]:
        plain, primed = self._compressors()
        saved = [max(0, len(plain(w)) - len(primed(w))) for w in windows(text, self.window)] if self.toxic else []
        total, n = sum(saved), len(saved)
        return total / (n + 2), total / math.sqrt(n + 1), max(saved, default=0), math.log1p(n)

    def scores(self, texts: list[str]) -> np.ndarray:
        return probability(np.array([self.features(t) for t in texts], float).reshape(-1, 4), self.weights)


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, label: str = "toxic", rows: int = 6000,
        chars: int = 20_000, window: int = 12, ordinary_bytes: int = 8192) -> Model:
    """Learn dictionaries and calibration from at most ``rows`` labelled documents, copies among them left out.

    Without labels of both kinds every text gets one score, the smoothed rate
    (0 where there are no labels at all).
    """
    drawn = without_copies(sample(docs, labels, label, rows, chars, where))
    texts = [[t for t, y in drawn if y == k] for k in (0, 1)]
    ordinary, toxic = b"", ""
    if all(texts):
        held = [w for own in (windows(t, 24) for t in texts[0]) for w in own[::max(1, len(own) // 3)]]
        try:
            ordinary = zstandard.train_dictionary(ordinary_bytes, held[:20_000], level=3).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: the text itself
            ordinary = b"".join(held)[-ordinary_bytes:]
        toxic = "".join(distinctive(texts[1], texts[0]))
    model = Model(ordinary, toxic.encode(), np.zeros(5), window)
    if not drawn:
        model.weights[-1] = -30.0
        return model
    x = np.array([model.features(t) for t, _ in drawn], float)
    model.weights = fit_logistic(x, np.array([y for _, y in drawn], float))
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` per row, 0 to 1, from the whole text. Null and empty texts get the score of no evidence;
    null ids and repeated rows stay; other columns are not read."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a few KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            values = shipped.value.scores([t or "" for t in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(
        run, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            values = shipped.value.scores([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(values < threshold))

    return docs.mapInArrow(run, schema)
