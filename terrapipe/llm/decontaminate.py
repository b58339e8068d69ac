"""Benchmark decontamination with spaced seeds.

A spaced seed is a fixed mask over token positions: the tokens under its ones
are hashed, those under its zeros are ignored, so a changed token under a
zero does not lose the hit. A window of 16 tokens with one substitution always
keeps a whole seed of ``SEEDS``, and most with more do.

The hashes of every position of the benchmark texts (the test side) meet those
of every position of the documents (the training side). Around each hit the
two texts are laid on the same diagonal and compared token by token; an
overlap is reported when enough tokens agree (``coverage`` of the item, or a
run of neighbouring ones).

The benchmark is read in blocks of a bounded number of tokens; each block is
broadcast as sorted arrays and met by a pass over the documents, so what is
broadcast has a fixed bound whatever the benchmark's size. Documents are not
shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import pieces, staged

#: Fixed masks of weight 5: a run, and patterns that skip every second or third token.
SEEDS = ((0, 1, 2, 3, 4), (0, 2, 3, 5, 7), (0, 1, 4, 6, 9), (0, 3, 4, 7, 8))
#: Tokens of benchmark texts in one broadcast block: some 100 MB of hashes at most.
BLOCK_TOKENS = 1 << 20
LEADING = 22
#: Neighbouring tokens of a diagonal in which a run has to agree.
RUN_WITHIN = 64
#: Hits laid out at once.
HITS = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_EDGE = b".,;:!?\"'()[]{}|*#%&$<>"


def tokens(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words, bare of marks at their edges; words of marks alone are left out."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for raw in text.lower().encode().split() if (w := raw.strip(_EDGE))], np.uint64)


def seed_hashes(words: np.ndarray, seed: tuple[int, ...], which: int) -> np.ndarray:
    """The seed's hash at every start where it fits."""
    n = len(words) - seed[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, which + 1, np.uint64)
    for at in seed:
        h = (h ^ words[at:at + n]) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Block:
    """Benchmark items and, sorted by hash, where each seed hash occurs in them."""

    ids: list
    words: np.ndarray  # of all items, end to end
    bounds: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    present: np.ndarray  # by the leading bits of a hash: whether one such occurs

    @classmethod
    def of(cls, items: list[tuple]) -> Block:
        each = [tokens(text or "") for _, text in items]
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in each], dtype=np.int64))).astype(np.int64)
        hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, words in enumerate(each):
            for which, seed in enumerate(SEEDS):
                h = seed_hashes(words, seed, which)
                hashes.append(h)
                places.append(bounds[k] + np.arange(len(h)))
        hashes, places = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(hashes, kind="stable")
        present = np.zeros(1 << LEADING, bool)
        present[hashes >> np.uint64(64 - LEADING)] = True
        return cls([i for i, _ in items], np.concatenate([*each, np.zeros(0, np.uint64)]), bounds, hashes[order], places[order], present)


def densest(agree: np.ndarray) -> int:
    """The most tokens that agree among ``RUN_WITHIN`` neighbours."""
    upto = np.concatenate(([0], np.cumsum(agree)))
    width = min(RUN_WITHIN, len(agree))
    return int((upto[width:] - upto[:len(upto) - width]).max())


def overlaps(words: np.ndarray, block: Block, coverage: float, least: int, run: int) -> list[tuple]:
    """``(item index, document's first token, end, tokens that agree)`` of the verified overlaps, the best per item."""
    diagonals = []
    for which, seed in enumerate(SEEDS):
        h = seed_hashes(words, seed, which)
        at = np.flatnonzero(block.present[h >> np.uint64(64 - LEADING)])
        low = np.searchsorted(block.hashes, h[at])
        n = np.searchsorted(block.hashes, h[at], side="right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        if not len(at):
            continue
        upto, begin = np.cumsum(n), 0
        while begin < len(at):  # words repeated on both sides give many hits on few diagonals
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + HITS, side="right")))
            m = n[begin:end]
            k = np.repeat(low[begin:end] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            place = block.places[k]
            diagonals.append(np.unique(np.column_stack(
                [np.searchsorted(block.bounds, place, side="right") - 1, np.repeat(at[begin:end], m) - place]), axis=0))
            begin = end
    best: dict[int, tuple] = {}
    if not diagonals:
        return []
    for item, shift in np.unique(np.concatenate(diagonals), axis=0).tolist():
        begin, end = int(block.bounds[item]), int(block.bounds[item + 1])
        a, b = max(0, begin + shift), min(len(words), end + shift)
        agree = words[a:b] == block.words[a - shift:b - shift]
        n = int(agree.sum())
        if n >= max(min(least, end - begin), coverage * (end - begin)) or (n >= run and densest(agree) >= run):
            inside = np.flatnonzero(agree)
            found = (item, a + int(inside[0]), a + int(inside[-1]) + 1, n)
            if item not in best or (n, -found[1]) > (best[item][3], -best[item][1]):
                best[item] = found
    return [best[k] for k in sorted(best)]


def blocks(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", block_tokens: int = BLOCK_TOKENS) -> Iterator[Block]:
    """The benchmark in blocks of at most ``block_tokens`` tokens (a longer item is a block of its own)."""
    held, size = [], 0
    rows = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    for r in rows.distinct().toLocalIterator():
        n = r["text"].count(" ") + r["text"].count("\n") + 1
        if held and size + n > block_tokens:
            yield Block.of(held)
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += n
    if held:
        yield Block.of(held)


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, least: int = 10, run_tokens: int = 20, id_column: str = "doc_id",
                  text_column: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``id, item_id, first_token, end_token, n_agree, item_tokens, coverage``: a row per document row and item it holds.

    A document holds an item when, on one diagonal around a seed hit, at
    least ``coverage`` of the item's tokens agree, and ``least`` of them (all,
    for a shorter item); ``run_tokens`` that agree within ``RUN_WITHIN`` neighbouring ones are enough for any item, so words that
    agree here and there along a long one are not. Null texts and items shorter than the shortest seed (five tokens) hold nothing; null ids stay null; repeated benchmark rows
    count once; repeated documents are reported each; no benchmark, no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, item_id long, first_token long, end_token long, n_agree long, item_tokens long, coverage double"
    found: list[DataFrame] = []
    before = None
    for block in blocks(benchmark, block_tokens=block_tokens):
        shipped = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            block = shipped.value
            for batch in pieces(batches, "text"):
                take, rows = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for item, a, b, n in overlaps(tokens(text or ""), block, coverage, least, run_tokens):
                        size = int(block.bounds[item + 1] - block.bounds[item])
                        take.append(i)
                        rows.append((block.ids[item], a, b, n, size, n / size))
                if rows:
                    columns = [batch.column(0).take(pa.array(take))] + [
                        pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.float64()], strict=True)]
                    yield pa.record_batch(columns, names=["id", "item_id", "first_token", "end_token", "n_agree", "item_tokens", "coverage"])

        if found:  # one block at a time: the one before is done with once another follows
            found[-1] = staged(found[-1], "contamination")
            before.unpersist()
        found.append(source.mapInArrow(run, schema))
        before = shipped
    return functools.reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
