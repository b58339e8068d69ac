"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64-bit; two link when at most ``max_bits`` bits differ. The
distinct fingerprints form a binary trie; pairs of nodes are traversed
together from the root, the bits in which their paths differ are counted, and
a pair is dropped as soon as the count exceeds the error budget.

A trie whose first bits differ prunes late, so the bits are dealt into
``max_bits // 2 + 1`` parts and one trie starts with each (a rotation): some
part of every linked pair differs in ``budget`` = ``max_bits // parts`` bits
at most, 1 for 4, which is all that the traversal allows within the leading
part. Spark deals the upper node pairs to tasks (each node with itself and
with the nodes one bit away); a task walks the rest with numpy. Nodes with
more than ``BLOCK`` fingerprints are cut into blocks, and every pair of
blocks is a task's work, so no group grows with the data and none is capped.

A task returns a forest (every linked fingerprint with the smallest one of
its local component), never all pairs; alternating large- and small-star
steps join the forests into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import pieces, staged

BITS = 64
#: Fingerprints a node holds on average where Spark hands it to a task, and at most in a block.
NODE, BLOCK = 2048, 16384
#: Node pairs in work at once, and fingerprint pairs of a node pair that are compared outright.
FRONTIER, LEAF = 1 << 18, 256
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, shingle: int) -> int:
    """Bits set in over half of the XXH64 (seed 42) of the word shingles; 0 without words."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)])
    n, total = len(hashes) // 8, np.zeros(BITS, np.int64)
    digests = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 16):
        total += np.unpackbits(digests[i:i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, fp`` (signed 64 bits) per row. Null text: no words, fingerprint 0."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [fingerprint(t or "", shingle) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], names=["id", "fp"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, fp long")


# ---- one pair of nodes ---------------------------------------------------------

def _halves(ordered: np.ndarray, lo: np.ndarray, hi: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Where the ones begin in each range."""
    return lo + zeros[hi] - zeros[lo]


def trie_links(left: np.ndarray, right: np.ndarray | None, depth: int, head: int, budget: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked values, in batches, from two nodes at ``depth`` (or one with itself: ``right`` None).

    Values are sorted, distinct, unsigned and rotated; all of a side share
    their first ``depth`` bits. At most ``budget`` of the first ``head`` bits
    and ``max_bits`` of all may differ.
    """
    itself, other = right is None, left if right is None else right
    if not len(left) or not len(other):
        return
    zeros = {}

    def counted(side: int, d: int) -> np.ndarray:
        if (side, d) not in zeros:
            values = other if side else left
            bit = (values >> np.uint64(BITS - 1 - d)) & np.uint64(1)
            zeros[side, d] = np.concatenate(([0], np.cumsum(bit == 0)))
        return zeros[side, d]

    first = int(np.bitwise_count((left[0] ^ other[0]) >> np.uint64(BITS - depth))) if depth else 0
    stack = [(depth, np.array([[0, len(left), 0, len(other), first]], np.int64))]
    while stack:
        d, work = stack.pop()
        if len(work) > FRONTIER:
            stack.append((d, work[FRONTIER:]))
            work = work[:FRONTIER]
        allowed = budget if d <= head else max_bits
        size = (work[:, 1] - work[:, 0]) * (work[:, 3] - work[:, 2])
        work, size = work[(size > 0) & (work[:, 4] <= allowed)], size[(size > 0) & (work[:, 4] <= allowed)]
        small = (size <= LEAF) | (d == BITS)
        done, work = work[small], work[~small]
        for begin in range(0, len(done), 4096):
            a, b, c, e, _ = done[begin:begin + 4096].T
            wide = e - c
            n = (b - a) * wide
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            wide = np.repeat(wide, n)
            i, j = np.repeat(a, n) + k // wide, np.repeat(c, n) + k % wide
            close = np.bitwise_count(left[i] ^ other[j]) <= max_bits
            if itself:
                close &= i < j
            if close.any():
                yield i[close], j[close]
        if not len(work):
            continue
        a, b, c, e, diff = work.T
        m, n = _halves(left, a, b, counted(0, d)), _halves(other, c, e, counted(1, d))
        same = [np.column_stack([a, m, c, n, diff]), np.column_stack([m, b, n, e, diff])]
        cross = [np.column_stack([a, m, n, e, diff + 1])]
        second = np.column_stack([m, b, c, n, diff + 1])
        cross.append(second[~((a == c) & (b == e))] if itself else second)
        stack.append((d + 1, np.concatenate(same + cross)))


class Forest:
    """Smallest index reachable, kept by whole arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.root, again := self.root[self.root]):
                self.root = again


def _task(head_bits: list[int], depth: int, budget: int, max_bits: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        turn = int(key[0])
        values = rows["x"].to_numpy().view(np.uint64)
        side = rows["side"].to_numpy()
        itself = key[1] == key[2] and key[3] == key[4]
        left = np.unique(values if itself else values[side == 0])
        right = None if itself else np.unique(values[side == 1])
        forest = Forest(len(left) + (0 if itself else len(right)))
        shift = 0 if itself else len(left)
        for i, j in trie_links(left, right, depth, head_bits[turn], budget, max_bits):
            forest.add(i, j + shift)
        every = left if itself else np.concatenate([left, right])
        moved = np.flatnonzero(forest.root != np.arange(len(every)))
        back = np.uint64(sum(head_bits[:turn]))
        plain = (every >> back) | (every << (np.uint64(BITS) - back)) if back else every
        return pd.DataFrame({"u": plain[moved].view(np.int64), "v": plain[forest.root[moved]].view(np.int64)})

    return run


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """A forest ``u, v`` over the distinct fingerprints ``fp`` whose components are those of all links."""
    parts = max_bits // 2 + 1
    heads = [BITS // parts + (i < BITS % parts) for i in range(parts)]
    budget = max_bits // parts
    n = distinct.count()
    depth = min(min(heads), max(0, (n // NODE).bit_length()))
    turned = []
    for turn in range(parts):
        by = sum(heads[:turn])
        x = F.col("fp") if not by else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", BITS - by))
        turned.append(distinct.select(F.lit(turn).alias("turn"), x.alias("x")))
    rows = turned[0]
    for more in turned[1:]:
        rows = rows.unionByName(more)
    rows = rows.withColumn("a", F.shiftrightunsigned("x", BITS - depth) if depth else F.lit(0).cast("long"))
    crowded = staged(rows.groupBy("turn", "a").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
                     .select("turn", "a", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "simhash-crowded")
    near = [F.col("a")] + ([F.col("a").bitwiseXOR(F.lit(1 << i).cast("long")) for i in range(depth)] if budget else [])
    if budget > 1:
        raise ValueError("max_bits must leave one differing bit at most to some part")
    rows = rows.withColumn("b", F.explode(F.array(*near)))
    rows = rows.join(crowded.withColumnRenamed("blocks", "own"), ["turn", "a"], "left").join(
        crowded.select("turn", F.col("a").alias("b"), F.col("blocks").alias("others")), ["turn", "b"], "left")
    rows = rows.select("turn", "x", "a", "b", F.pmod(F.xxhash64("x"), F.coalesce("own", F.lit(1))).cast("int").alias("i"),
                       F.explode(F.sequence(F.lit(0), F.coalesce("others", F.lit(1)) - 1)).alias("j"))
    swap = (F.col("a") > F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("i") > F.col("j")))
    pick = lambda yes, no: F.when(swap, F.col(yes)).otherwise(F.col(no))
    keyed = rows.select("turn", pick("b", "a").alias("a"), pick("a", "b").alias("b"), pick("j", "i").alias("i"),
                        pick("i", "j").alias("j"), swap.cast("int").alias("side"), "x")
    return keyed.groupBy("turn", "a", "b", "i", "j").applyInPandas(_task(heads, depth, budget, max_bits), "u long, v long")


# ---- components ------------------------------------------------------------------

def components_of(edges: DataFrame) -> DataFrame:
    """``u, v``: every linked node but the smallest of its component, with that smallest."""
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    sign = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star-least")
        large = staged(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u <> v").distinct(), "star-large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "star-least")
        edges = staged(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(least).distinct(), "star")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == sign:
            return edges
        sign = now


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, fingerprint`` (16 hex digits) and ``component_id`` (the smallest id reachable) per row.

    Null text counts as empty: fingerprint zero, linked like any other. A
    null id belongs to its component and is its ``component_id`` only if no
    other id is known. Repeated rows stay. The id may be of any orderable
    type; other columns are not read.
    """
    prints = staged(fingerprints(docs, shingle, id_column, text_column), "simhash-prints")
    distinct = staged(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    stars = components_of(links(distinct.select("fp"), max_bits))
    rooted = staged(distinct.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("root")), "simhash-rooted")
    named = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-named")
    classes = staged(rooted.join(named, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp").select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
