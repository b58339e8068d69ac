"""Packing by power-of-two decomposition.

A document of ``n`` tokens is cut into pieces whose lengths are powers of
two: as many of ``max_len`` as fit, then the binary digits of the rest, the
longest first. Each piece is a sequence of its own, so no sequence crosses
documents, none is padded, and pieces of one length form a bucket that a
trainer reads in batches of one shape.

Narrow: no shuffle, no state beyond one Arrow batch. The length of a bucket
is a partition folder on disk (:func:`write_buckets`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import pieces
from terrapipe.llm.tokens import encoder

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def decompose(n: int, max_len: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens."""
    out = [(i, max_len) for i in range(0, n - n % max_len, max_len)]
    start, bit = n - n % max_len, max_len >> 1
    while bit:
        if n & bit:
            out.append((start, bit))
            start += bit
        bit >>= 1
    return out


def pack(docs: DataFrame, vocabulary: str, max_len: int = 2048, end_id: int = 1,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per sequence: ``sequence_id, doc_id, start, length, offset, doc_tokens, ids``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers,
    ``length`` is the bucket, ``start`` counts the document's ids before the
    piece, ``offset`` the ids before it in its sequence (always 0).
    ``sequence_id`` is unique and rises within a partition.

    Null text: the empty text, one sequence holding ``end_id``. A null id
    stays null; repeated rows are separate documents; other columns are
    ignored, whatever their names. ``max_len`` must be a power of two.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in pieces(batches, "text"):
            rows: list[list] = [[], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                ids += end
                n = len(ids) // 4
                for start, length in decompose(n, max_len):
                    for column, value in zip(rows, (doc, start, length, n, ids[4 * start:4 * (start + length)]), strict=True):
                        column.append(value)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, _SCHEMA, strict=True)], schema=_SCHEMA)

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return source.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, ids binary").select(
        F.monotonically_increasing_id().alias("sequence_id"), "doc_id", "start", "length",
        F.lit(0).cast("long").alias("offset"), "doc_tokens", "ids")


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write one folder per sequence length, ``bucket=<length>``."""
    packed.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
