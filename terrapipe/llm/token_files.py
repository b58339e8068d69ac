"""Token-id files compressed by Re-Pair.

A shard file holds the ids of consecutive whole documents. Frequent pairs of
neighbouring symbols are replaced by new symbols (nonterminals), again and
again; the file stores the rules, each rule's expansion length, and the
shortened sequence. The expansion lengths locate any range of ids in the
sequence, so a document is decoded without the ones before it
(:meth:`Shard.ids`).

Layout, little-endian: ``RPR1``; part, shard, documents, rules, symbols,
first nonterminal, width of a symbol (2 or 4) as u32; ids of the part before
this shard and ids in the shard as u64; document ids i64, their known flags
u8, document lengths u64; rules as (left, right) u32; expansion lengths u32;
the sequence.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.llm.shared import PartFiles, is_committed, pieces, staged
from terrapipe.llm.tokens import encoder
from terrapipe.session import run_dir

MAGIC = b"RPR1"
HEAD = struct.Struct("<4s7I2Q")
SLOTS = 18
_SPREAD = np.uint32(0x9E3779B1)


def repair(ids: np.ndarray, first: int, rules: int = 16_000, least: int = 16, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, rules)``: ``first + k`` in the sequence stands for the two symbols of rule ``k``.

    A round replaces all pairs that occur ``least`` times or more, the most
    frequent first, as far as ``rules`` allows; of occurrences that overlap
    every second one is taken. Rounds end when one saves less than 1 %.
    """
    wide = np.uint64 if first + rules > 1 << 16 else np.uint32
    shift = wide(32 if wide is np.uint64 else 16)
    seq, made = ids.astype(wide), [np.zeros((0, 2), np.uint32)]
    count = 0
    for _ in range(rounds):
        if len(seq) < 2 * least or count >= rules:
            break
        keys = (seq[:-1] << shift) | seq[1:]
        order = np.sort(keys)
        edges = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1], [True])))
        often = np.diff(edges)
        found = np.flatnonzero(often >= least)
        if not len(found):
            break
        found = found[np.argsort(-often[found], kind="stable")][:rules - count]
        pairs = order[edges[found]]
        slot = _slot(pairs)
        pairs = pairs[np.sort(np.unique(slot, return_index=True)[1])]  # a slot's later pairs wait for another round
        table = np.full(1 << SLOTS, -1, np.int32)
        table[_slot(pairs)] = np.arange(len(pairs))
        rule = table[_slot(keys)]
        at = np.flatnonzero(rule >= 0)
        at = at[pairs[rule[at]] == keys[at]]
        fresh = np.concatenate(([True], np.diff(at) != 1))
        begin = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        at = at[(at - begin) % 2 == 0]
        used = np.bincount(rule[at], minlength=len(pairs))
        worth = used >= least // 2
        at = at[worth[rule[at]]]
        if not len(at):
            break
        number = np.cumsum(worth) - 1 + first + count
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        before, seq[at] = len(seq), number[rule[at]]
        seq = seq[keep]
        pairs = pairs[worth]
        made.append(np.column_stack([pairs >> shift, pairs & ((wide(1) << shift) - wide(1))]).astype(np.uint32))
        count += len(pairs)
        if before - len(seq) < before // 100:
            break
    return seq, np.concatenate(made)


def _slot(keys: np.ndarray) -> np.ndarray:
    low = keys.astype(np.uint32) ^ (keys >> np.uint64(32)).astype(np.uint32) * np.uint32(0x85EBCA6B) if keys.dtype == np.uint64 else keys
    return (low * _SPREAD) >> np.uint32(32 - SLOTS)


def lengths_of(rules: np.ndarray, first: int) -> np.ndarray:
    """The expansion length of each rule (rules refer to earlier ones only)."""
    size = [1] * len(rules)
    for k, (a, b) in enumerate(rules.tolist()):
        size[k] = (size[a - first] if a >= first else 1) + (size[b - first] if b >= first else 1)
    return np.array(size, np.uint32)


def shard_bytes(part: int, number: int, before: int, docs: list[int | None], lengths: list[int], ids: np.ndarray, first: int) -> bytes:
    seq, rules = repair(ids, first)
    width = 2 if first + len(rules) <= 1 << 16 and (not len(ids) or int(ids.max()) < 1 << 16) else 4
    return b"".join([
        HEAD.pack(MAGIC, part, number, len(docs), len(rules), len(seq), first, width, before, len(ids)),
        np.array([d or 0 for d in docs], "<i8").tobytes(), np.array([d is not None for d in docs], "u1").tobytes(),
        np.array(lengths, "<u8").tobytes(), rules.astype("<u4").tobytes(), lengths_of(rules, first).astype("<u4").tobytes(),
        seq.astype(f"<u{width}").tobytes()])


class Shard:
    """One file's content; decodes any range of its ids."""

    def __init__(self, data: bytes):
        magic, self.part, self.number, n, rules, symbols, self.first, width, self.before, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        docs, known = take("<i8", n), take("u1", n)
        self.docs = [d if k else None for d, k in zip(docs.tolist(), known.tolist(), strict=True)]
        self.lengths = take("<u8", n).astype(np.int64)
        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.sizes = take("<u4", rules).astype(np.int64)
        self.sequence = take(f"<u{width}", symbols).astype(np.int64)
        if at != len(data) or int(self.lengths.sum()) != self.n_ids:
            raise ValueError("the token file is cut off or damaged")
        size = np.concatenate((np.ones(self.first, np.int64), self.sizes))
        self.ends = np.cumsum(size[self.sequence])
        if symbols and self.ends[-1] != self.n_ids:
            raise ValueError("the expansion lengths do not fit the file")
        self.size, self.flat = size, None

    def _expansions(self) -> np.ndarray:
        """All symbols' expansions end to end: the terminals, then the rules."""
        if self.flat is None:
            starts = np.cumsum(self.size) - self.size
            flat = np.empty(int(self.size.sum()), np.uint32)
            flat[:self.first] = np.arange(self.first)
            place, size = starts.tolist(), self.size.tolist()
            for k, (a, b) in enumerate(self.rules.tolist(), self.first):
                at, n = place[k], size[a]
                flat[at:at + n] = flat[place[a]:place[a] + n]
                flat[at + n:at + n + size[b]] = flat[place[b]:place[b] + size[b]]
            self.starts, self.flat = starts, flat
        return self.flat

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids ``begin`` to ``end`` of the shard; only the symbols over them are expanded."""
        if begin >= end:
            return np.zeros(0, "<u4")
        flat = self._expansions()
        low, high = np.searchsorted(self.ends, [begin, end - 1], side="right")
        symbols = self.sequence[low:high + 1]
        size = self.size[symbols]
        stop = np.cumsum(size)
        out = flat[np.repeat(self.starts[symbols] - (stop - size), size) + np.arange(stop[-1])]
        skip = begin - (int(self.ends[low]) - int(size[0]))
        return out[skip:skip + end - begin].astype("<u4", copy=False)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, shard_ids: int = 1 << 20,
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode whole texts and write them in ascending id order; a row per file: ``part, attempt, file, documents, ids``.

    Documents are range-partitioned by id (null first; repeated ids by their
    place in the input, so that they too can be split); a partition closes a
    file at ``shard_ids`` ids.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    out = pa.schema([("part", pa.int64()), ("attempt", pa.int64()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        first = max(code.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        parts = PartFiles(folder, ".rpt")
        files, docs, held, n, before = [], [], [], 0, 0

        def close() -> None:
            nonlocal docs, held, n, before
            ids = np.frombuffer(b"".join(held), "<u4")
            content = shard_bytes(parts.part, len(files), before, docs, [len(h) // 4 for h in held], ids, first)
            files.append((parts.part, parts.attempt, parts.write(content), len(docs), n))
            docs, held, n, before = [], [], 0, before + n

        for batch in pieces(batches, "text"):
            for doc, ids in zip(batch.column(0).to_pylist(), code.encode(batch.column(1)), strict=True):
                docs.append(doc)
                held.append(ids + end)
                n += len(held[-1]) // 4
                if n >= shard_ids:
                    close()
        if docs:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(out.names, f, strict=True)) for f in files], schema=out)

    return rows.mapInArrow(write, "part long, attempt long, file string, documents long, ids long")


def read_token_files(spark: SparkSession, folder: str, totals: dict[int, int], attempts: dict[int, int]) -> DataFrame:
    """Every document from the files in ``folder``: ``doc_id, start, n_tokens, ids`` (little-endian u32).

    ``totals`` gives the ids of each part, ``attempts`` the attempt that Spark
    committed, one number each per write task; ``start`` counts the ids of all
    documents before.
    """
    size = max(totals, default=-1) + 1
    base = np.zeros(size + 1, np.int64)
    for part, n in totals.items():
        base[part + 1] = n
    shipped = spark.sparkContext.broadcast(np.cumsum(base))
    names = ["doc_id", "start", "n_tokens", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                if not is_committed(path.as_py(), attempts):
                    continue
                shard = Shard(content.as_py())
                begin, at = int(shipped.value[shard.part]) + shard.before, 0
                rows, held = [], 0
                every = shard.ids(0, shard.n_ids).tobytes()
                for doc, n in zip(shard.docs, shard.lengths.tolist(), strict=True):
                    rows.append((doc, begin + at, n, every[4 * at:4 * (at + n)]))
                    at, held = at + n, held + 4 * n
                    if held > 8 << 20:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rpt").load(folder)
    return files.select("path", "content").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, **options) -> DataFrame:
    """Write the files into a fresh shared folder and read every document back.

    Null text: the empty text, one ``end_id``. An empty table gives no file
    and no row. Columns but the id and the text are ignored.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "token-files") + "/shards"
    written = staged(write_token_files(docs, folder, vocabulary, end_id, **options), "token-manifest")
    tasks = written.groupBy("part", "attempt").agg(F.sum("ids").alias("n")).collect()  # a row per write task
    if not tasks:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    return read_token_files(spark, folder, {r["part"]: r["n"] for r in tasks}, {r["part"]: r["attempt"] for r in tasks})
