"""Collocated phrases of a corpus, per language, by external count streams.

Method, as estimators of large n-gram models lay their counts out: words become
numbers, every count stream is a sorted run of numbers, and counts of parts
meet counts of wholes by merging sorted streams, never by probing a table.

1. A task cuts its texts into chunks of some MB per language. A chunk is its
   distinct words, their counts, and the text as a stream of word codes in
   which 0 marks the edge of a piece (:func:`_chunks`).
2. Words are summed over the chunks. Only words seen ``min_count`` times can
   stand in a phrase that is, so only they get numbers; the numbers return to
   each chunk's stream (:func:`_numbered`), in which other words become edges.
3. A chunk sorts its two- and three-word sequences, each to a run of sequence
   and count, and sends a delta-coded piece of the run to each shard. A shard
   merges its pieces and keeps the sequences seen ``min_count`` times
   (:func:`_counted`). Shards hold some 2 million entries whatever the data, as
   a sequence's shard follows from all its words.
4. The streams of counts are merge-joined in prefix order (a phrase with its
   first words, its extensions to the right) and in suffix order (a phrase with
   its last words, its extensions to the left): :func:`collocations`.

Bounds: a task holds a chunk (``chunk_bytes`` of text, or one longer piece) or a
shard. A word or a phrase that holds a third of the text is one entry of each
chunk's run. A first word with very many successors is a skewed side of a
merge join, which adaptive execution splits; the other side has one row for it.
Each chunk sends a piece to each shard it touches, so ``chunk_bytes`` should
rise with the corpus (as the executors' memory allows) to keep pieces long.
Words seen ``min_count`` times must be fewer than 2**32.

Defined results: a null text is empty; a null language is ``und`` (together
with rows that name it so); empty texts, repeated rows and repeated ids count
as they are; an empty table has no phrases; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapipe.llm.shared import staged

#: Bytes that end a piece; with the space (and the tab) they end words.
EDGES = b".,;:!?\n\x0b\x0c\r"
#: Byte to byte: lower case, one edge, one blank.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[list(EDGES)] = 10
FOLDED[9] = 32

CHUNKS = "chunk long, lang string, n long, words array<string>, counts array<long>, codes binary"
RUNS = "shard int, size int, pairs binary, thirds binary, counts binary"
SEQUENCES = "x long, y long, z long, a long"
#: Entries of a shard, about.
SHARD = 2_000_000
#: Parts in which a language's candidates are ranked first.
PARTS = 64


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def words_of(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a text in their order, and for each whether it begins a piece."""
    folded = FOLDED[np.frombuffer(text, np.uint8)]
    edge = folded == 10
    inside = ~(edge | (folded == 32))
    bounds = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = bounds[::2], bounds[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(folded[inside])])
    pieces = np.cumsum(edge, dtype=np.int32)[starts]
    return words, np.diff(pieces, prepend=-1) != 0


def parts_of(text: bytes, limit: int) -> Iterator[bytes]:
    """A text longer than ``limit`` in parts that end at edges of pieces; a longer piece stays whole."""
    while len(text) > limit:
        cut = max(text.rfind(e, 0, limit) for e in EDGES)
        if cut < 0:
            cut = min((at for at in (text.find(e, limit) for e in EDGES) if at >= 0), default=len(text) - 1)
        yield text[:cut + 1]
        text = text[cut + 1:]
    if text:
        yield text


def _chunk(number: int, lang: str, texts: list[bytes]) -> pa.RecordBatch:
    words, first = words_of(b"\n".join(texts))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    stream = np.zeros(len(codes) + int(first.sum()), np.uint32)
    stream[np.arange(len(codes)) + np.cumsum(first)] = codes + 1
    counts = np.bincount(codes, minlength=len(coded.dictionary)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([lang]), pa.array([len(codes)]),
         pa.ListArray.from_arrays([0, len(counts)], coded.dictionary),
         pa.ListArray.from_arrays([0, len(counts)], pa.array(counts)), pa.array([packed(stream)])],
        ["chunk", "lang", "n", "words", "counts", "codes"])


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                for part in parts_of(text.as_py(), chunk_bytes):
                    if size + len(part) > chunk_bytes and size:
                        for key, texts in held.items():
                            yield _chunk(number, key, texts)
                            number += 1
                        held, size = {}, 0
                    held.setdefault(lang, []).append(part)
                    size += len(part)
        for key, texts in held.items():
            yield _chunk(number, key, texts)
            number += 1

    source = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(cut, CHUNKS)


def _vocabulary(chunks: DataFrame, min_count: int) -> DataFrame:
    """The words seen ``min_count`` times: lang, word, f and a number from 1."""
    counted = (chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
               .groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
               .where(F.col("f") >= min_count))
    placed = staged(counted.withColumn("place", F.monotonically_increasing_id()), "phrase-words")
    task = F.shiftright("place", 33)
    tasks = placed.groupBy(task.alias("task")).agg(F.max("place").alias("last"))
    size = F.col("last").bitwiseAND((1 << 33) - 1) + 1
    starts = tasks.select("task", (F.sum(size).over(Window.orderBy("task")) - size).alias("before"))  # a row per write task
    return placed.withColumn("task", task).join(starts, "task").select(
        "lang", "word", "f", (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).alias("id"))


def _numbered(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """Each chunk's stream in the words' numbers; 0 is the edge of a piece or a rare word."""
    spelled = chunks.select("chunk", "lang", F.posexplode("words").alias("code", "word"))
    numbers = spelled.join(words.select("lang", "word", "id").hint("merge"), ["lang", "word"]).select("chunk", "code", "id")

    def renumber(stream: pa.Table, found: pa.Table) -> pa.Table:
        codes = unpacked(stream.column("codes")[0].as_py(), "<u4")
        ids = np.zeros(int(codes.max(initial=0)) + 1, np.uint32)
        ids[found.column("code").to_numpy() + 1] = found.column("id").to_numpy()
        ids = ids[codes]
        ids = ids[(ids > 0) | (np.roll(ids, 1) > 0)]  # edges next to edges say nothing
        return pa.table({"ids": pa.array([packed(ids)])})

    # a chunk without words has no stream worth a row
    texts = chunks.where("n > 0").select(F.col("chunk").alias("of"), "codes").groupBy("of")
    return texts.cogroup(numbers.groupBy("chunk")).applyInArrow(renumber, "ids binary")


def _shard_of(pairs: np.ndarray, thirds: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each sequence, from all its words: no first word or pair can crowd one."""
    mixed = (pairs ^ (thirds.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.uint32)


def _merged(pairs: np.ndarray, thirds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal sequences summed, in order of their first pair and third word."""
    firsts, rank = np.unique(pairs, return_inverse=True)
    keys = rank.astype(np.uint64) << np.uint64(32) | thirds
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
    sums = np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return firsts[keys[at] >> np.uint64(32)], (keys[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32), sums


def _runs(ids: np.ndarray, shards: int) -> Iterator[tuple]:
    """The sorted runs of one stream's pairs (third word 0) and triples, a piece per shard."""
    wide = ids.astype(np.uint64)
    pairs = wide[:-1] << np.uint64(32) | wide[1:]
    whole = (ids[:-1] > 0) & (ids[1:] > 0)
    third = np.append(ids[2:], np.uint32(0))
    three = whole & (third > 0)
    for first, last in ((pairs[whole], np.zeros(int(whole.sum()), np.uint32)), (pairs[three], third[three])):
        first, last, counts = _merged(first, last, np.ones(len(first), np.int64))
        shard = _shard_of(first, last, shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[k]:cuts[k + 1]]
            yield int(k), len(at), packed(np.diff(first[at], prepend=np.uint64(0))), packed(last[at]), packed(counts[at])


def _counted(streams: DataFrame, shards: int, min_count: int) -> DataFrame:
    """Sequences of two (``z`` is 0) and three words seen ``min_count`` times."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("ids"):
                if rows := list(_runs(unpacked(data.as_py(), "<u4"), shards)):
                    shard, size, pairs, thirds, counts = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard, pa.int32()), pa.array(size, pa.int32()), pa.array(pairs, pa.binary()),
                         pa.array(thirds, pa.binary()), pa.array(counts, pa.binary())], RUN_NAMES)

    def merge(run: pa.Table) -> pa.Table:
        pairs, thirds, counts = _merged(*(
            np.concatenate([read(x.as_py()) for x in run.column(name)]) for name, read in (
                ("pairs", lambda x: np.cumsum(unpacked(x, "<u8"), dtype=np.uint64)), ("thirds", lambda x: unpacked(x, "<u4")),
                ("counts", lambda x: unpacked(x, "<i8")))))
        often = counts >= min_count
        pairs = pairs[often]
        return pa.table({"x": (pairs >> np.uint64(32)).astype(np.int64), "y": (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64),
                         "z": thirds[often].astype(np.int64), "a": counts[often]})

    return streams.mapInArrow(runs, RUNS).groupBy("shard").applyInArrow(merge, SEQUENCES)


RUN_NAMES = [field.split()[0] for field in RUNS.split(", ")]


def _score(left, right):
    """floor(1,000,000 a² / (left right)), exactly; a part is at least as frequent as the whole, so the quotient fits."""
    wide = [F.col(c).cast("decimal(15,0)") for c in ("a", left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, min_count: int = 10, inside_percent: int = 50, top: int = 2000,
                 chunk_bytes: int = 8 << 20) -> DataFrame:
    """The ``top`` phrases of two and three words of each language.

    ``docs`` has ``lang`` and ``text``. Returns lang, rank, phrase, a (its
    count), l and r (the counts of the parts at its weakest cut), n (words of
    the language) and score. A phrase inside a longer one that holds at least
    ``inside_percent`` of its occurrences is left out.
    """
    chunks = staged(_chunks(docs, chunk_bytes), "phrase-chunks")
    words = staged(_vocabulary(chunks, min_count), "phrase-numbers")
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    n, most = chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], words.agg(F.max("id")).first()[0] or 0
    if most >= 1 << 32:
        raise ValueError(f"{most} words are seen {min_count} times; numbers end at 2**32")
    streams = staged(_numbered(chunks, words), "phrase-streams")
    found = staged(_counted(streams, 2 * n // SHARD + 1, min_count), "phrase-counts")

    def word(key: str, count: str, text: str, *more: str) -> DataFrame:
        return words.select(F.col("id").alias(key), F.col("f").alias(count), F.col("word").alias(text), *more).hint("merge")

    pairs, triples = found.where("z = 0").drop("z"), found.where("z > 0")
    # pairs in prefix order meet their first word, in suffix order their last
    pairs = staged(pairs.join(word("x", "l", "w1", "lang"), "x").join(word("y", "r", "w2"), "y").select(
        "lang", "x", "y", "a", "l", "r", F.concat_ws(" ", "w1", "w2").alias("phrase")), "phrase-pairs")
    longer = (triples.groupBy("x", "y").agg(F.max("a").alias("most"))  # extensions to the right, then to the left
              .unionByName(triples.groupBy(F.col("y").alias("x"), F.col("z").alias("y")).agg(F.max("a").alias("most")))
              .groupBy("x", "y").agg(F.max("most").alias("most")))
    two = (pairs.join(longer.hint("merge"), ["x", "y"], "left")
           .where(F.coalesce(100 * F.col("most") < inside_percent * F.col("a"), F.lit(True)))
           .select("lang", "phrase", "a", "l", "r", _score("l", "r").alias("score")))
    # triples in prefix order meet their first word and first pair, in suffix order their last word and last pair
    three = (triples.join(word("x", "l1", "w1", "lang"), "x")
             .join(pairs.select("x", "y", F.col("a").alias("l2"), F.col("phrase").alias("w12")).hint("merge"), ["x", "y"])
             .join(pairs.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("r1")).hint("merge"), ["y", "z"])
             .join(word("z", "r2", "w3"), "z")
             .withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")}))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w12", "w3").alias("phrase"), "a",
                         F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                         F.least("s1", "s2").alias("score"))
    # a language's best are among the best of its parts, so no task ranks all candidates of a language
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = two.unionByName(three).withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = staged(best.where(F.col("rank") <= top).drop("part", "rank"), "phrase-best")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
