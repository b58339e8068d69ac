"""Repeated windows by a depth-limited radix sort of suffixes.

Two documents repeat each other where suffixes of theirs agree in their first
``WIDTH`` bytes. Suffixes are ordered by most-significant-digit passes, no
deeper than ``WIDTH``; groups that are still equal then are exactly the
repeated windows, and every window whose group holds a smaller document id is
covered.

The first digit is chosen by content, so that Spark can deal suffixes to
tasks without sending them all: of the ``GRAM``-byte strings inside a window
the one with the least hash, the leftmost on ties (equal windows choose
equally). Windows that share a choice are neighbours and travel together as
one *context* (the choice with the bytes around it).

1. Texts are put into compressed chunks, written once.
2. Pass one over the chunks sends the hashes of the choices, 4 bytes each;
   choices seen in one document only are dropped (singletons of the first
   digit). What comes back is a bit per choice, and another for the choices
   that are *crowded*: found more than ``CROWDED`` times in all.
3. Pass two sends the distinct contexts of the choices that are left, with the
   smallest id of the chunk. A task per bucket orders the windows in them by
   8-byte digits, dropping singletons after each pass, and returns a mask of
   the covered windows of each context. A crowded choice (a phrase that many
   documents hold in ever different surroundings) would be one task's work, so
   its windows go one by one, each dealt by all of its bytes: the same window
   still meets itself, and no group grows with the phrase.
4. Pass three lays the masks over the texts and cuts them.

A passage that many documents share reaches its bucket once per chunk, not
once per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import pieces, staged

WIDTH, GRAM = 50, 16
SIDE = WIDTH - GRAM  # bytes a window can have before or after its choice
CONTEXT = WIDTH + SIDE
CHUNK_BYTES = 8 << 20
#: Text bytes that a bucket stands for.
BUCKET_BYTES = 32 << 20
#: Places of a choice beyond which its windows are dealt one by one.
CROWDED = 1 << 17
#: Window starts handled at once, so that the arrays stay in the cache.
SLICE = 1 << 18
#: Contexts ordered at once, unless one choice alone has more.
ITEMS = 1 << 17
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 20) - 1)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:size - width], values[width - size:]) if width > size else values


class Chunk:
    """Whole texts end to end, and the choices of their windows."""

    def __init__(self, blob: bytes, ids: list, sizes: list):
        raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, sum(sizes)))
        self.data = np.frombuffer(raw + bytes(WIDTH + 8), np.uint8)
        self.ids, self.sizes = ids, np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self._choose()

    def _choose(self) -> None:
        """``at`` (places of choices), ``low``/``high`` (first and last window start), ``hash`` and ``doc`` of each."""
        total = len(self.data) - WIDTH - 8
        eight = np.ndarray(total + WIDTH, "<u8", self.data, 0, (1,))
        known = np.array([i is not None for i in self.ids], bool)
        last = np.where(known, self.ends - WIDTH, -1)  # last window start of each text
        found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]]
        for a in range(0, total, SLICE):
            b = min(total, a + SLICE)
            n = b - a + SIDE
            h = (eight[a:a + n] * _M1) ^ (eight[a + 8:a + 8 + n] * _M2)
            h ^= h >> np.uint64(29)
            h *= _M1
            h ^= h >> np.uint64(32)
            chosen = (_least((h & ~_LOW) | np.arange(n, dtype=np.uint64), SIDE + 1) & _LOW).astype(np.int64)
            starts = np.arange(a, b)
            fits = starts <= last[np.searchsorted(self.ends, starts, side="right")]
            starts, chosen = starts[fits], chosen[fits]
            if not len(starts):
                continue
            edge = np.flatnonzero(np.concatenate(([True], (np.diff(chosen) != 0) | (np.diff(starts) != 1))))
            final = np.append(edge[1:], len(starts)) - 1
            found.append([chosen[edge] + a, starts[edge], starts[final], h[chosen[edge]]])
        self.at, self.low, self.high, self.hash = (np.concatenate(c) for c in zip(*found, strict=True))
        self.text = np.searchsorted(self.ends, self.at, side="right")
        self.doc = np.array([i if i is not None else 0 for i in self.ids], np.int64)[self.text]

    def digits(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct first digits ordered by bucket: ``bucket``, ``value``, whether in several documents, and each choice's place among them.

        How often each occurs follows from the places.
        """
        bucket = ((self.hash >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint64)
        both, place = np.unique(bucket << np.uint64(32) | (self.hash & np.uint64(0xFFFFFFFF)), return_inverse=True)
        least, most = np.full(len(both), np.iinfo(np.int64).max), np.full(len(both), np.iinfo(np.int64).min)
        np.minimum.at(least, place, self.doc)
        np.maximum.at(most, place, self.doc)
        return both >> np.uint64(32), both.astype(np.uint32), least != most, place

    def survivors(self, buckets: int, bits: list) -> tuple[np.ndarray, np.ndarray]:
        """The choices whose digit occurs in another document too, and whether each is crowded."""
        bucket, _, _, place = self.digits(buckets)
        keep, crowd = np.zeros(len(bucket), bool), np.zeros(len(bucket), bool)
        for k, packed, crowded in bits:
            a, b = np.searchsorted(bucket, [k, k + 1])
            keep[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
            if crowded:
                crowd[a:b] = np.unpackbits(np.frombuffer(crowded, np.uint8), count=b - a).astype(bool)
        if not len(place):
            return place, np.zeros(0, bool)
        kept = np.flatnonzero(keep[place])
        return kept, crowd[place[kept]]

    def contexts(self, buckets: int, bits: list) -> Contexts:
        """What the chunk sends in pass two, and how to read the answer.

        A record: the context's bytes (zero outside its windows), then the
        first and last distance of a window start before the choice.
        """
        kept, crowd = self.survivors(buckets, bits)
        records = np.zeros((len(kept), CONTEXT + 2 + 8), np.uint8)
        at, low, high = self.at[kept], self.low[kept], self.high[kept]
        bucket = ((self.hash[kept] >> np.uint64(32)) % np.uint64(buckets)).astype(">u8")
        records[:, :8] = bucket.view(np.uint8).reshape(-1, 8)
        for k in range(CONTEXT):
            place = at - SIDE + k
            inside = (place >= low) & (place < high + WIDTH)
            records[inside, 8 + k] = self.data[place[inside]]
        records[:, -2], records[:, -1] = at - high, at - low
        distinct, place = _distinct(records)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, place, self.doc[kept])
        order = distinct[:, :8].copy().view(">u8").ravel().astype(np.int64)
        apart = np.zeros(len(distinct), bool)
        apart[place] = crowd
        return Contexts(order, distinct[:, 8:], least, apart, buckets, self.doc[kept], kept, place)

    def cut(self, kept: np.ndarray, covered: np.ndarray) -> Iterator[tuple]:
        """``id, size, spans, rest`` per text; bit ``j`` of ``covered`` marks the window that starts ``j`` bytes before its choice."""
        delta = np.zeros(len(self.data) + 1, np.int32)
        for j in range(SIDE + 1):
            hit = self.at[kept[(covered >> np.uint64(j)) & np.uint64(1) == 1]] - j
            np.add.at(delta, hit, 1)
            np.add.at(delta, hit + WIDTH, -1)
        gone = np.cumsum(delta[:-1]) > 0
        for i, (size, end) in enumerate(zip(self.sizes.tolist(), self.ends.tolist(), strict=True)):
            mark, text = gone[end - size:end], self.data[end - size:end]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], mark, [False]))))
            yield self.ids[i], size, edge.reshape(-1, 2).tolist(), text[~mark].tobytes()


class Contexts:
    """A chunk's distinct contexts; those of crowded choices as single windows.

    ``bucket``, ``records`` and ``least`` (document) are what is sent, ordered by bucket.
    """

    def __init__(self, bucket: np.ndarray, records: np.ndarray, least: np.ndarray, apart: np.ndarray, buckets: int, docs: np.ndarray,
                 kept: np.ndarray, place: np.ndarray):
        self.docs, self.kept, self.place = docs, kept, place
        self.whole, self.first_doc = records, least
        alone = np.flatnonzero(apart)
        self.window = np.full((len(alone), SIDE + 1), -1)  # of each such context and distance, its place in what is sent
        self.alone = np.full(len(apart), -1)
        self.alone[alone] = np.arange(len(alone))
        windows, owner = [np.zeros((0, 8 + CONTEXT + 2), np.uint8)], []
        for j in range(SIDE + 1):
            own = alone[(records[alone, -2] <= j) & (records[alone, -1] >= j)]
            one = np.zeros((len(own), 8 + CONTEXT + 2), np.uint8)
            one[:, 8 + SIDE - j:8 + CONTEXT - j] = records[own, SIDE - j:CONTEXT - j]
            one[:, -2:] = j
            mixed = np.full(len(own), j, np.uint64)
            for k in range(SIDE - j, CONTEXT - j):
                mixed = (mixed ^ records[own, k]) * _M1
                mixed ^= mixed >> np.uint64(29)
            one[:, :8] = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(">u8").view(np.uint8).reshape(-1, 8)
            windows.append(one)
            owner += [own]
        single, at = _distinct(np.concatenate(windows))
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        lowest = np.full(len(single), np.iinfo(np.int64).max)
        np.minimum.at(lowest, at, least[owner])
        self.bucket = np.concatenate([bucket[~apart], single[:, :8].copy().view(">u8").ravel().astype(np.int64)])
        order = np.argsort(self.bucket, kind="stable")
        self.bucket = self.bucket[order]
        self.records = np.concatenate([records[~apart], single[:, 8:]])[order]
        self.least = np.concatenate([least[~apart], lowest])[order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.sent = np.full(len(apart), -1)
        self.sent[~apart] = back[:int((~apart).sum())]
        begin = 0
        for j in range(SIDE + 1):
            own = alone[(records[alone, -2] <= j) & (records[alone, -1] >= j)]
            self.window[self.alone[own], j] = back[int((~apart).sum()) + at[begin:begin + len(own)]]
            begin += len(own)

    def covered(self, masks: np.ndarray) -> np.ndarray:
        """For each kept choice the mask of its covered windows, from the masks of what was sent.

        A document after the chunk's first one with a context (or a window) repeats it.
        """
        out = np.zeros(len(self.kept), np.uint64)
        sent = self.sent[self.place]
        plain = np.flatnonzero(sent >= 0)
        first, final = (self.whole[self.place[plain], k].astype(np.uint64) for k in (-2, -1))
        every = (np.uint64(1) << (final + np.uint64(1))) - (np.uint64(1) << first)
        out[plain] = np.where(self.docs[plain] > self.first_doc[self.place[plain]], every, masks[sent[plain]])
        single = np.flatnonzero(sent < 0)
        for j in range(SIDE + 1):
            at = self.window[self.alone[self.place[single]], j]
            has = at >= 0
            rows, at = single[has], at[has]
            hit = (self.docs[rows] > self.least[at]) | ((masks[at] >> np.uint64(j)) & np.uint64(1) == 1)
            out[rows] |= hit.astype(np.uint64) << np.uint64(j)
        return out


def _distinct(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in byte order, and each row's place among them."""
    if not len(records):
        return records, np.zeros(0, np.int64)
    rows = np.ascontiguousarray(records).view(np.dtype((np.void, records.shape[1]))).ravel()
    order = np.argsort(rows, kind="stable")
    ordered = records[order]
    first = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1)))
    place = np.empty(len(records), np.int64)
    place[order] = np.cumsum(first) - 1
    return ordered[first], place


def radix_groups(windows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order rows by 8-byte digits, most significant first, within their first group.

    Returns ``(rows, group)`` of the rows that are equal to another one
    through the full width; rows that are alone drop out after each pass.
    """
    rows = np.arange(len(windows))
    digits = np.zeros((len(windows), -(-windows.shape[1] // 8) * 8), np.uint8)
    digits[:, :windows.shape[1]] = windows
    digits = digits.view(">u8").astype(np.uint64)
    for d in range(-1, digits.shape[1]):
        if not len(rows):
            break
        if d >= 0:
            order = np.lexsort((digits[rows, d], group))
            rows, group = rows[order], group[order]
            now = digits[rows, d]
            group = np.cumsum(np.concatenate(([0], (np.diff(group) != 0) | (now[1:] != now[:-1]))))
        else:
            order = np.argsort(group, kind="stable")
            rows, group = rows[order], group[order]
        edge = np.concatenate(([True], np.diff(group) != 0, [True]))
        alone = edge[:-1] & edge[1:]
        rows, group = rows[~alone], group[~alone]
    return rows, group


def covered_windows(records: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each distinct record, by distance ``j``, the least document of the window (rows x (SIDE + 1))."""
    least = np.broadcast_to(docs[:, None], (len(records), SIDE + 1)).copy()
    choice = np.ascontiguousarray(records[:, SIDE:SIDE + GRAM]).view(np.dtype((np.void, GRAM))).ravel()
    order = np.argsort(choice, kind="stable")
    ordered = records[order, SIDE:SIDE + GRAM]
    first = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(axis=1))) if len(order) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    edges = np.append(np.flatnonzero(first), len(order))
    begin = 0
    while begin < len(order):
        end = int(edges[max(np.searchsorted(edges, begin + ITEMS, side="right") - 1, np.searchsorted(edges, begin, side="right"))])
        mine, own = order[begin:end], group[begin:end]
        for j in range(SIDE + 1):
            has = np.flatnonzero((records[mine, -2] <= j) & (records[mine, -1] >= j))
            rows, equal = radix_groups(records[mine[has], SIDE - j:CONTEXT - j], own[has])
            if len(rows):
                start = np.flatnonzero(np.concatenate(([True], np.diff(equal) != 0)))
                items = mine[has[rows]]
                lowest = np.minimum.reduceat(docs[items], start)
                least[items, j] = np.repeat(lowest, np.diff(np.append(start, len(items))))
        begin = end
    return least


# ---- Spark -----------------------------------------------------------------------

def _chunks(docs: DataFrame, id_column: str, text_column: str, chunk_bytes: int) -> DataFrame:
    out = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, texts, held, n
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            batch = pa.record_batch([[part << 32 | n], [ids], [[len(t) for t in texts]], [blob]], schema=out)
            ids, texts, held, n = [], [], 0, n + 1
            return batch

        for batch in pieces(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                texts.append((text or "").encode())
                held += len(texts[-1])
                if held >= chunk_bytes:
                    yield close()
        if ids:
            yield close()

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "chunk long, ids array<long>, sizes array<long>, blob binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _send_digits(buckets: int):
    out = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("digits", pa.binary()), ("several", pa.binary()), ("often", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for row in _rows(batches):
            bucket, value, several, place = Chunk(row["blob"], row["ids"], row["sizes"]).digits(buckets)
            often = np.bincount(place, minlength=len(bucket)).astype("<u4")
            here = np.unique(bucket)
            edges = np.append(np.searchsorted(bucket, here), len(bucket)).tolist()
            cut = list(zip(edges[:-1], edges[1:], strict=True))
            yield pa.record_batch([here.astype(np.int64), [row["chunk"]] * len(here), [value[a:b].astype("<u4").tobytes() for a, b in cut],
                                   [np.packbits(several[a:b]).tobytes() for a, b in cut],
                                   [squeeze(often[a:b].tobytes()) for a, b in cut]], schema=out)

    return run


def _repeated_digits(crowded: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        open_ = zstandard.ZstdDecompressor().decompress
        values = [np.frombuffer(d, "<u4") for d in rows["digits"]]
        size = [len(v) for v in values]
        keep = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n).astype(bool) for s, n in zip(rows["several"], size, strict=True)])
        often = np.concatenate([np.frombuffer(open_(o), "<u4") for o in rows["often"]]).astype(np.int64)
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        same = every[order[1:]] == every[order[:-1]]
        keep[order[1:][same]] = keep[order[:-1][same]] = True
        start = np.flatnonzero(np.concatenate(([True], ~same))) if len(every) else np.zeros(0, np.int64)
        crowd = np.zeros(len(every), bool)
        if len(every):
            crowd[order] = np.repeat(np.add.reduceat(often[order], start) > crowded, np.diff(np.append(start, len(every))))
        ends = np.cumsum(size)
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"],
                             "bits": [np.packbits(keep[e - n:e]).tobytes() for e, n in zip(ends, size, strict=True)],
                             "crowded": [np.packbits(crowd[e - n:e]).tobytes() if crowd[e - n:e].any() else None for e, n in zip(ends, size, strict=True)]})

    return run


def _bits(row: dict) -> list:
    return [(b["bucket"], b["bits"], b["crowded"]) for b in row["found"] or ()]


def _send_contexts(buckets: int):
    out = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("packed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for row in _rows(batches):
            found = Chunk(row["blob"], row["ids"], row["sizes"]).contexts(buckets, _bits(row))
            bucket, records, least = found.bucket, found.records, found.least
            here = np.unique(bucket)
            edges = np.append(np.searchsorted(bucket, here), len(bucket)).tolist()
            cut = list(zip(edges[:-1], edges[1:], strict=True))
            yield pa.record_batch([here, [row["chunk"]] * len(here), [b - a for a, b in cut],
                                   [squeeze(least[a:b].astype("<i8").tobytes() + records[a:b].tobytes()) for a, b in cut]], schema=out)

    return run


def _cover(rows: pd.DataFrame) -> pd.DataFrame:
    open_ = zstandard.ZstdDecompressor().decompress
    docs, records = [], []
    for n, packed in zip(rows["n"], rows["packed"], strict=True):
        raw = open_(packed)
        docs.append(np.frombuffer(raw, "<i8", n))
        records.append(np.frombuffer(raw, np.uint8, offset=8 * n).reshape(n, CONTEXT + 2))
    docs, records = np.concatenate(docs), np.concatenate(records)
    distinct, place = _distinct(records)
    lowest = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(lowest, place, docs)
    least = covered_windows(distinct, lowest)
    masks = np.zeros(len(docs), np.uint64)
    for j in range(SIDE + 1):
        has = (records[:, -2] <= j) & (records[:, -1] >= j)
        masks |= (has & (least[place, j] < docs)).astype(np.uint64) << np.uint64(j)
    ends = np.cumsum(rows["n"].to_numpy())
    squeeze = zstandard.ZstdCompressor(level=3).compress
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"],
                         "masks": [squeeze(masks[e - n:e].tobytes()) for e, n in zip(ends, rows["n"], strict=True)]})


def _cut(buckets: int):
    out = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for row in _rows(batches):
            chunk = Chunk(row["blob"], row["ids"], row["sizes"])
            found = chunk.contexts(buckets, _bits(row))
            masks = np.zeros(len(found.bucket), np.uint64)
            for m in row["covered"] or ():
                a, b = np.searchsorted(found.bucket, [m["bucket"], m["bucket"] + 1])
                masks[a:b] = np.frombuffer(open_(m["masks"]), np.uint64)
            rows, held = [], 0
            for i, size, spans, rest in chunk.cut(found.kept, found.covered(masks)):
                rows.append((i, size, [{"start": a, "end": b} for a, b in spans], rest))
                held += len(rest)
                if held > CHUNK_BYTES:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)

    return run


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK_BYTES,
                   crowded: int = CROWDED) -> DataFrame:
    """``id, n_bytes, spans, kept`` per row: what is cut from the UTF-8 bytes, and the bytes that stay.

    A byte goes if a 50-byte window over it also starts in a document with a
    smaller id, judged on the input. Null text: empty. A null id is neither
    smaller nor larger than any other: its row stays whole and covers no
    other. Rows that repeat an id are one document's, for that comparison.
    Texts under 50 bytes stay. Other columns are not read.
    """
    spark = docs.sparkSession
    chunks = staged(_chunks(docs, id_column, text_column, chunk_bytes), "repeats-chunks")
    total = chunks.select(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("n")).agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    digits = chunks.mapInArrow(_send_digits(buckets), "bucket long, chunk long, digits binary, several binary, often binary")
    bits = digits.groupBy("bucket").applyInPandas(_repeated_digits(crowded), "chunk long, bucket long, bits binary, crowded binary")
    found = staged(bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "crowded")).alias("found")), "repeats-digits")
    marked = chunks.join(found, "chunk", "left")
    contexts = marked.mapInArrow(_send_contexts(buckets), "bucket long, chunk long, n long, packed binary")
    masks = contexts.groupBy("bucket").applyInPandas(_cover, "chunk long, bucket long, masks binary")
    covered = staged(masks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "masks")).alias("covered")), "repeats-masks")
    return marked.join(covered, "chunk", "left").mapInArrow(
        _cut(buckets), "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
