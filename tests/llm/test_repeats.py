import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapipe.llm import repeats
from terrapipe.llm.repeats import radix_groups, remove_repeats


def brute(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            if i is not None:
                w = b[s:s + 50]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - 49):
            if i is not None and first[b[s:s + 50]] < i:
                gone[s:s + 50] = [True] * 50
        edges = [k for k in range(len(b) + 1) if (k < len(b) and gone[k]) != (k > 0 and gone[k - 1])]
        out.append((i, len(b), list(zip(edges[::2], edges[1::2], strict=True)), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(map(repr, out))


def found(df, **options):
    return sorted(repr((r.id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept))) for r in remove_repeats(df, **options).collect())


def test_radix_groups():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 2, (300, 11)).astype(np.uint8)
    windows[rng.integers(0, 300, 80)] = windows[0]
    group = rng.integers(0, 3, 300)
    rows, equal = radix_groups(windows, group)
    want = {}
    for i in range(300):
        want.setdefault((group[i], windows[i].tobytes()), []).append(i)
    got = {}
    for r, g in zip(rows.tolist(), equal.tolist(), strict=True):
        got.setdefault(g, []).append(r)
    assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)


@pytest.mark.parametrize("seed,alphabet", [(0, "ab"), (1, "abcdefghij \n"), (2, "a"), (3, "aéß日 ")])
def test_against_brute_force(spark, monkeypatch, seed, alphabet):
    monkeypatch.setattr(repeats, "SLICE", 1000)  # texts reach over slices
    rng = random.Random(seed)
    passages = ["".join(rng.choices(alphabet, k=rng.randint(30, 200))) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(rng.randint(0, 6))]
        rows.append((rng.choice([None, *range(-5, 40)]), "".join(parts) if k % 13 else None))
    rows += [rows[3], rows[3], (99, "".join(passages) * 8), (100, "".join(passages) * 8), (101, rows[5][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, chunk string").repartition(4)
    want = brute(rows)
    for crowded in (repeats.CROWDED, 0, 5):  # no choice dealt window by window, all, some
        assert found(df, chunk_bytes=1500, crowded=crowded) == want


def test_a_phrase_of_many_documents_is_not_one_task(spark):
    """A third of the documents hold one phrase in ever different surroundings: the same result, its windows dealt to all buckets."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    phrase = "terms and conditions apply to all of this"
    rows = [(k, noise(90) + (phrase + noise(60) if k % 3 == 0 else noise(80))) for k in range(600)]
    rows += [(1000 + k, rows[3 * k][1][40:]) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    chunks = repeats.staged(repeats._chunks(df, "doc_id", "text", 4000), "test-chunks")

    def largest(crowded):
        shape = "bucket long, chunk long, digits binary, several binary, often binary"
        bits = chunks.mapInArrow(repeats._send_digits(8), shape).groupBy("bucket").applyInPandas(
            repeats._repeated_digits(crowded), "chunk long, bucket long, bits binary, crowded binary")
        marked = chunks.join(bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits", "crowded")).alias("found")), "chunk", "left")
        sent = marked.mapInArrow(repeats._send_contexts(8), "bucket long, chunk long, n long, packed binary").groupBy("bucket").agg(F.sum("n").alias("n"))
        sizes = [r.n for r in sent.collect()]
        return max(sizes) / sum(sizes)

    assert largest(10 ** 9) > 0.3 and largest(50) < 0.2
    want = brute(rows)
    assert found(df, chunk_bytes=4000, crowded=50) == want == found(df, chunk_bytes=4000)


def test_edge_cases(documents, empty):
    rows = [(r.doc_id, r.text if r.doc_id != 7 else None) for r in documents.collect()]
    assert found(documents.where("doc_id is null or doc_id <> 7"), chunk_bytes=1000) == brute([r for r in rows if r[0] != 7])
    alone = remove_repeats(documents.where("doc_id = 7")).first()  # a long run within one document stays
    assert alone.n_bytes == 300_000 and alone.spans == [] and len(alone.kept) == 300_000
    assert found(empty) == []


def test_query(spark, sf_small):
    import hashlib

    from terrapipe.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)
    whole = {r.doc_id: r for r in QUERIES["op7_repeats"](spark, sf_small).collect()}
    for r in remove_repeats(spark.read.parquet(f"{sf_small}/documents.parquet")).collect():
        q = whole[r.id]
        assert (q.n_bytes, q.n_removed, q.n_spans, q.kept_sha256) == (
            r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
