import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import WORDS
from terrapipe.llm import simhash
from terrapipe.llm.simhash import components_of, fingerprint, links, near_duplicates, trie_links


def brute_fingerprint(text, k):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c d", "a b c d e", "ÄÖ É x y z \x85q", "the same " * 50])
def test_fingerprint(text):
    assert fingerprint(text, 4) % (1 << 64) == brute_fingerprint(text, 4)


def brute_components(values, bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def clustered(rng, n):
    centres = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    return sorted({c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in rng.choice(centres, n).tolist()}
                  | {int(x) for x in rng.integers(0, 1 << 63, n // 2)} | {0, (1 << 64) - 1, 1 << 63})


def test_trie_finds_every_pair():
    values = np.array(clustered(np.random.default_rng(3), 300), np.uint64)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 4}
    got = {(int(a), int(b)) for i, j in trie_links(values, None, 0, 0, 0, 4) for a, b in zip(i, j, strict=True)}
    assert got == want
    left, right = values[::2], values[1::2]
    cross = {(int(a), int(b)) for i, j in trie_links(left, right, 0, 0, 0, 4) for a, b in zip(i, j, strict=True)}
    assert cross == {(i, j) for i in range(len(left)) for j in range(len(right)) if int(left[i] ^ right[j]).bit_count() <= 4}


@pytest.mark.parametrize("bits,node,block", [(4, 16, 10_000), (4, 64, 8), (3, 16, 20), (0, 16, 50)])
def test_components_with_split_nodes(spark, monkeypatch, bits, node, block):
    monkeypatch.setattr(simhash, "NODE", node)
    monkeypatch.setattr(simhash, "BLOCK", block)
    values = clustered(np.random.default_rng(bits), 250)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    stars = components_of(links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits)).collect()
    root = {r.u % (1 << 64): r.v % (1 << 64) for r in stars}
    want = brute_components(values, bits)
    groups = lambda f: sorted(sorted(v for v in values if f(v) == r) for r in {f(v) for v in values})
    assert groups(lambda v: root.get(v, v)) == groups(lambda v: want[v])


def test_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "u long, v long")
    assert {(r.u, r.v) for r in components_of(edges).collect()} == {(i, 0) for i in range(1, 201)}


def test_rows_and_edge_cases(documents, empty):
    rows = near_duplicates(documents).collect()
    prints = {r.doc_id: [] for r in documents.collect()}
    for r in documents.collect():
        prints[r.doc_id].append(f"{brute_fingerprint(r.text or '', 4):016x}")
    assert sorted(repr((r.id, r.fingerprint)) for r in rows) == sorted(repr((i, f)) for i, fs in prints.items() for f in fs)
    values = sorted({int(r.fingerprint, 16) for r in rows})
    root = brute_components(values, 4)
    for r in rows:
        ids = [x.id for x in rows if root[int(x.fingerprint, 16)] == root[int(r.fingerprint, 16)] and x.id is not None]
        assert r.component_id == min(ids, default=None)
    assert near_duplicates(empty).collect() == []


def test_struct_ids(documents):
    keyed = documents.withColumn("key", F.struct("doc_id", F.monotonically_increasing_id().alias("place")))
    rows = near_duplicates(keyed, id_column="key").collect()
    assert len({r.id.place for r in rows}) == documents.count()
    assert {r.component_id for r in rows} == {r.id for r in rows if r.id == r.component_id}
