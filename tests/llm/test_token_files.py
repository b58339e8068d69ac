import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from terrapipe.llm.token_files import Shard, repair, shard_bytes, token_files


def expanded(sequence, rules, first):
    out = []
    stack = [int(s) for s in sequence[::-1]]
    while stack:
        s = stack.pop()
        if s < first:
            out.append(s)
        else:
            stack += [int(rules[s - first][1]), int(rules[s - first][0])]
    return out


@pytest.mark.parametrize("first,ids", [
    (10, [1, 2] * 50), (10, [3] * 101), (10, []), (10, [5]), (70_000, [69_999, 1] * 40 + [7] * 33),
    (49_408, np.random.default_rng(1).integers(0, 30, 4000).tolist())])
def test_grammar_expands_to_the_input(first, ids):
    sequence, rules = repair(np.array(ids, np.uint32), first, least=4)
    assert expanded(sequence, rules, first) == ids
    if len(ids) >= 100:
        assert len(sequence) < len(ids)


def test_any_range_without_the_rest():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 12, 3000).astype(np.uint32)
    shard = Shard(shard_bytes(3, 4, 99, [7, None], [1000, 2000], ids, 12))
    assert (shard.part, shard.number, shard.before, shard.docs, shard.lengths.tolist()) == (3, 4, 99, [7, None], [1000, 2000])
    for _ in range(300):
        a, b = sorted(rng.integers(0, 3001, 2).tolist())
        assert (shard.ids(a, b) == ids[a:b]).all()


def test_damage_is_found():
    data = shard_bytes(0, 0, 0, [1], [40], np.array([1, 2] * 20, np.uint32), 10)
    for broken in (data[:-2], data + b"x", b"XXXX" + data[4:]):
        with pytest.raises(ValueError):
            Shard(broken)


def test_round_trip_in_id_order(documents, vocabulary):
    tokenizer = Tokenizer.from_file(vocabulary)
    rows = sorted(token_files(documents, vocabulary, shard_ids=500).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    key = lambda i: (i is not None, i or 0)
    assert [key(r.doc_id) for r in rows] == sorted(key(r.doc_id) for r in rows)
    want = sorted(repr((r.doc_id, zlib.crc32(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())))
                  for r in documents.collect())
    assert sorted(repr((r.doc_id, zlib.crc32(bytes(r.ids)))) for r in rows) == want


def test_files_of_lost_attempts_are_not_read(spark, documents, vocabulary, scratch):
    from pyspark.sql import functions as F

    from terrapipe.llm.token_files import read_token_files, write_token_files

    folder = f"{scratch}/files"
    write_token_files(documents, folder, vocabulary, 2).collect()  # as if these attempts had been lost
    tasks = write_token_files(documents, folder, vocabulary, 2).groupBy("part", "attempt").agg(F.sum("ids").alias("n")).collect()
    rows = read_token_files(spark, folder, {r.part: r.n for r in tasks}, {r.part: r.attempt for r in tasks})
    assert rows.count() == documents.count() and rows.select("start").distinct().count() == documents.count()


def test_empty_table(empty, vocabulary):
    assert token_files(empty, vocabulary).collect() == []
