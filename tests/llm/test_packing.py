import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from terrapipe.llm.packing import decompose, pack, write_buckets


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 2047, 2048, 5000])
def test_decompose_tiles_with_powers_of_two(n):
    at = 0
    for start, length in decompose(n, 2048):
        assert start == at and length & (length - 1) == 0 and length <= 2048
        at += length
    assert at == n


def test_each_id_lies_in_one_piece(documents, vocabulary):
    tokenizer = Tokenizer.from_file(vocabulary)
    want = sorted(repr((r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in documents.collect())
    rows = pack(documents, vocabulary, max_len=64).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(len(r.ids) == 4 * r.length and r.offset == 0 and r.length <= 64 and r.length & (r.length - 1) == 0 for r in rows)
    got, open_ = [], defaultdict(list)
    for r in sorted(rows, key=lambda r: r.sequence_id):  # a document's pieces follow one another
        ids = open_[r.doc_id]
        assert len(ids) == r.start
        ids += np.frombuffer(bytes(r.ids), "<u4").tolist()
        if len(ids) == r.doc_tokens:
            got.append(repr((r.doc_id, open_.pop(r.doc_id))))
    assert not open_ and sorted(got) == want


def test_empty_table_and_bad_length(empty, vocabulary):
    assert pack(empty, vocabulary).count() == 0
    with pytest.raises(ValueError):
        pack(empty, vocabulary, max_len=1000)


def test_query_digests_and_buckets(spark, sf_small, vocabulary, scratch):
    from terrapipe.llm.queries import QUERIES

    packed = pack(spark.read.parquet(f"{sf_small}/documents.parquet"), vocabulary)
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in QUERIES["op2_pack"](spark, sf_small).collect()}
    assert digests == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in packed.collect()}
    write_buckets(packed, f"{scratch}/buckets")
    read = spark.read.parquet(f"{scratch}/buckets")
    assert read.where("bucket <> length").count() == 0 and read.count() == len(digests)
