import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from terrapipe.llm import pii, toxicity
from terrapipe.llm.decontaminate import contamination
from terrapipe.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None), (None, "", "en", None, 0), (999_999, None, None, "s", None)], docs.schema))
    docs = docs.withColumn("_place", F.lit("mine"))
    out = [docs]
    for name, stage in C.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near-duplicates", "decontamination", "pii", "packing"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes and df.where("_place <> 'mine'").count() == 0


def test_toxic_go(spark, steps):
    model = toxicity.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    texts = [r.text or "" for r in steps[0].collect()]
    want = sorted(t for t, s in zip(texts, model.scores(texts), strict=True) if s < C.TOXIC_FROM)
    assert sorted(r.text or "" for r in steps[1].collect()) == want


def test_one_of_each_group_stays(steps):
    groups = {}
    for r in near_duplicates(steps[1]).collect():
        groups.setdefault(r.component_id, []).append(r.id)
    kept = [r.doc_id for r in steps[2].collect()]
    assert len(kept) == len(groups)
    assert sorted(map(repr, kept)) == sorted(repr(None if None in ids else min(ids)) for ids in groups.values())


def test_leaks_go_and_others_stay(spark, steps):
    leaks = {r.id for r in contamination(steps[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert sorted(repr(r.doc_id) for r in steps[3].collect()) == sorted(repr(r.doc_id) for r in steps[2].collect() if r.doc_id not in leaks or r.doc_id is None)


def test_personal_values_change(spark, steps):
    cipher = pii.Cipher(C.pseudonym_key(spark))
    want = sorted(repr((r.doc_id, t := None if r.text is None else pii.replaced(r.text, pii.spans(r.text, cipher)), None if r.n_chars is None else len(t or ""))) for r in steps[3].collect())
    assert sorted(repr((r.doc_id, r.text, r.n_chars)) for r in steps[4].collect()) == want


def test_packed_whole(steps, vocabulary):
    tokenizer = Tokenizer.from_file(vocabulary)
    want = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in steps[4].collect())
    rows = steps[5].collect()
    assert sum(r.length for r in rows) == want and len({r.sequence_id for r in rows}) == len(rows)


def test_run(spark):
    rows = C.run(spark, SF).collect()
    assert rows and all(zlib.crc32(bytes(r.ids)) >= 0 and len(np.frombuffer(bytes(r.ids), "<u4")) == r.length for r in rows)


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0


@pytest.mark.parametrize("stage", [C.one_of_each, C.not_benchmark])
def test_other_splits_between_the_plans(spark, tmp_path, monkeypatch, stage):
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first().text
    texts = [f"clean {k} " + " ".join(f"w{zlib.crc32(b'%d %d' % (k, n)) % 5000}" for n in range(60 * (k + 1))) for k in range(6)]
    bad = texts[2] if stage is C.one_of_each else leak
    for k, text in enumerate(texts):
        rows = [(k, text), (100 + k, bad)] if k == 5 else [(k, text)]
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/docs")
    conf, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost, cost_before = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.openCostInBytes")
    kept = C.staged

    def staged(df, name):
        out = kept(df, name)
        spark.conf.set(conf, "1k")  # a split per piece of a file from here on
        spark.conf.set(cost, "1k")
        return out

    monkeypatch.setattr(C, "staged", staged)
    spark.conf.set(conf, "1g")
    spark.conf.set(cost, "0")
    try:
        got = stage(spark, spark.read.parquet(f"{tmp_path}/docs"), SF)
        assert sorted(r.doc_id for r in got.collect()) == list(range(6))
    finally:
        spark.conf.set(conf, before)
        spark.conf.set(cost, cost_before)
