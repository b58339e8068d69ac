import os

import pytest

from terrapipe.operators import quality as Q
from terrapipe.plans import fixtures as fx
from terrapipe.plans.daily import ingest, landing_path
from terrapipe.sinks.files import write_json
from terrapipe.streaming.incremental import load_new_collections

TS = "2024-06-01 09:00:00"


def test_stream_loads_each_collection_once_and_reruns_are_noops(spark, tmp, sf_small):
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    write_json(fx.raw_states(spark, sf_small), os.path.join(raw_dir, "c1"))
    assert load_new_collections(spark, raw_dir + "/*", "states", tmp, ckpt, TS) == [25]
    assert load_new_collections(spark, raw_dir + "/*", "states", tmp, ckpt, TS) == []  # nothing new
    assert spark.read.parquet(landing_path(tmp, "states")).count() == 25


def test_stream_rejects_bad_collection(spark, tmp, sf_small):
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    write_json(fx.raw_states(spark, sf_small, faults=True), os.path.join(raw_dir, "c1"))
    with pytest.raises(Exception, match="truthy"):
        load_new_collections(spark, raw_dir + "/*", "states", tmp, ckpt, TS)
    assert not os.path.exists(landing_path(tmp, "states"))


def test_later_collection_replaces_the_day(spark, tmp, sf_small):
    from pyspark.sql import functions as F
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    first = fx.raw_states(spark, sf_small)
    write_json(first, os.path.join(raw_dir, "c1"))
    assert load_new_collections(spark, raw_dir + "/*", "states", tmp, ckpt, TS) == [25]
    renamed = first.withColumn("nome", F.concat(F.lit("novo "), F.col("nome")))
    write_json(renamed, os.path.join(raw_dir, "c2"))
    assert load_new_collections(spark, raw_dir + "/*", "states", tmp, ckpt, TS) == [25]
    landed = spark.read.parquet(landing_path(tmp, "states"))
    assert landed.count() == 25
    assert landed.where(~F.col("nome").startswith("Novo ")).count() == 0


def test_collection_in_several_files_lands_whole(spark, tmp, sf_small):
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    write_json(fx.raw_municipalities(spark, sf_small).repartition(4), os.path.join(raw_dir, "c1"))
    assert len([f for f in os.listdir(os.path.join(raw_dir, "c1")) if f.endswith(".json")]) == 4
    assert load_new_collections(spark, raw_dir + "/*", "municipalities", tmp, ckpt, TS) == [1500]
    assert spark.read.parquet(landing_path(tmp, "municipalities")).count() == 1500


def test_two_pending_collections_load_in_order(spark, tmp, sf_small):
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    raw = fx.raw_municipalities(spark, sf_small)
    write_json(raw.where("id <= 1000"), os.path.join(raw_dir, "z-first"))
    write_json(raw.where("id > 1000"), os.path.join(raw_dir, "a-second"))
    for name, when in (("z-first", 1_700_000_000), ("a-second", 1_700_000_100)):
        for f in os.listdir(os.path.join(raw_dir, name)):
            os.utime(os.path.join(raw_dir, name, f), (when, when))
    assert load_new_collections(spark, raw_dir + "/*", "municipalities", tmp, ckpt, TS) == [1000, 500]
    assert spark.read.parquet(landing_path(tmp, "municipalities")).agg({"id": "min"}).first()[0] == 1001


def test_files_found_by_two_triggers_are_one_collection(spark, tmp, sf_small):
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    raw = fx.raw_municipalities(spark, sf_small)
    write_json(raw.where("id <= 1000"), os.path.join(raw_dir, "c1"))
    assert load_new_collections(spark, raw_dir + "/*", "municipalities", tmp, ckpt, TS) == [1000]
    raw.where("id > 1000").write.mode("append").json(os.path.join(raw_dir, "c1"))
    assert load_new_collections(spark, raw_dir + "/*", "municipalities", tmp, ckpt, TS) == [1500]


def jobs_reading(spark, monkeypatch, run):
    """How often the text of a collection is gated or transformed from a pass of its own."""
    from terrapipe.streaming import incremental
    passes = []
    monkeypatch.setattr(incremental.Q, "_fast_counts", lambda df, rules, f=Q._fast_counts: passes.append(df.inputFiles()) or f(df, rules))
    run()
    return [files for files in passes if any(".json" in f for f in files)]


def test_gate_1_reads_no_text_of_its_own(spark, tmp, sf_small, monkeypatch):
    raw_dir, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    ingest(fx.raw_municipalities(spark, sf_small), "municipalities", raw_dir)
    loaded = []
    assert jobs_reading(spark, monkeypatch, lambda: loaded.extend(
        load_new_collections(spark, f"{raw_dir}/municipalities", "municipalities", tmp, ckpt, TS))) == []
    assert loaded == [1500]


LINE = '{"id": %s, "nome": "a", "microrregiao": {"id": 1, "nome": "m", "mesorregiao": {"id": 1, "nome": "n", "UF": {"id": 11, "sigla": "RO", "nome": "r", ' \
       '"regiao": {"id": 1, "sigla": "N", "nome": "Norte"}}}}, "regiao-imediata": %s}\n'


@pytest.mark.parametrize("immediate, number, error", [('{"id": 5, "nome": "i"}', "2", None), ('{"id": "five", "nome": "i"}', "2", None),
                                                      ('"none"', "2", None), ('{"id": 5, "nome": "i"}', '"two"', "truthy"),
                                                      ('{"id": 5, "nome": "i"', "2", "truthy")])
def test_only_what_gate_1_reads_makes_a_line_corrupt(spark, tmp, immediate, number, error):
    raw_dir = os.path.join(tmp, "raw")
    os.makedirs(os.path.join(raw_dir, "c1"))
    with open(os.path.join(raw_dir, "c1", "part.json"), "w", encoding="utf-8") as f:
        f.write(LINE % (1, '{"id": 5, "nome": "i"}') + LINE % (number, immediate))

    def load():
        return load_new_collections(spark, raw_dir + "/*", "municipalities", tmp, os.path.join(tmp, "ckpt"), TS)

    if error is None:
        assert load() == [2]
    else:
        with pytest.raises(Exception, match=error):
            load()
        assert not os.path.exists(landing_path(tmp, "municipalities"))
        assert not any(files for _, _, files in os.walk(os.path.join(tmp, "processed")))


def test_a_collection_without_rows_is_refused(spark, tmp):
    raw_dir = os.path.join(tmp, "raw")
    os.makedirs(os.path.join(raw_dir, "c1"))
    with open(os.path.join(raw_dir, "c1", "part.json"), "w", encoding="utf-8") as f:
        f.write("\n\n")
    with pytest.raises(Exception, match="non_empty"):
        load_new_collections(spark, raw_dir + "/*", "municipalities", tmp, os.path.join(tmp, "ckpt"), TS)
