import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, write_text
from pyspark.sql.types import IntegerType, StructField, StructType

from terrapipe.schemas import CORRUPT_COLUMN, MUNICIPALITY_RAW, STATE_RAW
from terrapipe.sinks.files import write_csv, write_json, write_parquet
from terrapipe.sources.aggregates import aggregate_slice, parse_territory, read_facts, write_facts
from terrapipe.sources.listing import list_municipalities, list_states
from terrapipe.sources.readers import read_csv, read_json, read_parquet, read_preferred

STATE = {"id": 71, "sigla": "PA", "nome": "Grão Vale", "regiao": {"id": 8, "sigla": "NO", "nome": "Planalto"}}


def test_read_json_array_file_multiline(spark, tmp):
    path = write_text(os.path.join(tmp, "estados.json"),
                      json.dumps([STATE, {**STATE, "id": 72, "sigla": "TO"}], ensure_ascii=False, indent=2))
    df = read_json(spark, path, STATE_RAW, multi_line=True)
    assert sorted(r.id for r in df.collect()) == [71, 72]
    assert [r[CORRUPT_COLUMN] for r in df.select("id", CORRUPT_COLUMN).collect()] == [None, None]


def test_read_json_lines_corrupt_line_is_kept_as_bad_row(spark, tmp):
    lines = json.dumps(STATE) + "\n{not json\n" + json.dumps({"id": 1, "sigla": "AC"}) + "\n"
    path = write_text(os.path.join(tmp, "e.jsonl"), lines)
    rows = read_json(spark, path, STATE_RAW).cache()
    assert rows.count() == 3
    bad = rows.where(F.col(CORRUPT_COLUMN).isNotNull()).collect()
    assert len(bad) == 1 and bad[0][CORRUPT_COLUMN] == "{not json"
    assert rows.where("id = 1").first().regiao is None  # absent field -> typed NULL


def test_json_sink_keeps_nulls_and_non_ascii(spark, tmp):
    df = spark.createDataFrame([{"id": 1, "sigla": None, "nome": "São Paulo", "regiao": None}], STATE_RAW)
    path = write_json(df, os.path.join(tmp, "out"))
    text = "".join(open(os.path.join(path, f), encoding="utf-8").read()
                   for f in os.listdir(path) if f.endswith(".json"))
    assert '"sigla":null' in text and "São Paulo" in text


def test_csv_roundtrip_inferred_and_explicit(spark, tmp):
    df = spark.createDataFrame([(1, "a;b", 2.5), (2, "c", None)], "id int, name string, v double")
    path = write_csv(df, os.path.join(tmp, "csv"))
    assert any(open(os.path.join(path, f)).readline().strip() == "id;name;v"
               for f in os.listdir(path) if f.endswith(".csv"))
    inferred = read_csv(spark, path)
    assert dict(inferred.dtypes) == {"id": "int", "name": "string", "v": "double"}
    explicit = read_csv(spark, path, schema=df.schema)
    assert sorted(map(tuple, explicit.collect())) == [(1, "a;b", 2.5, None), (2, "c", None, None)]
    single = write_csv(df, os.path.join(tmp, "one"), single_file=True)
    assert len([f for f in os.listdir(single) if f.endswith(".csv")]) == 1


def test_csv_lines_that_do_not_fit_the_schema_are_reported(spark, tmp):
    path = write_text(os.path.join(tmp, "odd.csv"), "id;n\n1;10\n2;abc\n3;4;5\n4\n")
    rows = read_csv(spark, path, schema=StructType([StructField("id", IntegerType()), StructField("n", IntegerType())]))
    assert sorted(map(tuple, rows.collect())) == [(1, 10, None), (2, None, "2;abc"), (3, 4, "3;4;5"), (4, None, "4")]
    assert len(rows.where(f"{CORRUPT_COLUMN} is not null").collect()) == 3 and rows.select("id").count() == 4


def test_one_odd_value_keeps_the_inferred_column_text(spark, tmp):
    path = write_text(os.path.join(tmp, "late.csv"), "n\n" + "".join(f"{i}\n" for i in range(5000)) + "abc\n")
    rows = read_csv(spark, path)
    assert rows.dtypes == [("n", "string")] and rows.where("n = 'abc'").count() == 1


def test_read_preferred_processed_then_raw_then_error(spark, tmp):
    muni = {"id": 1, "nome": "x", "microrregiao": {"id": 2, "nome": "m", "mesorregiao": {
        "id": 3, "nome": "me", "UF": {"id": 71, "sigla": "PA", "nome": "Grão", "regiao": {"id": 8, "sigla": "NO", "nome": "Planalto"}}}}}
    raw = write_text(os.path.join(tmp, "municipios.json"), json.dumps(muni) + "\n")
    renames = {"microrregiao.mesorregiao.UF.sigla": "sigla_uf", "microrregiao.mesorregiao.UF.regiao.nome": "regiao_nome"}
    missing = os.path.join(tmp, "processed")
    df = read_preferred(spark, missing, raw, MUNICIPALITY_RAW, renames)
    assert df.select("sigla_uf", "regiao_nome").first() == ("PA", "Planalto")
    write_parquet(spark.createDataFrame([(9, "AC")], "id int, sigla_uf string"), missing)
    assert read_preferred(spark, missing, raw, MUNICIPALITY_RAW, renames).first().id == 9
    with pytest.raises(FileNotFoundError):
        read_preferred(spark, os.path.join(tmp, "no1"), os.path.join(tmp, "no2"), MUNICIPALITY_RAW)


def test_listing_by_id_digit_string_and_code_pushes_down(spark, tmp):
    df = spark.createDataFrame([(1, "B", "RJ", 33), (2, "A", "RJ", 33), (3, "C", "SP", 35)],
                               "id int, nome string, sigla_uf string, uf_id int")
    path = write_parquet(df, os.path.join(tmp, "m"))
    m = read_parquet(spark, path)
    assert [r.id for r in list_municipalities(m, 33).collect()] == [2, 1]
    assert [r.id for r in list_municipalities(m, "35").collect()] == [3]
    assert [r.id for r in list_municipalities(m, " rj").collect()] == [2, 1]
    assert [r.id for r in list_municipalities(m).collect()] == [2, 1, 3]
    assert "PushedFilters: [IsNotNull(sigla_uf), EqualTo(sigla_uf,RJ)]" in plan_text(list_municipalities(m, "rj"))
    states = spark.createDataFrame([(2, "B"), (1, "B"), (3, "A")], "id int, nome string")
    assert [r.id for r in list_states(states).collect()] == [3, 1, 2]


def test_aggregate_slice(spark, tmp):
    facts = spark.createDataFrame([
        (6579, "2023", 9324, "N3", 33, 1.0), (6579, "2024", 9324, "N3", 33, 2.0),
        (6579, "2024", 9324, "N3", 35, 3.0), (6579, "2025", 9324, "N3", 35, 4.0),
        (6579, "2022", 9324, "N1", 1, 10.0), (6579, "2030", 1, "N3", 33, 9.0),
    ], "table_id int, period string, variable_id int, level string, locality_id int, value double")
    assert sorted(r.value for r in aggregate_slice(facts, 6579, 2024, 9324, "N3[all]").collect()) == [2.0, 3.0]
    assert [r.value for r in aggregate_slice(facts, 6579, "last", 9324, "N3[33]").collect()] == [2.0]
    assert [r.value for r in aggregate_slice(facts, 6579, "last", 9324, "N3[all]").collect()] == [4.0]
    assert [r.value for r in aggregate_slice(facts, 6579, "last", 9324).collect()] == [10.0]
    assert parse_territory("N6[all]") == ("N6", None)
    stored = read_facts(spark, write_facts(facts, os.path.join(tmp, "facts")))
    fixed = aggregate_slice(stored, 6579, 2024, 9324, "N3[all]")
    assert sorted(r.value for r in fixed.collect()) == [2.0, 3.0]
    plan = plan_text(fixed)
    assert plan.count("Scan parquet") == 2 and "(period" in plan.split("PartitionFilters: [")[1].split("]")[0]  # tree and details of one scan
    assert [r.value for r in aggregate_slice(stored, 6579, "last", 9324).collect()] == [10.0]
    for bad in ("N3", "X1[all]", "N3[abc]"):
        with pytest.raises(ValueError):
            parse_territory(bad)


def test_stored_series_has_few_files_per_folder(spark, tmp, sf_small):
    """A folder's rows come together before they are written: files grow with folders, not with tasks x folders."""
    from terrapipe.plans import fixtures as fx
    from terrapipe.sources.aggregates import read_facts, write_facts

    facts = fx.aggregate_facts(spark, sf_small).repartition(16)
    path = write_facts(facts, f"{tmp}/facts")
    folders = facts.select("table_id", "variable_id", "level", "period").distinct().count()
    files = len(read_facts(spark, path).inputFiles())
    assert folders <= files <= 2 * folders and read_facts(spark, path).count() == facts.count()
