from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from terrapipe.functions.clean import (
    clean_code, clean_title, first_present, flatten, has_path, optional_path, to_int,
)
import pytest


def test_to_int_is_safe(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("x",), ("3.7",), ("99999999999",), (None,)], "s string")
    got = [r[0] for r in df.select(to_int("s")).collect()]
    assert got == [12, 7, None, None, None, None]


def test_clean_title_and_code_keep_spark_semantics(spark):
    df = spark.createDataFrame([("  rio de janeiro ",), ("embu-guaçu",), ("d'oeste",), ("a  b",), ("\tx",)], "s string")
    got = [r[0] for r in df.select(clean_title("s")).collect()]
    # words break at spaces only; the rest is lower-cased; tabs are not trimmed
    assert got == ["Rio De Janeiro", "Embu-guaçu", "D'oeste", "A  B", "\tx"]
    codes = spark.createDataFrame([(" rj ",), ("Sp",), (None,)], "s string")
    assert [r[0] for r in codes.select(clean_code("s")).collect()] == ["RJ", "SP", None]


def test_optional_path_typed_null_when_absent(spark):
    df = spark.createDataFrame([(1, (5, "a"))], "id int, `regiao-imediata` struct<id:bigint,nome:string>")
    assert has_path(df.schema, "`regiao-imediata`.id")
    assert not has_path(df.schema, "`regiao-intermediaria`.id")
    assert not has_path(df.schema, "`regiao-imediata`.missing")
    row = df.select(
        optional_path(df, "`regiao-imediata`.id", IntegerType()).alias("a"),
        optional_path(df, "`regiao-intermediaria`.nome", StringType()).alias("b"),
    ).first()
    assert row.a == 5 and row.b is None
    types = df.select(optional_path(df, "`regiao-intermediaria`.id", IntegerType()).alias("x")).schema
    assert types["x"].dataType == IntegerType()


def test_flatten_is_one_select_with_dotted_names(spark):
    df = spark.createDataFrame(
        [(1, ("RJ", (3, "SE")), [1, 2])],
        "id int, uf struct<sigla:string, regiao:struct<id:int, sigla:string>>, tags array<int>")
    flat = flatten(df)
    assert flat.columns == ["id", "uf.sigla", "uf.regiao.id", "uf.regiao.sigla", "tags"]
    assert flat.first()["uf.regiao.sigla"] == "SE"


def test_first_present(spark):
    df = spark.createDataFrame([(1, "RJ")], "id int, sigla string")
    assert first_present(df, ["sigla_uf", "sigla"]) == "sigla"
    with pytest.raises(KeyError, match="columns"):
        first_present(df, ["regiao_nome", "regiao-nome"])
