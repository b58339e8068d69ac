"""Answers of the statistical service, whole and broken, as VARIANT."""

import json

import pytest

from conftest import write_text
from terrapipe.sources.aggregates import aggregate_slice
from terrapipe.sources.payload import payload_facts, payload_faults, read_payload


def series(locality, values, level="N3", name="x"):
    return {"localidade": {"id": str(locality), "nivel": {"id": level, "nome": "UF"}, "nome": name}, "serie": values}


def variable(*found, number="9324", **more):
    return {"id": number, "variavel": "População", "unidade": "Pessoas", "resultados": [{"classificacoes": [], "series": list(found)}], **more}


@pytest.fixture()
def lines(spark, scratch):
    def read(*answers):
        path = write_text(f"{scratch}/answers.jsonl", "\n".join(a if isinstance(a, str) else json.dumps(a, ensure_ascii=False) for a in answers))
        return read_payload(spark, path)
    return read


def facts(df):
    rows = payload_facts(df, 6579).select("variable_id", "level", "locality_id", "period", "value", "text").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[:4], str(r[4:])))


def test_answer_becomes_long_series(spark, lines):
    df = lines([variable(series(33, {"2020": "17366189", "2021": "17463349"}), series(1, {"2021": "213317639"}, "N1"))],
               [variable(series(35, {"2021": 46649132.5}), number="93"), variable(series(35, {"2021": 7}), number="94")])
    assert facts(df) == [(93, "N3", 35, "2021", 46649132.5, "46649132.5"), (94, "N3", 35, "2021", 7.0, "7"),
                         (9324, "N1", 1, "2021", 213317639.0, "213317639"), (9324, "N3", 33, "2020", 17366189.0, "17366189"),
                         (9324, "N3", 33, "2021", 17463349.0, "17463349")]
    assert payload_faults(df).collect() == []
    found = aggregate_slice(payload_facts(df, 6579), 6579, "last", 9324, "N3[33]").collect()
    assert [(r.period, r.value, r.unit) for r in found] == [("2021", 17463349.0, "Pessoas")]


def test_faults_are_named_and_the_rest_is_read(lines):
    good = variable(series(33, {"2021": "5"}))
    df = lines('[{"id": "9324", "resul', [good], [], {}, "null", [{"id": "9324", "resultados": []}], [variable()],
               [variable({"serie": {"2021": "1"}})], [variable(series(33, {}))], [variable(series("x1", {"2021": "1"}))],
               [variable(series(33, {"2020": "...", "2021": "-", "2022": None, "2023": "8"}))], [variable(series(33, {"2021": "9"}), number="abc")],
               [variable(series(33, "text"))], "", "  ", "[1, 2]")
    assert facts(df) == [(9324, "N3", 33, "2020", None, "..."), (9324, "N3", 33, "2021", 5.0, "5"), (9324, "N3", 33, "2021", None, "-"),
                         (9324, "N3", 33, "2022", None, None), (9324, "N3", 33, "2023", 8.0, "8")]
    found = sorted(r.fault for r in payload_faults(df).collect())
    assert found == sorted(["not JSON", "no variable", "no variable", "no variable", "no resultados", "no series", "no localidade", "no serie",
                            "no localidade", "no number", "no number", "no number", "no variable id", "no serie",
                            "no variable id", "no variable id"])


def test_no_shuffle(lines):
    plan = payload_facts(lines([variable(series(33, {"2021": "5"}))]), 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
