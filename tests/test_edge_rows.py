"""Edge rows from the fixture notes, through the real JSON path."""

import json
import os

import pytest

from conftest import write_text
from terrapipe.operators import quality as Q
from terrapipe.operators.hierarchy import transform_municipalities
from terrapipe.schemas import MUNICIPALITY_RAW
from terrapipe.sources.readers import read_json


def _m(mid, nome, sigla="rj", imediata=True):
    row = {"id": mid, "nome": nome, "microrregiao": {"id": 1, "nome": "m", "mesorregiao": {
        "id": 2, "nome": "me", "UF": {"id": 33, "sigla": sigla, "nome": "rio", "regiao": {
            "id": 3, "sigla": "se", "nome": "sudeste"}}}}}
    if imediata:
        row["regiao-imediata"] = {"id": 9, "nome": "imediata"}
    return row


LINES = [
    _m(1, "  santa bárbara d'oeste  "),
    _m(2, "embu-guaçu"),
    _m(3, "são  joão\tdel rei", " Sp "),
    _m(4, "  ", imediata=False),             # blank name passes gate 1
    _m(None, "sem id a"), _m(None, "sem id b"),
    _m(2 ** 40, "grande"),
]


@pytest.fixture()
def raw_file(tmp):
    text = "\n".join(json.dumps(r, ensure_ascii=False) for r in LINES)
    text += '\n{"id": "abc", "nome": "texto"}\n{"id": 5, "nome": \n'
    return write_text(os.path.join(tmp, "municipios.jsonl"), text)


def test_gate_counts_null_ids_type_errors_and_corrupt_lines(spark, raw_file):
    raw = read_json(spark, raw_file, MUNICIPALITY_RAW).cache()
    report = Q.check(raw, list(Q.RAW_MUNICIPALITY_RULES)).first()
    # 2 NULL ids + non-numeric id (corrupt) + truncated line (corrupt)
    assert (report.bad_rows, report.total_rows) == (4, 9)
    with pytest.raises(Q.DataQualityError):
        Q.enforce(raw, Q.RAW_MUNICIPALITY_RULES)
    raw.unpersist()


def test_transform_keeps_spark_title_case_and_collapses_null_ids(spark, raw_file):
    raw = read_json(spark, raw_file, MUNICIPALITY_RAW).cache()
    good = raw.where("_corrupt_record IS NULL")
    rows = {r.id: r for r in transform_municipalities(good.drop("_corrupt_record")).collect()}
    assert rows[1].nome == "Santa Bárbara D'oeste"
    assert rows[2].nome == "Embu-guaçu"
    assert rows[3].nome == "São  João\tdel Rei" and rows[3].sigla_uf == "SP"
    assert rows[4].nome == "" and rows[4].regiao_imediata_id is None
    assert rows[None].nome == "Grande"  # the 2**40 id and the two NULL ids share the NULL key
    assert len(rows) == 5
    raw.unpersist()
