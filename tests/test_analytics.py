import pytest

from conftest import plan_text
from terrapipe.operators.analytics import (
    describe_counts, distinct_count, frequency, row_count, share, summary,
)


@pytest.fixture()
def muni(spark):
    rows = [(i, "SP" if i < 6 else "RJ" if i < 9 else "MG" if i < 11 else None, "Sudeste" if i < 11 else "Sul")
            for i in range(12)]
    return spark.createDataFrame(rows, "id int, sigla_uf string, regiao_nome string")


def test_frequency_excludes_null_and_breaks_ties_by_key(spark, muni):
    assert [tuple(r) for r in frequency(muni, "sigla_uf").collect()] == [("SP", 6), ("RJ", 3), ("MG", 2)]
    assert [r.sigla_uf for r in frequency(muni, "sigla_uf", 2).collect()] == ["SP", "RJ"]
    assert "TakeOrderedAndProject" in plan_text(frequency(muni, "sigla_uf", 2))


def test_describe_counts(spark, muni):
    r = describe_counts(muni, "sigla_uf", None).first()
    assert (r["count"], r["min"], r["max"]) == (3, 2, 6)
    assert r["mean"] == pytest.approx(11 / 3)
    assert r["std"] == pytest.approx(2.081666, rel=1e-5)
    assert (r["p25"], r["p50"], r["p75"]) == (2.5, 3.0, 4.5)


def test_share_uses_no_join_and_no_global_window(spark, muni):
    df = share(muni, "regiao_nome")
    assert [tuple(r) for r in df.collect()] == [("Sudeste", 11, 91.7), ("Sul", 1, 8.3)]
    plan = plan_text(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert bad not in plan


def test_summary_and_counts(spark, muni):
    states = spark.createDataFrame([(i,) for i in range(27)], "id int")
    assert tuple(summary(states, muni).first()) == (27, 12, 3)
    assert row_count(muni).first().rows == 12
    assert distinct_count(muni, "sigla_uf").first()[0] == 3
