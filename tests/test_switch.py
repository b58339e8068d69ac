"""A day moves whole: failures before the switch keep the old day, loads can be told apart and gone back to."""

import uuid

import pytest
from pyspark.sql import functions as F

from terrapipe.operators import quality as Q
from terrapipe.schemas import STATE_COMMENT, STATE_PROCESSED
from terrapipe.sinks import switch
from terrapipe.sinks.landing import create_landing
from terrapipe.sinks.switch import day_folder, point_day, switch_day, unused_loads

DAY1, DAY2 = "2024-01-01 10:00:00", "2024-01-02 10:00:00"


def batch(spark, *ids, name="Acre"):
    rows = [(i, ("AC", "AL", "AM", "AP", "BA", "CE", "DF")[i % 7], f"{name} {i}", 1, "N", "Norte") for i in ids]
    return spark.createDataFrame(rows, STATE_PROCESSED)


@pytest.fixture()
def landing(spark, scratch):
    table = f"terrapipe_landing.switch_{uuid.uuid4().hex}"
    create_landing(spark, table, STATE_PROCESSED, STATE_COMMENT, scratch)
    return table


def held(spark, table):
    return sorted((str(r.load_date), r.id, r.nome) for r in spark.table(table).collect())


def test_days_are_replaced_alone(spark, landing):
    switch_day(batch(spark, 1, 2), landing, DAY1, Q.STATES_CONTRACT, Q.STATE_LANDING_RULES)
    first = switch_day(batch(spark, 1, 2), landing, DAY2)
    switch_day(batch(spark, 3, name="Pará"), landing, DAY2)
    assert held(spark, landing) == [("2024-01-01", 1, "Acre 1"), ("2024-01-01", 2, "Acre 2"), ("2024-01-02", 3, "Pará 3")]
    assert [x.rsplit("/", 1)[-1] for x in unused_loads(spark, landing)] == [first.rsplit("/", 1)[-1]]
    point_day(spark, landing, "2024-01-02", first)  # back to the load before
    assert held(spark, landing)[2:] == [("2024-01-02", 1, "Acre 1"), ("2024-01-02", 2, "Acre 2")]


def test_lost_between_write_and_switch(spark, landing, monkeypatch):
    """All files are written, the statement never comes: readers keep the old day, a rerun loads the new one."""
    switch_day(batch(spark, 1), landing, DAY1)
    before = day_folder(spark, landing, "2024-01-01")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(switch, "point_day", lost)
        with pytest.raises(RuntimeError):
            switch_day(batch(spark, 2), landing, DAY1)
    assert held(spark, landing) == [("2024-01-01", 1, "Acre 1")] and day_folder(spark, landing, "2024-01-01") == before
    assert len(unused_loads(spark, landing)) == 1
    switch_day(batch(spark, 2), landing, DAY1)
    assert held(spark, landing) == [("2024-01-01", 2, "Acre 2")]


def test_write_that_fails_and_batch_that_is_refused(spark, landing):
    switch_day(batch(spark, 1), landing, DAY1)
    broken = batch(spark, 5, 6).withColumn("nome", F.when(F.col("id") == 6, F.raise_error(F.lit("broken row"))).otherwise(F.col("nome")))
    with pytest.raises(Exception, match="broken row"):
        switch_day(broken, landing, DAY1)
    with pytest.raises(Q.DataQualityError):
        switch_day(batch(spark, 7, 7), landing, DAY1, Q.STATES_CONTRACT)
    with pytest.raises(Q.DataQualityError):
        switch_day(batch(spark, 7).limit(0), landing, DAY1)
    with pytest.raises(ValueError, match="sigla"):
        switch_day(batch(spark, 7).drop("sigla"), landing, DAY1)
    assert held(spark, landing) == [("2024-01-01", 1, "Acre 1")]


def test_reader_that_began_before(spark, landing):
    switch_day(batch(spark, 1), landing, DAY1)
    before = spark.table(landing).select("id", "load_date")
    before.count()
    switch_day(batch(spark, 2), landing, DAY1)
    assert [r.id for r in before.collect()] in ([1], [2])
    assert day_folder(spark, landing, "2023-12-31") is None


def test_day_predicate_reads_one_folder(spark, landing):
    for ts in (DAY1, DAY2):
        switch_day(batch(spark, 1), landing, ts)
    day = spark.table(landing).where("load_date = DATE '2024-01-02'")
    assert day.count() == 1 and len(day.select(F.input_file_name()).distinct().collect()) == 1
    assert "PartitionFilters: [isnotnull(load_date" in day._jdf.queryExecution().toString()
