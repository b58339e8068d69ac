"""Gaps in series, order of names, sketches of days and the bucketed layout."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from terrapipe.operators.series import missing_periods, with_gaps
from terrapipe.operators.sketches import (
    COUNT_ERROR, DISTINCT_ERROR, RANK_ERROR, day_sketches, range_distinct, range_frequent, range_quantiles,
)
from terrapipe.sinks.bucketed import append_bucketed_day, bucketed_day
from terrapipe.sinks.landing import landing_duplicates
from terrapipe.sources.listing import list_municipalities, list_states

FACTS = "table_id int, period string, variable_id int, level string, locality_id int, value double"


def facts(spark, rows):
    return spark.createDataFrame([(1, p, 2, "N3", i, v) for i, p, v in rows], FACTS)


def test_gaps(spark):
    df = facts(spark, [(1, "2018", 5.0), (1, "2021", 8.0), (1, "2021", 7.0), (2, "2020", None), (2, "2022", 1.0), (3, "soon", 9.0), (3, None, 9.0)])
    got = {(r.locality_id, r.period): (r.value, r.missing, r.known, r.known_since, r.previous, r.change) for r in with_gaps(df).collect()}
    assert got == {
        (1, "2018"): (5.0, False, 5.0, "2018", None, None), (1, "2019"): (None, True, 5.0, "2018", 5.0, None),
        (1, "2020"): (None, True, 5.0, "2018", 5.0, None), (1, "2021"): (8.0, False, 8.0, "2021", 5.0, 3.0),
        (1, "2022"): (None, True, 8.0, "2021", 8.0, None),
        (2, "2018"): (None, True, None, None, None, None), (2, "2019"): (None, True, None, None, None, None),
        (2, "2020"): (None, True, None, None, None, None), (2, "2021"): (None, True, None, None, None, None), (2, "2022"): (1.0, False, 1.0, "2022", None, None)}
    runs = sorted((r.locality_id, r.first, r.last, r.periods) for r in missing_periods(with_gaps(df)).collect())
    assert runs == [(1, "2019", "2020", 2), (1, "2022", "2022", 1), (2, "2018", "2021", 4)]
    own = sorted((r.locality_id, r.period) for r in with_gaps(df, own_range=True).collect())
    assert own == [(1, str(y)) for y in range(2018, 2022)] + [(2, str(y)) for y in range(2020, 2023)]
    assert with_gaps(facts(spark, [])).collect() == []


def test_gaps_hot_locality(spark):
    hot = spark.range(60_000).select(F.lit(1).alias("table_id"), (2000 + F.col("id") % 7 * 2).cast("string").alias("period"), F.lit(2).alias("variable_id"),
                                     F.lit("N3").alias("level"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("int").alias("locality_id"),
                                     F.col("id").cast("double").alias("value"))
    out = with_gaps(hot)
    assert out.count() == 500 * 13 and out.where("locality_id = 0 AND missing").count() == 6
    assert "partial_max" in plan_text(out)


def test_order_of_names(spark):
    names = ["Zé", "água", "Agua", "Água", "Éden", "eden", "agua", "Belém", "Zé", None]
    df = spark.createDataFrame([(k, n, 1, "AC") for k, n in enumerate(names)], "id int, nome string, uf_id int, sigla_uf string").repartition(3)
    got = [(r.nome, r.id) for r in list_municipalities(df, collation="pt").collect()]
    assert got == [(None, 9), ("agua", 6), ("Agua", 2), ("água", 1), ("Água", 3), ("Belém", 7), ("eden", 5), ("Éden", 4), ("Zé", 0), ("Zé", 8)]
    assert [r.nome for r in list_municipalities(df, 1, "pt_AI").collect()][1:5] == ["agua", "água", "Agua", "Água"]  # accents ignored: binary order decides
    assert [r.nome for r in list_states(df).collect()][1:4] == ["Agua", "Belém", "Zé"]
    assert list_states(df, "pt").collect()[-1].id == 8


@pytest.fixture(scope="module")
def sketched(spark):
    rng = random.Random(4)
    rows = [(f"2024-01-{rng.randint(1, 9):02d}", rng.lognormvariate(0, 2), min(int(rng.paretovariate(0.3)), 10 ** 9), rng.choice("ab")) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "d string, v double, i long, k string").withColumn("d", F.to_date("d"))
    df = df.unionByName(df.limit(1).select("d", F.lit(None).cast("double").alias("v"), F.lit(None).cast("long").alias("i"), "k"))
    return rows, day_sketches(df, "d", "v", "i", "i", ("k",))


def test_sketches_stay_within_their_bounds(spark, sketched):
    rows, sketches = sketched
    first, last = "2024-01-03", "2024-01-07"
    inside = [r for r in rows if first <= r[0] <= last]
    values = sorted(r[1] for r in inside)
    for r in range_quantiles(sketches, (0.01, 0.5, 0.99), first, last).collect():
        rank = sum(v <= r["value"] for v in values) / len(values)
        assert abs(rank - r["quantile"]) <= RANK_ERROR
    distinct = len({r[2] for r in inside})
    assert abs(range_distinct(sketches, first, last).first()[0] - distinct) <= DISTINCT_ERROR * distinct
    counts = {}
    for r in inside:
        counts[r[2]] = counts.get(r[2], 0) + 1
    found = range_frequent(sketches, 5, first, last).collect()
    assert {r["value"] for r in found} == set(sorted(counts, key=counts.get, reverse=True)[:5])
    assert all(abs(r["count"] - counts[r["value"]]) <= COUNT_ERROR * len(inside) for r in found)
    assert len(range_quantiles(sketches, (0.5,), keys=("k",)).collect()) == 2
    assert range_quantiles(sketches, (0.5,), "2025-01-01").collect() == []


def test_bucketed_audit_and_comparison_plan_no_shuffle(spark, scratch):
    table = f"terrapipe_landing.bucketed_{uuid.uuid4().hex}"
    one = spark.createDataFrame([(i, f"n{i}") for i in range(500)] + [(7, "again")], "id int, nome string")
    append_bucketed_day(one, table, 4, scratch, "2024-01-01 10:00:00")
    append_bucketed_day(one.where("id <> 3"), table, 4, scratch, "2024-01-02 10:00:00")
    with pytest.raises(ValueError, match="already"):
        append_bucketed_day(one, table, 4, scratch, "2024-01-02 12:00:00")
    audit = landing_duplicates(spark.table(table))
    assert sorted((r.id, str(r.load_date), r["count"]) for r in audit.collect()) == [(7, "2024-01-01", 2), (7, "2024-01-02", 2)]
    assert "Exchange" not in audit._jdf.queryExecution().executedPlan().toString()
    days = [bucketed_day(spark, table, f"2024-01-0{d}").groupBy("id").agg(F.count(F.lit(1)).alias(f"n{d}")) for d in (1, 2)]
    gone = days[0].join(days[1].hint("merge"), "id", "left").where("n2 IS NULL")
    assert [r.id for r in gone.collect()] == [3]
    assert "Exchange" not in gone._jdf.queryExecution().executedPlan().toString()
    assert spark.table(table).where("id = 42").count() == 2
