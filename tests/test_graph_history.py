"""The hierarchy as a graph, versions of dimensions and what changed between days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from terrapipe.operators import ancestry
from terrapipe.operators.ancestry import aggregate_below, ancestors, descendants, hierarchy_faults
from terrapipe.operators.changes import day_changes
from terrapipe.operators.history import as_of, versions

UNITS = "level string, id int, name string, parent_level string, parent_id int"
TREE = [("N1", 1, "Brasil", None, None), ("N2", 1, "Norte", "N1", 1), ("N2", 2, "Sul", "N1", 1), ("N3", 1, "Acre", "N2", 1),
        ("N3", 2, "Pará", "N2", 1), ("N6", 10, "a", "N3", 1), ("N6", 11, "b", "N3", 1), ("N6", 12, "c", "N3", 2)]
FACTS = "table_id int, period string, variable_id int, level string, locality_id int, value double"


def tree(spark, rows=TREE):
    return spark.createDataFrame(rows, UNITS)


def one(spark, level, id_):
    return spark.createDataFrame([(level, id_)], "level string, id int")


def test_up_and_down(spark):
    t = tree(spark)
    up = [(r.level, r.id, r.steps) for r in ancestors(t, one(spark, "N6", 11)).orderBy("steps").collect()]
    assert up == [("N6", 11, 0), ("N3", 1, 1), ("N2", 1, 2), ("N1", 1, 3)]
    down = sorted((r.level, r.id, r.steps) for r in descendants(t, one(spark, "N2", 1)).collect())
    assert down == [("N2", 1, 0), ("N3", 1, 1), ("N3", 2, 1), ("N6", 10, 2), ("N6", 11, 2), ("N6", 12, 2)]
    assert ancestors(t, one(spark, "N6", 99)).collect() == [] and descendants(t.limit(0), one(spark, "N2", 1)).collect() == []


def test_faults_and_walks_over_them(spark):
    rows = [r for r in TREE if r[:2] != ("N2", 1)] + [
        ("N2", 1, "Norte", "N3", 2), ("N6", 13, "lost", "N3", 9), ("N6", 10, "again", "N3", 2), ("N9", 5, "own parent", "N9", 5)]
    t = tree(spark, rows)
    found = {(r.level, r.id, r.fault) for r in hierarchy_faults(t).collect()}
    assert found == {("N6", 10, "repeated"), ("N6", 13, "orphan"), ("N2", 1, "cycle"), ("N3", 2, "cycle"), ("N9", 5, "cycle")}
    assert {(r.level, r.id) for r in ancestors(t, one(spark, "N6", 12)).collect()} == {("N6", 12), ("N3", 2), ("N2", 1)}
    assert hierarchy_faults(tree(spark)).collect() == []


def walked_units(monkeypatch):
    """The units that each walk steps over, as sets, filled while the walks are made."""
    seen, walk = [], ancestry._walk

    def noted(tree, start, up):
        seen.append({(r.level, r.id) for r in tree.collect()})
        return walk(tree, start, up)

    monkeypatch.setattr(ancestry, "_walk", noted)
    return seen


def test_leaves_take_no_part_in_the_steps(spark, monkeypatch):
    seen, inner = walked_units(monkeypatch), {r[:2] for r in TREE if r[0] != "N6"}
    t = tree(spark)
    everyone = sorted((r.start_level, r.start_id, r.level, r.id, r.name, r.steps) for r in ancestors(t, t.select("level", "id")).collect())
    assert len(everyone) == 1 + 2 * 2 + 2 * 3 + 3 * 4 and ("N6", 12, "N1", 1, "Brasil", 3) in everyone
    down = sorted((r.start_level, r.start_id, r.level, r.id, r.steps) for r in descendants(t, t.select("level", "id")).collect())
    assert down == sorted((level, i, start_level, start, steps) for start_level, start, level, i, _, steps in everyone)
    assert seen and all(units <= inner for units in seen)


def test_walks_of_repeated_and_lost_units(spark):
    rows = TREE + [("N3", 2, "Pará", "N2", 2), ("N6", 12, "c", "N3", 2), ("N6", 14, "lost", "N3", 9), ("N6", 15, "top", None, None), ("N6", None, "no id", "N3", 1)]
    t = tree(spark, rows)
    up = sorted((r.level, r.id, r.steps) for r in ancestors(t, one(spark, "N6", 12)).collect())
    assert up == sorted(2 * [("N6", 12, 0)] + 4 * [("N3", 2, 1)] + 2 * [("N2", 1, 2), ("N2", 2, 2)] + 4 * [("N1", 1, 3)])  # a row for each way
    for lost in (14, 15):
        assert [(r.id, r.steps) for r in ancestors(t, one(spark, "N6", lost)).collect()] == [(lost, 0)]
        assert [(r.id, r.steps) for r in descendants(t, one(spark, "N6", lost)).collect()] == [(lost, 0)]
    twice = one(spark, "N3", 1).unionByName(one(spark, "N3", 1))
    assert sorted((r.id or 0, r.steps) for r in descendants(t, twice).collect()) == sorted(2 * [(1, 0), (10, 1), (11, 1), (0, 1)])


def test_faults_walk_only_units_that_have_a_parent_and_are_one(spark, monkeypatch):
    seen = walked_units(monkeypatch)
    rows = [r for r in TREE if r[:2] != ("N2", 1)] + [("N2", 1, "Norte", "N3", 2), ("N6", 13, "half", "N3", None), ("N6", 14, "half", None, 1)]
    found = {(r.level, r.id, r.fault) for r in hierarchy_faults(tree(spark, rows)).collect()}
    assert found == {("N2", 1, "cycle"), ("N3", 2, "cycle"), ("N6", 13, "orphan"), ("N6", 14, "orphan")}
    assert seen == [{("N2", 1), ("N3", 1), ("N3", 2)}]


def test_sums_for_any_ancestor(spark):
    facts = spark.createDataFrame([(1, p, 2, "N6", i, float(i)) for i in (10, 11, 12, 99) for p in ("2020", "2021")]
                                  + [(1, "2022", 2, "N3", 1, 5.0), (7, "2021", 2, "N6", 10, 100.0)], FACTS)

    def got(territory, period="last"):
        return sorted(tuple(r) for r in aggregate_below(facts, tree(spark), 1, period, 2, territory).collect())

    assert got("N1[1]") == [("2021", 1, 33.0, 3)]
    assert got("N2[all]") == [("2021", 1, 33.0, 3)] and got("N2[2]") == []
    assert got("N3[all]", 2020) == [("2020", 1, 21.0, 2), ("2020", 2, 12.0, 1)] and got("N6[12]") == [("2021", 12, 12.0, 1)]
    with pytest.raises(ValueError):
        got("N3")


DAYS = "id int, name string, code string, load_date date"


def day(n):
    return dt.date(2024, 1, n)


def history(spark, rows):
    found = versions(spark.createDataFrame(rows, DAYS).repartition(3), "id", "load_date", ["name", "code"])
    return sorted(((r.id, r.name, r.code, r.valid_from.day, r.valid_to and r.valid_to.day) for r in found.collect()), key=repr)


def test_versions(spark):
    rows = [(1, "a", "x", day(d)) for d in (1, 2, 5)] + [(1, "b", "x", day(7))]  # load days: 1, 2, 5, 7
    rows += [(2, "c", None, day(1)), (2, "c", "y", day(2)), (2, "c", None, day(5)), (2, "c", None, day(7))]  # null to value and back
    rows += [(3, "d", "z", day(1)), (3, "d", "z", day(5))]  # gone on the 2nd, back on the 5th, gone on the 7th
    rows += [(4, "e", "z", day(2))] * 3 + [(4, "f", "z", day(2))]  # repeated: the least counts
    rows += [(None, "n", "n", day(1)), (5, "g", "g", None)]
    assert history(spark, rows) == sorted([
        (1, "a", "x", 1, 7), (1, "b", "x", 7, None), (2, "c", None, 1, 2), (2, "c", "y", 2, 5), (2, "c", None, 5, None),
        (3, "d", "z", 1, 2), (3, "d", "z", 5, 7), (4, "e", "z", 2, 5)], key=repr)
    assert history(spark, []) == []


def test_as_of(spark):
    rows = [(1, "a", "x", day(2)), (1, "a", "x", day(3)), (1, "b", "x", day(4)), (2, "c", "y", day(2)), (2, "c", "y", day(4))]
    h = versions(spark.createDataFrame(rows, DAYS), "id", "load_date", ["name", "code"])
    facts = spark.createDataFrame([(k, i, d) for k, (i, d) in enumerate(
        [(1, day(1)), (1, day(2)), (1, day(3)), (1, day(4)), (1, day(20)), (2, day(3)), (2, day(4)), (3, day(4)), (None, day(4)), (1, None)])],
        "fact int, id int, day date")
    facts = facts.unionByName(facts.where("fact = 1"))  # repeated facts stay
    got = sorted((r.fact, r.name, r.valid_from and r.valid_from.day) for r in as_of(facts, h, "id", "day", ["name", "code"]).collect())
    assert got == [(0, None, None), (1, "a", 2), (1, "a", 2), (2, "a", 2), (3, "b", 4), (4, "b", 4), (5, None, None), (6, "c", 4),
                   (7, None, None), (8, None, None), (9, None, None)]
    with pytest.raises(ValueError, match="name"):
        as_of(facts.withColumn("name", F.lit(1)), h, "id", "day", ["name", "code"])


def test_as_of_hot_key_pairs_by_equality_only(spark):
    """A third of 60,000 facts on one key with 40 versions: no join pairs facts with versions by range."""
    days = spark.range(40).select(F.lit(-1).alias("id"), F.concat(F.lit("v"), F.col("id")).alias("name"), F.lit(None).cast("string").alias("code"),
                                  F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("load_date"))
    h = versions(days, "id", "load_date", ["name", "code"])
    facts = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int").alias("id"),
                                       F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 45).cast("int")).alias("day"))
    out = as_of(facts, h, "id", "day", ["name", "code"])
    assert out.count() == 60_000 and out.where("name IS NOT NULL").count() == 20_000
    assert out.where("id = -1 AND day = DATE '2024-02-14' AND name <> 'v39'").count() == 0
    plan = plan_text(out)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def changed(spark, before, after, **options):
    schema = "id int, name string, code string"
    found = day_changes(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), "id", **options)
    return sorted(((r.id, r.change, tuple(r.changed), r.rows_before, r.rows_after) for r in found.collect()), key=repr)


def test_changes(spark):
    before = [(1, "a", "x"), (2, "b", None), (3, "c", "x"), (4, "d", "x"), (None, "n", "x"), (6, "r", "x"), (6, "s", "x"), (7, "t", "x")]
    after = [(1, "a", "x"), (2, "b", "y"), (3, "C", None), (5, "e", "x"), (None, "m", "x"), (6, "s", "x"), (6, "r", "y"), (7, "t", "x"), (7, "t", "x")]
    assert changed(spark, before, after) == sorted([
        (2, "changed", ("code",), 1, 1), (3, "changed", ("name", "code"), 1, 1), (4, "deleted", (), 1, 0), (5, "inserted", (), 0, 1),
        (None, "changed", ("name",), 1, 1), (6, "changed", ("code",), 2, 2), (7, "changed", ("name", "code"), 1, 2)], key=repr)
    assert [c[0] for c in changed(spark, before, after, columns=["name"])] == sorted([3, 4, 5, None, 7], key=repr)
    assert changed(spark, before, before) == [] and changed(spark, [], []) == []
    assert {c[1] for c in changed(spark, before, [])} == {"deleted"} and {c[1] for c in changed(spark, [], after)} == {"inserted"}


def test_changes_hot_key_is_combined_first(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("int").alias("id"), F.col("id").cast("string").alias("v"))
    out = day_changes(hot, hot.where("v <> '9'"), "id")
    assert [tuple(r) for r in out.collect()] == [(-1, "changed", ["v"], 10_000, 9_999)]
    assert "partial_count" in plan_text(out)
