"""The territorial hierarchy as a graph (N1, S8): ancestors and descendants of any unit, and sums below any of them.

The dimensions' parent links are one table of units: ``level`` (``N1`` country,
``N2`` region, ``N3`` state, ...), ``id``, ``name``, ``parent_level`` and
``parent_id``. Questions about it are one recursive query each, so a level more
or a hierarchy that is not level by level needs no new code. A step joins the
last step's rows with the units by key (an equi-join, which Spark sorts and
merges, or broadcasts when small); the number of steps is the depth.

The units must be a tree to be summed over. :func:`hierarchy_faults` names
what is not: a parent that does not exist, a unit that is its own ancestor, a
unit listed twice. Every walk remembers its way and ends at a unit it has been
to, so a cycle ends the walk, not the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapipe.operators.hierarchy import dimension
from terrapipe.session import run_dir
from terrapipe.sinks.files import write_parquet
from terrapipe.sources.aggregates import parse_territory
from terrapipe.sources.readers import read_parquet

UNITS = ("level", "id", "name", "parent_level", "parent_id")
#: The dimensions from the top, with their level codes. The service's territorial levels.
LEVELS = (("N2", "regiao"), ("N3", "uf"), ("N8", "mesorregiao"), ("N9", "microrregiao"))
COUNTRY, LEAF = "N1", "N6"
#: Spark ends a recursive query beyond so many rows; a walk returns a row per unit and step, so the limit is lifted in the session.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
#: A bound on the steps, far above any hierarchy; cycles end by themselves.
DEPTH = 64


def units(municipalities: DataFrame, country: str = "Brasil") -> DataFrame:
    """All units of a processed municipality table: the country, its regions, states, meso- and microregions, municipalities.

    Country and leaves are the only rows not from a dimension. A unit has the
    parent that its dimension's row names.
    """
    spark = municipalities.sparkSession
    parts = [spark.range(1).select(F.lit(COUNTRY).alias("level"), F.lit(1).alias("id"), F.lit(country).alias("name"),
                                   F.lit(None).cast("string").alias("parent_level"), F.lit(None).cast("int").alias("parent_id"))]
    above, parent = COUNTRY, F.lit(1)
    for level, name in LEVELS:
        parts.append(dimension(municipalities, name).select(
            F.lit(level).alias("level"), F.col(f"{name}_id").alias("id"), F.col(f"{name}_nome").alias("name"),
            F.lit(above).alias("parent_level"), parent.alias("parent_id")))
        above, parent = level, F.col(f"{name}_id")
    parts.append(municipalities.select(F.lit(LEAF).alias("level"), "id", F.col("nome").alias("name"), F.lit(above).alias("parent_level"),
                                       parent.alias("parent_id")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _walk(tree: DataFrame, start: DataFrame, up: bool) -> DataFrame:
    """From each row of ``start`` (level, id) to all units above or below it, with the steps in between.

    The way is kept as text, as a set that a step can test; a unit met again
    is returned once more, marked, and not walked on from.
    """
    spark = tree.sparkSession
    spark.conf.set(ROW_LIMIT, "-1")
    link, other = (("parent_level", "parent_id"), ("level", "id")) if up else (("level", "id"), ("parent_level", "parent_id"))
    here = "concat('/', u.level, ':', u.id, '/')"
    query = f"""
        WITH RECURSIVE walk(start_level, start_id, level, id, name, parent_level, parent_id, steps, way, again) MAX RECURSION LEVEL {DEPTH} AS (
          SELECT u.level, u.id, u.level, u.id, u.name, u.parent_level, u.parent_id, 0, {here}, false
          FROM {{start}} s JOIN {{tree}} u ON s.level = u.level AND s.id = u.id
          UNION ALL
          SELECT w.start_level, w.start_id, u.level, u.id, u.name, u.parent_level, u.parent_id, w.steps + 1,
                 concat(w.way, u.level, ':', u.id, '/'), contains(w.way, {here})
          FROM walk w JOIN {{tree}} u ON w.{link[0]} = u.{other[0]} AND w.{link[1]} = u.{other[1]}
          WHERE NOT w.again)
        SELECT * FROM walk"""
    return spark.sql(query, start=start, tree=tree)


def _parents(tree: DataFrame) -> DataFrame:
    """The keys (level, id) that units name as their parent, stored: they are few beside the units, and Spark then knows how few."""
    keys = tree.select(F.col("parent_level").alias("level"), F.col("parent_id").alias("id")).where("level IS NOT NULL AND id IS NOT NULL").distinct()
    return _stored(keys, "unit_parents")


def _stored(df: DataFrame, name: str) -> DataFrame:
    return read_parquet(df.sparkSession, write_parquet(df, run_dir(df.sparkSession, name)))


def _inner_and_leaves(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units that are a parent, stored as every step of a walk reads them, and those that are not.

    A leaf is only ever the first unit of a way up or the last of a way down.
    So the inner units alone are walked, and each leaf joins the ways of its
    parent once: the leaves, most of the units, take no part in the steps.
    """
    tree = tree.select(*UNITS)
    keys = _parents(tree)
    return _stored(tree.join(keys, ["level", "id"], "left_semi"), "inner_units"), tree.join(keys, ["level", "id"], "left_anti")


def ancestors(tree: DataFrame, start: DataFrame) -> DataFrame:
    """Every unit above each unit of ``start``, itself included (``steps`` 0)."""
    inner, leaves = _inner_and_leaves(tree)
    ways = _stored(_walk(inner, inner.select("level", "id").distinct(), up=True).where("NOT again").drop("way", "again"), "unit_ways")
    # each leaf once for itself and once for the ways of its parent, in one pass over the leaves
    own = leaves.join(start.select("level", "id"), ["level", "id"]).withColumn("up", F.explode(F.array(F.lit(False), F.lit(True)))).alias("s")
    above = own.join(ways.alias("w"), F.expr("s.up AND s.parent_level = w.start_level AND s.parent_id = w.start_id"), "left").where("NOT s.up OR w.steps IS NOT NULL")
    picked = [F.when(F.col("s.up"), F.col(f"w.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in UNITS]
    above = above.select(F.col("s.level").alias("start_level"), F.col("s.id").alias("start_id"), *picked,
                         F.when(F.col("s.up"), F.col("w.steps") + 1).otherwise(0).alias("steps"))
    return _walk(inner, start, up=True).where("NOT again").drop("way", "again").unionByName(above)


def descendants(tree: DataFrame, start: DataFrame) -> DataFrame:
    """Every unit below each unit of ``start``, itself included (``steps`` 0)."""
    inner, leaves = _inner_and_leaves(tree)
    ways = _stored(_walk(inner, start, up=False).where("NOT again").drop("way", "again"), "unit_ways")
    below = leaves.alias("u").join(ways.alias("w"), F.expr("u.parent_level = w.level AND u.parent_id = w.id")).select(
        "w.start_level", "w.start_id", *[f"u.{c}" for c in UNITS], (F.col("w.steps") + 1).alias("steps"))
    own = leaves.join(start.select("level", "id"), ["level", "id"]).select(
        F.col("level").alias("start_level"), F.col("id").alias("start_id"), *UNITS, F.lit(0).alias("steps"))
    return ways.unionByName(below).unionByName(own)


def hierarchy_faults(tree: DataFrame) -> DataFrame:
    """What keeps the units from being a tree: level, id, fault (``repeated``, ``orphan`` or ``cycle``)."""
    repeated = tree.groupBy("level", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("level", "id", F.lit("repeated").alias("fault"))
    parents = _parents(tree)
    found = _stored(tree.select("level", "id").join(parents, ["level", "id"], "left_semi").distinct(), "found_parents")
    orphan = (tree.where("parent_id IS NOT NULL OR parent_level IS NOT NULL")
              .join(found.select(F.col("level").alias("parent_level"), F.col("id").alias("parent_id")), ["parent_level", "parent_id"], "left_anti")
              .select("level", "id", F.lit("orphan").alias("fault")).distinct())
    # only units that have a parent and are a parent can be on a cycle: leaves and the top need no walk
    inner = tree.select("level", "id", "parent_level", "parent_id").where("parent_id IS NOT NULL").join(parents, ["level", "id"], "left_semi")
    inner = _stored(inner.withColumn("name", F.lit(None).cast("string")).distinct(), "inner_units")  # read again in every step
    cycle = (_walk(inner, inner.select("level", "id").distinct(), up=True).where("again AND level = start_level AND id = start_id")
             .select("level", "id", F.lit("cycle").alias("fault")).distinct())
    return repeated.unionByName(orphan).unionByName(cycle)


def aggregate_below(facts: DataFrame, tree: DataFrame, table: int, period: int | str, variable: int, territory: str,
                    at_level: str = LEAF) -> DataFrame:
    """A slice for any ancestor, summed from the facts of ``at_level`` below it.

    ``territory`` is ``N<level>[all]`` or ``N<level>[<id>]``, as in
    ``aggregate_slice``. The units asked for are walked down once; the facts of
    the level meet the units below in an equi-join and are summed map-side.
    Returns period, locality_id, value and the number of localities summed.
    """
    level, unit = parse_territory(territory)
    start = tree.where(F.col("level") == level).select("level", "id")
    if unit is not None:
        start = start.where(F.col("id") == unit)
    below = descendants(tree, start).where(F.col("level") == at_level).select(F.col("start_id").alias("unit"), F.col("id").alias("locality_id"))
    rows = facts.where((F.col("table_id") == table) & (F.col("variable_id") == variable) & (F.col("level") == at_level))
    if str(period).strip().lower() == "last":
        rows = rows.where(F.col("period") == rows.select(F.max("period")).scalar())
    else:
        rows = rows.where(F.col("period") == F.lit(str(period)))
    return (rows.select("period", "locality_id", "value").join(below, "locality_id").groupBy("period", F.col("unit").alias("locality_id"))
            .agg(F.sum("value").alias("value"), F.count_distinct("locality_id").alias("localities")))
