"""Series by period: the last known value, the change against it, and the periods that are missing.

A series is all facts of one table, variable, level and locality. Its grid are
the yearly periods from the first to the last of the whole slice (or of the
series itself), made by ``sequence``, so a period that nobody reported is a row
too. Facts are first reduced to one value per series and period, map-side: a
locality that holds a third of all facts is one row per task and period in the
shuffle, and a window's partition is never longer than the grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ("table_id", "variable_id", "level", "locality_id")


def with_gaps(facts: DataFrame, own_range: bool = False) -> DataFrame:
    """Each series on its grid of periods.

    Returns the series' keys, ``period``, ``value`` (null: missing), ``missing``,
    ``known`` (the last value up to the period), ``known_since`` (its period),
    ``previous`` (the last value before the period) and ``change`` (value less
    previous). Of several values of a period the greatest counts. Periods are
    years; facts whose period is no year are ignored.
    """
    year = F.expr("try_cast(period AS int)")
    single = facts.withColumn("year", year).where("year IS NOT NULL").groupBy(*SERIES, "year").agg(F.max("value").alias("value"))
    if own_range:
        ends = single.groupBy(*SERIES).agg(F.min("year").alias("first"), F.max("year").alias("last"))
    else:
        years = facts.select(year.alias("year"))
        ends = single.select(*SERIES).distinct().withColumns({
            "first": years.select(F.min("year")).scalar(), "last": years.select(F.max("year")).scalar()})
    grid = ends.select(*SERIES, F.explode(F.sequence("first", "last")).alias("year"))
    rows = grid.join(single, [*SERIES, "year"], "left")
    order = Window.partitionBy(*SERIES).orderBy("year")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    known_since = F.last(F.when(F.col("value").isNotNull(), F.col("year")), ignorenulls=True).over(upto)
    previous = F.last("value", ignorenulls=True).over(before)
    return rows.select(*SERIES, F.col("year").cast("string").alias("period"), "value", F.col("value").isNull().alias("missing"),
                       F.last("value", ignorenulls=True).over(upto).alias("known"), known_since.cast("string").alias("known_since"),
                       previous.alias("previous"), (F.col("value") - previous).alias("change"))


def missing_periods(gaps: DataFrame) -> DataFrame:
    """The runs of missing periods of each series: ``first``, ``last`` and ``periods``."""
    order = Window.partitionBy(*SERIES).orderBy("year")
    missing = gaps.where("missing").select(*SERIES, F.col("period").cast("int").alias("year"))
    runs = missing.withColumn("run", F.col("year") - F.row_number().over(order))  # the same within a run of years
    return runs.groupBy(*SERIES, "run").agg(F.min("year").cast("string").alias("first"), F.max("year").cast("string").alias("last"),
                                            F.count(F.lit(1)).alias("periods")).drop("run")
