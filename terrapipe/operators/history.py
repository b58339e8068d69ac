"""Dimensions with history (N1): validity intervals from successive days, and facts joined to the version valid on their day.

A landing table has a full copy of a dimension for each load day.
:func:`versions` folds the copies of a key into intervals in which its
attributes did not change: half open, from ``valid_from`` to ``valid_to``
(null while it lasts). A day on which the key is missing ends its interval.

A key has one row per load day, so the window per key is bounded by the days,
however many keys there are. Equal rows of a key on a day count once; of
different ones the least counts (as ``dedup`` chooses), so a version is unique.

:func:`as_of` first reduces the facts to their distinct (key, day) pairs, finds
each pair's version in one merged stream per key of versions and days, and
only then joins the facts back by equality of key and day. So no range
condition pairs all facts of a key with all its versions, and a key with a
third of all facts is a skewed side of an equi-join, which adaptive execution
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"


def versions(days: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """The intervals of each key: ``key``, the attributes, ``row_hash``, ``valid_from`` and ``valid_to``.

    The hash tells quickly whether a row may have changed; rows of one hash
    are compared by their values as well, so no change is lost.
    """
    row = F.struct(*[F.col(f"`{a}`") for a in attributes])
    held = days.where(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, day).agg(F.min(row).alias("row"))
    # the load day after each: a row per day, not per key
    calendar = days.select(day).where(F.col(day).isNotNull()).distinct()
    after = calendar.select(day, F.lead(day).over(Window.orderBy(day)).alias("after"))
    by_key = Window.partitionBy(key).orderBy(day)
    marked = held.join(after, day).withColumn("row_hash", F.xxhash64("row")).withColumns({
        "before": F.lag(F.struct("row", "row_hash", "after")).over(by_key)})
    same = (F.col("before.row_hash") == F.col("row_hash")) & F.col("before.row").eqNullSafe(F.col("row")) & (F.col("before.after") == F.col(day))
    numbered = marked.withColumn("version", F.sum(F.when(same, 0).otherwise(1)).over(by_key))
    return (numbered.groupBy(key, "version").agg(F.min(day).alias(FROM), F.max(F.struct(day, "after")).getField("after").alias(TO),
                                                 F.first("row").alias("row"), F.first("row_hash").alias("row_hash"))
            .select(key, *[F.col(f"row.`{a}`").alias(a) for a in attributes], "row_hash", FROM, TO))


def as_of(facts: DataFrame, history: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """The facts with the attributes of the version valid on their day; nulls where there was none.

    The facts keep all their rows and columns; the attributes follow, with ``valid_from``.
    """
    if clash := [c for c in [*attributes, FROM] if c in facts.columns]:
        raise ValueError(f"the facts already have {', '.join(clash)}")
    pairs = facts.select(F.col(key).alias("k"), F.col(day).cast("date").alias("d")).where("k IS NOT NULL AND d IS NOT NULL").distinct()
    version = F.struct(F.col(FROM), F.col(TO), *[F.col(f"`{a}`") for a in attributes])
    stream = (history.select(F.col(key).alias("k"), F.col(FROM).alias("d"), version.alias("version"))
              .unionByName(pairs.withColumn("version", F.lit(None)), allowMissingColumns=True))
    # at one day the version comes first, so that it is valid from its first day on
    order = Window.partitionBy("k").orderBy("d", F.col("version").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = (stream.withColumn("last", F.last("version", ignorenulls=True).over(order)).where("version IS NULL")
             .where(F.col(f"last.{TO}").isNull() | (F.col("d") < F.col(f"last.{TO}"))).select("k", "d", "last"))
    f = facts.alias("f")
    joined = f.join(found.alias("v"), (F.col(f"f.`{key}`") == F.col("v.k")) & (F.col(f"f.`{day}`").cast("date") == F.col("v.d")), "left")
    return joined.select(*[F.col(f"f.`{c}`") for c in facts.columns], *[F.col(f"v.last.`{a}`").alias(a) for a in [*attributes, FROM]])
