"""What changed between two days of a landing table (L4, L7): inserted, deleted and changed keys, with the columns that changed.

Each day is first reduced to one row per key, combined map-side, so that a key
repeated in a third of all rows is a row per task in the shuffle, and the full
outer comparison joins unique keys. Keys and values compare null-safe: a null
key is a key like any other, a null that became a value is a change.

A key that occurs once on both days is compared value by value. Where a key
repeats, a column counts as changed if the multiset of its values differs: by
their number, least and greatest value, and the sum of their 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_key(day: DataFrame, key: str, columns: list[str]) -> DataFrame:
    content = [F.struct(F.min(F.col(f"`{c}`")).alias("least"), F.max(F.col(f"`{c}`")).alias("greatest"), F.count(F.col(f"`{c}`")).alias("values"),
                        F.sum(F.xxhash64(F.col(f"`{c}`")).cast("decimal(38,0)")).alias("hashes")).alias(f"c{i}")
               for i, c in enumerate(columns)]
    return day.groupBy(F.struct(F.col(f"`{key}`").alias("key")).alias("k")).agg(F.count(F.lit(1)).alias("rows"), *content)


def day_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """One row per key that differs: ``key``, ``change``, ``changed`` (columns in their order), ``rows_before``, ``rows_after``.

    ``change`` is ``inserted``, ``deleted`` or ``changed``; ``changed`` is empty
    for the first two. ``columns`` are compared (all but the key, if not given);
    either day may be empty. Unchanged keys have no row.
    """
    if columns is None:
        columns = [c for c in after.columns if c != key]
    old, new = _per_key(before, key, columns).alias("o"), _per_key(after, key, columns).alias("n")
    both = old.join(new, F.col("o.k") == F.col("n.k"), "full_outer")  # a struct is never null: null keys meet
    differs = F.array_compact(F.array(*[F.when(~F.col(f"o.c{i}").eqNullSafe(F.col(f"n.c{i}")), F.lit(c)) for i, c in enumerate(columns)]))
    change = (F.when(F.col("o.k").isNull(), "inserted").when(F.col("n.k").isNull(), "deleted")
               .when((F.col("o.rows") != F.col("n.rows")) | (F.size(differs) > 0), "changed"))
    empty = F.array().cast("array<string>")
    return (both.select(F.coalesce("o.k", "n.k").getField("key").alias(key), change.alias("change"),
                        F.when(change == "changed", differs).otherwise(empty).alias("changed"),
                        F.coalesce("o.rows", F.lit(0)).cast("long").alias("rows_before"), F.coalesce("n.rows", F.lit(0)).cast("long").alias("rows_after"))
            .where(F.col("change").isNotNull()))
