"""Exploratory aggregates (A1, A3-A8): counts, frequency, top-k, describe,
share and the summary row.

Group counts are hash aggregates with map-side combine. Totals needed next
to per-group rows come from a scalar subquery over the aggregated counts
(``DataFrame.scalar``), so no join, no cross product and no unpartitioned
window is involved. Ties are always broken by the key, ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """``column, count`` for non-NULL values (value_counts semantics)."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("count")))


def frequency(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Descending counts; ``k`` keeps the top-k (TakeOrderedAndProject)."""
    ranked = group_counts(df, column).orderBy(F.desc("count"), F.asc(column))
    return ranked.limit(k) if k is not None else ranked


def describe_counts(df: DataFrame, column: str, k: int | None = 10) -> DataFrame:
    """Eight-number summary of the (top-k) group counts, one row. Without
    ``k`` the counts are summarised unordered (no global sort needed); the
    exact percentiles then hold one entry per distinct count in one buffer."""
    counts = frequency(df, column, k) if k is not None else group_counts(df, column)
    q = F.percentile(F.col("count"), [0.25, 0.5, 0.75])
    return counts.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("count").alias("mean"),
        F.stddev_samp("count").alias("std"),
        F.min("count").alias("min"),
        q.alias("_q"),
        F.max("count").alias("max"),
    ).select(
        "count", "mean", "std", "min",
        F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"),
        "max",
    )


def share(df: DataFrame, column: str, decimals: int = 1) -> DataFrame:
    """``column, count, pct``: each group's share of the non-NULL rows, in %."""
    counts = group_counts(df, column)
    total = counts.select(F.sum("count")).scalar()
    return (counts.withColumn("pct", F.round(F.col("count") * 100.0 / total, decimals))
                  .orderBy(F.desc("count"), F.asc(column)))


def distinct_count(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.agg(F.count_distinct(F.col(column)).alias(name or f"distinct_{column}"))


def summary(states: DataFrame, municipalities: DataFrame, uf_column: str = "sigla_uf") -> DataFrame:
    """One row: states, municipalities, states that have municipalities."""
    n_states = states.select(F.count(F.lit(1))).scalar()
    return municipalities.agg(
        n_states.alias("states"),
        F.count(F.lit(1)).alias("municipalities"),
        F.count_distinct(F.col(uf_column)).alias("states_with_municipalities"),
    )
