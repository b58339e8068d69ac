"""Mergeable summaries per load day: quantiles, distinct counts and frequent values of any range of days.

:func:`day_sketches` reads a landing table once per day and stores one row per
day and group with three sketches; questions about a range of days merge the
stored rows and never read the days again. All three are combined map-side,
so a hot day or group is one row per task in the shuffle.

- quantiles: KLL with k = :data:`KLL_K`; a rank is off by at most :data:`RANK_ERROR` of the
  rows (the 99 % bound of one question is less than half of that).
- distinct count: HyperLogLog with 2**:data:`HLL_LG_K` buckets; the relative error is
  at most :data:`DISTINCT_ERROR` (three standard errors of 1.04 / sqrt(2**lg k)).
- frequent values: an item list of :data:`TOP_TRACKED` counters; a count is off by
  at most :data:`COUNT_ERROR` of the rows, and exact while there are fewer values
  than 3/4 of the counters.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K = 800
RANK_ERROR = 0.01
HLL_LG_K = 14
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(2 ** HLL_LG_K)
TOP_TRACKED = 10_000
COUNT_ERROR = 3.5 / TOP_TRACKED


def day_sketches(rows: DataFrame, day: str, measure: str, identity: str, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per day (and ``keys``): ``n`` and the sketches of ``measure`` (quantiles), ``identity``
    (distinct count) and ``value`` (frequent values)."""
    return rows.groupBy(F.col(day).alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_double(F.col(measure).cast("double"), F.lit(KLL_K)).alias("quantiles"),
        F.hll_sketch_agg(identity, F.lit(HLL_LG_K)).alias("identities"),
        F.call_function("approx_top_k_accumulate", F.col(value), F.lit(TOP_TRACKED)).alias("values"))


def _range(sketches: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first is not None:
        sketches = sketches.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        sketches = sketches.where(F.col("day") <= F.lit(last).cast("date"))
    return sketches


def range_quantiles(sketches: DataFrame, quantiles: tuple[float, ...], first: str | None = None, last: str | None = None,
                    keys: tuple[str, ...] = ()) -> DataFrame:
    """The measure's ``quantiles`` over the days from ``first`` to ``last``: ``keys``, quantile, value."""
    merged = _range(sketches, first, last).groupBy(*keys).agg(F.kll_merge_agg_double("quantiles").alias("sketch"), F.sum("n").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("value"))
                               for q in quantiles]))
    return merged.where("n > 0 AND kll_sketch_get_n_double(sketch) > 0").select(*keys, each.alias("e")).select(*keys, "e.quantile", "e.value")


def range_distinct(sketches: DataFrame, first: str | None = None, last: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """How many identities the days from ``first`` to ``last`` have together, about."""
    return _range(sketches, first, last).groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("identities")).alias("distinct"))


def range_frequent(sketches: DataFrame, k: int, first: str | None = None, last: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """The ``k`` most frequent values over the days from ``first`` to ``last``: ``keys``, value, count."""
    merged = _range(sketches, first, last).groupBy(*keys).agg(F.call_function("approx_top_k_combine", F.col("values"), F.lit(TOP_TRACKED)).alias("s"))
    return merged.select(*keys, F.explode(F.call_function("approx_top_k_estimate", F.col("s"), F.lit(k))).alias("e")).select(
        *keys, F.col("e.item").alias("value"), F.col("e.count").alias("count"))
