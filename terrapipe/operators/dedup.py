"""Deterministic de-duplication (A2).

``dropDuplicates`` keeps an arbitrary survivor. Here the survivor is the
smallest remaining row in struct order (NULL lowest), computed as
``groupBy(keys).agg(min(struct(rest)))``: a partial aggregate runs before
the shuffle, so a key that holds a third of all rows still reaches the
reducer as one row per map task, never as one giant group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW, _COPIES = "__row", "__copies"


def dedup(df: DataFrame, keys: str | list[str] | tuple[str, ...], few_distinct: bool = False) -> DataFrame:
    """``few_distinct``: the operator knows that few different rows stand behind
    each key (a dimension at the grain of its facts); equal rows are then
    hashed together first, so that only those few are sorted."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if few_distinct:  # the count keeps the optimiser from dropping the grouping below min()
        columns = df.columns
        df = (df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias(_COPIES))
              .where(F.col(_COPIES) > 0).select(*[F.col(f"`{c}`") for c in columns]))
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    kept = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias(_ROW)
    )
    return kept.select(*[
        F.col(f"`{c}`") if c in keys else F.col(f"{_ROW}.`{c}`").alias(c)
        for c in df.columns
    ])
