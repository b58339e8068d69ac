"""Slices of a long aggregate series.

The series is a fact table ``table_id, period, variable_id, level,
locality_id, value``. A territorial filter is ``N<level>[all]`` or
``N<level>[<id>]``. Period ``"last"`` means the greatest period present in
that table + variable + territory slice, evaluated as a scalar subquery;
periods compare as text, as the codes of one series have one length
(``yyyy``, ``yyyymm``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The series is stored once, one folder per table, variable, level and period.
FACT_PARTITIONS = ("table_id", "variable_id", "level", "period")
FACT_SCHEMA = "locality_id int, value double, table_id int, variable_id int, level string, period string"
_TERRITORY = re.compile(r"^N(\d+)\[(all|\d+)\]$")


def parse_territory(territory: str) -> tuple[str, int | None]:
    match = _TERRITORY.match(territory.strip())
    if not match:
        raise ValueError(f"bad territorial filter {territory!r}; expected N<level>[all] or N<level>[<id>]")
    level, which = match.groups()
    return f"N{level}", None if which == "all" else int(which)


def write_facts(facts: DataFrame, path: str) -> str:
    """Store the series. Rows are brought together by folder before they are written, so a folder has few
    files, not one per task; adaptive execution splits large folders by size and joins small ones in a task."""
    facts.hint("rebalance", *[F.col(c) for c in FACT_PARTITIONS]).write.mode("overwrite").partitionBy(*FACT_PARTITIONS).parquet(path)
    return path


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """The stored series; a slice's predicates prune its folders."""
    return spark.read.schema(FACT_SCHEMA).parquet(path)


def aggregate_slice(facts: DataFrame, table: int, period: int | str, variable: int,
                    territory: str = "N1[all]") -> DataFrame:
    level, locality = parse_territory(territory)
    cond = ((F.col("table_id") == table) & (F.col("variable_id") == variable)
            & (F.col("level") == level))
    if locality is not None:
        cond = cond & (F.col("locality_id") == locality)
    sliced = facts.where(cond)
    if str(period).strip().lower() == "last":
        return sliced.where(F.col("period") == sliced.select(F.max("period")).scalar())
    return sliced.where(F.col("period") == F.lit(str(period)))
