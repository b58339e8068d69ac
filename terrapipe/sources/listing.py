"""Listings over the processed tables.

Names are listed in binary order, or with ``collation`` in that of a language
(``pt``: "Água" stands before "Belém", not behind "Zé"). Names that a collation
holds for equal are told apart by their binary order, then by id, so the
order is total whatever the collation ignores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_order(collation: str | None = None) -> list[Column]:
    """The keys that order rows by name: the collated name if asked for, the name itself, the id."""
    return ([F.collate("nome", collation)] if collation else []) + [F.col("nome"), F.col("id")]


def list_states(states: DataFrame, collation: str | None = None) -> DataFrame:
    return states.orderBy(*name_order(collation))


def list_municipalities(municipalities: DataFrame, state: int | str | None = None, collation: str | None = None) -> DataFrame:
    """All municipalities, or those of one state given by numeric id (int or
    digit string) or by letter code; ordered by name. The predicate is a
    plain column comparison, so it reaches the Parquet scan."""
    df = municipalities
    if state is not None:
        text = str(state).strip()
        if isinstance(state, int) or text.isdigit():
            df = df.where(F.col("uf_id") == F.lit(int(text)))
        else:
            df = df.where(F.col("sigla_uf") == F.lit(text.upper()))
    return df.orderBy(*name_order(collation))
