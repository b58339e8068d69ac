"""Nested raw batches to typed tables (P10, P11, O1) and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from terrapipe.functions.clean import clean_code, clean_title, optional_path, to_int
from terrapipe.operators.dedup import dedup

UF_PATH = "microrregiao.mesorregiao.UF"
IMMEDIATE_PATH = "`regiao-imediata`"
INTERMEDIATE_PATH = "`regiao-intermediaria`"


def transform_states(raw: DataFrame, deduplicate: bool = True, sort: bool = True) -> DataFrame:
    """Raw states -> ``id, sigla, nome, regiao_id, regiao_sigla, regiao_nome``."""
    df = raw.select(
        to_int("id").alias("id"),
        clean_code("sigla").alias("sigla"),
        clean_title("nome").alias("nome"),
        to_int("regiao.id").alias("regiao_id"),
        clean_code("regiao.sigla").alias("regiao_sigla"),
        clean_title("regiao.nome").alias("regiao_nome"),
    )
    if deduplicate:
        df = dedup(df, "id", few_distinct=True)
    return df.orderBy("id") if sort else df


def transform_municipalities(
    raw: DataFrame,
    immediate_path: str = IMMEDIATE_PATH,
    intermediate_path: str = INTERMEDIATE_PATH,
    deduplicate: bool = True,
    sort: bool = True,
) -> DataFrame:
    """Raw municipalities -> the 16 typed columns, one ``select``.

    The state/region/meso/micro paths are required (a missing one fails at
    analysis); the immediate and intermediate region paths are optional and
    give typed NULLs when any step is absent.
    """
    uf = UF_PATH

    def optional(path: str, leaf: str, dtype):
        return optional_path(raw, f"{path}.{leaf}", dtype)

    df = raw.select(
        to_int("id").alias("id"),
        clean_title("nome").alias("nome"),
        clean_code(f"{uf}.sigla").alias("sigla_uf"),
        to_int(f"{uf}.id").alias("uf_id"),
        clean_title(f"{uf}.nome").alias("uf_nome"),
        to_int(f"{uf}.regiao.id").alias("regiao_id"),
        clean_code(f"{uf}.regiao.sigla").alias("regiao_sigla"),
        clean_title(f"{uf}.regiao.nome").alias("regiao_nome"),
        to_int("microrregiao.mesorregiao.id").alias("mesorregiao_id"),
        clean_title("microrregiao.mesorregiao.nome").alias("mesorregiao_nome"),
        to_int("microrregiao.id").alias("microrregiao_id"),
        clean_title("microrregiao.nome").alias("microrregiao_nome"),
        optional(immediate_path, "id", IntegerType()).alias("regiao_imediata_id"),
        clean_title(optional(immediate_path, "nome", StringType())).alias("regiao_imediata_nome"),
        optional(intermediate_path, "id", IntegerType()).alias("regiao_intermediaria_id"),
        clean_title(optional(intermediate_path, "nome", StringType())).alias("regiao_intermediaria_nome"),
    )
    if deduplicate:
        df = dedup(df, "id")
    return df.orderBy("nome", "id") if sort else df


# Dimension levels: (id column, attribute columns...) taken from the
# municipality table.
LEVELS = {
    "regiao": ("regiao_id", "regiao_sigla", "regiao_nome"),
    "uf": ("uf_id", "sigla_uf", "uf_nome", "regiao_id"),
    "mesorregiao": ("mesorregiao_id", "mesorregiao_nome", "uf_id"),
    "microrregiao": ("microrregiao_id", "microrregiao_nome", "mesorregiao_id"),
    "regiao_imediata": ("regiao_imediata_id", "regiao_imediata_nome", "uf_id"),
    "regiao_intermediaria": ("regiao_intermediaria_id", "regiao_intermediaria_nome", "uf_id"),
}


def dimension(municipalities: DataFrame, level: str) -> DataFrame:
    """One row per territorial unit of ``level`` (N1), ordered by id."""
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; one of {sorted(LEVELS)}")
    key, *attrs = LEVELS[level]
    units = municipalities.select(key, *attrs).where(F.col(key).isNotNull())
    return dedup(units, key, few_distinct=True).orderBy(key)
