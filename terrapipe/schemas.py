"""Raw and processed schemas, the state-code domain and landing DDL."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The 27 federative-unit codes accepted by the contracts,
# in alphabetical order.
UF_CODES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA",
    "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN",
    "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)

CORRUPT_COLUMN = "_corrupt_record"


def _id_name(*extra: StructField) -> list[StructField]:
    return [StructField("id", LongType()), StructField("nome", StringType()), *extra]


# The raw structs, field by field.
REGION_RAW = StructType([
    StructField("id", LongType()),
    StructField("sigla", StringType()),
    StructField("nome", StringType()),
])

STATE_RAW = StructType([
    StructField("id", LongType()),
    StructField("sigla", StringType()),
    StructField("nome", StringType()),
    StructField("regiao", REGION_RAW),
])

MESOREGION_RAW = StructType(_id_name(StructField("UF", STATE_RAW)))
MICROREGION_RAW = StructType(_id_name(StructField("mesorregiao", MESOREGION_RAW)))
AREA_RAW = StructType(_id_name())

MUNICIPALITY_RAW = StructType([
    StructField("id", LongType()),
    StructField("nome", StringType()),
    StructField("microrregiao", MICROREGION_RAW),
    StructField("regiao-imediata", AREA_RAW),
    StructField("regiao-intermediaria", AREA_RAW),
])


def with_corrupt_column(schema: StructType) -> StructType:
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType())])


# The columns of the processed tables.
STATE_COLUMNS = ("id", "sigla", "nome", "regiao_id", "regiao_sigla", "regiao_nome")

MUNICIPALITY_COLUMNS = (
    "id", "nome", "sigla_uf", "uf_id", "uf_nome",
    "regiao_id", "regiao_sigla", "regiao_nome",
    "mesorregiao_id", "mesorregiao_nome",
    "microrregiao_id", "microrregiao_nome",
    "regiao_imediata_id", "regiao_imediata_nome",
    "regiao_intermediaria_id", "regiao_intermediaria_nome",
)


def _processed(columns: tuple[str, ...]) -> StructType:
    return StructType([
        StructField(c, IntegerType() if c == "id" or c.endswith("_id") else StringType())
        for c in columns
    ])


STATE_PROCESSED = _processed(STATE_COLUMNS)
MUNICIPALITY_PROCESSED = _processed(MUNICIPALITY_COLUMNS)

LOAD_TS_COLUMN = "loaded_at"
LOAD_DAY_COLUMN = "load_date"


def landing_schema(processed: StructType) -> StructType:
    return StructType([
        *processed.fields,
        StructField(LOAD_TS_COLUMN, TimestampType()),
        StructField(LOAD_DAY_COLUMN, DateType()),
    ])


# Landing column limits (VARCHAR caps) per dataset.
STATE_LIMITS = {"sigla": 2, "nome": 100, "regiao_sigla": 2, "regiao_nome": 100}
MUNICIPALITY_LIMITS = {
    "nome": 200, "sigla_uf": 2, "uf_nome": 100, "regiao_sigla": 2,
    "regiao_nome": 100, "mesorregiao_nome": 100, "microrregiao_nome": 100,
    "regiao_imediata_nome": 200, "regiao_intermediaria_nome": 200,
}

# Landing table comments.
STATE_COMMENT = "States landing table (idempotent daily load)"
MUNICIPALITY_COMMENT = "Municipalities landing table (idempotent daily load)"
