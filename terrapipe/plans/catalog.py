"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the survey's inventory, each over the whole driver tables.

Queries that exercise a sink write eagerly into a fresh run directory
below the shared checkpoint folder and return a DataFrame that reads the
written files back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from terrapipe.functions.clean import (
    clean_code, clean_title, first_present, flatten, optional_path, to_int,
)
from terrapipe.operators import quality as Q
from terrapipe.operators.analytics import describe_counts, distinct_count, frequency, share, summary
from terrapipe.operators.dedup import dedup
from terrapipe.operators.hierarchy import dimension, transform_municipalities, transform_states
from terrapipe.plans import fixtures as fx
from terrapipe.plans.daily import ingest, landing_path, load_all, run_day, transform_stage
from terrapipe.schemas import (
    CORRUPT_COLUMN,
    MUNICIPALITY_PROCESSED,
    MUNICIPALITY_RAW,
    STATE_COMMENT,
    STATE_LIMITS,
    STATE_PROCESSED,
    STATE_RAW,
    UF_CODES,
)
from terrapipe.session import count_files, run_dir
from terrapipe.sinks.files import preview, write_csv, write_json, write_parquet
from terrapipe.sinks.landing import create_landing, landing_duplicates, read_day, replace_day, stamp
from terrapipe.sources.aggregates import aggregate_slice, read_facts, write_facts
from terrapipe.sources.listing import list_municipalities, list_states
from terrapipe.sources.readers import read_csv, read_json, read_parquet, read_preferred

Query = Callable[[SparkSession, str], DataFrame]

# Fixed test parameters of the catalogue.
SLICE_YEAR = 1997
SLICE_STATE = 5
LIST_STATE_ID = 16
LIST_STATE_CODE = "rj"
LOAD_TS = "2024-01-01 23:30:00"
LOAD_TS_DAY2 = "2024-01-02 08:00:00"
LOAD_DAY = "2024-01-01"
CHANGED_STATE = "RJ"
DESCRIBE_DECIMALS = 6


def states(spark: SparkSession, sf: str, sort: bool = True) -> DataFrame:
    return transform_states(fx.raw_states(spark, sf), sort=sort)


def municipalities(spark: SparkSession, sf: str, sort: bool = True) -> DataFrame:
    return transform_municipalities(fx.raw_municipalities(spark, sf), sort=sort)


def faulted_states(spark: SparkSession, sf: str) -> DataFrame:
    return transform_states(fx.raw_states(spark, sf, faults=True), deduplicate=False, sort=False)


def faulted_municipalities(spark: SparkSession, sf: str) -> DataFrame:
    return transform_municipalities(fx.raw_municipalities(spark, sf, faults=True),
                                    deduplicate=False, sort=False)


def _report(df: DataFrame, example: bool = False) -> DataFrame:
    cols = ["rule", "column", "bad_rows", "total_rows"] + (["example"] if example else [])
    return df.select(*cols)


# --- minimum slice -------------------------------------------------------

def q_transform_states(spark, sf):
    return states(spark, sf)


def q_transform_municipalities(spark, sf):
    return municipalities(spark, sf)


def q_top_states(spark, sf):
    return frequency(municipalities(spark, sf), "sigla_uf", 10)


# --- analytics -----------------------------------------------------------

def q_describe_top(spark, sf):
    d = describe_counts(municipalities(spark, sf), "sigla_uf", 10)
    return d.select(*[F.round(c, DESCRIBE_DECIMALS).alias(c) if c in ("mean", "std", "p25", "p50", "p75")
                      else F.col(c) for c in d.columns])


def q_freq_region(spark, sf):
    return frequency(municipalities(spark, sf), "regiao_nome")


def q_share_region(spark, sf):
    return share(municipalities(spark, sf), "regiao_nome")


def q_summary(spark, sf):
    return summary(states(spark, sf), municipalities(spark, sf))


def q_dim_regions(spark, sf):
    return dimension(municipalities(spark, sf), "regiao")


def q_dim_states(spark, sf):
    return dimension(municipalities(spark, sf), "uf")


def q_dim_microregions(spark, sf):
    return dimension(municipalities(spark, sf), "microrregiao")


def _with_intermediate(spark, sf):
    """Municipalities from a raw batch that carries the intermediate region too."""
    return transform_municipalities(fx.raw_municipalities(spark, sf, intermediate=True), sort=False)


def q_dim_mesoregions(spark, sf):
    return dimension(municipalities(spark, sf, sort=False), "mesorregiao")


def q_dim_immediate(spark, sf):
    return dimension(_with_intermediate(spark, sf), "regiao_imediata")


def q_dim_intermediate(spark, sf):
    return dimension(_with_intermediate(spark, sf), "regiao_intermediaria")


def q_distinct_states(spark, sf):
    return distinct_count(municipalities(spark, sf), "sigla_uf", "states_with_municipalities")


# --- listings and slices -------------------------------------------------

def q_list_states(spark, sf):
    return list_states(states(spark, sf)).select("id", "sigla", "nome")


#: What listings and slices read, stored once per application and input.
_stores: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf: str, name: str, write: Callable[[str], object]) -> str:
    """The folder of a store that several queries read; ``write`` fills it when it is first asked for."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stores:
        path = run_dir(spark, name)
        write(path)
        _stores[key] = path
    return _stores[key]


def _stored_municipalities(spark, sf):
    """The processed Parquet, as listings read it."""
    return read_parquet(spark, stored(spark, sf, "listed_municipalities",
                                      lambda path: write_parquet(municipalities(spark, sf, sort=False), path)))


def q_list_all_municipalities(spark, sf):
    return list_municipalities(_stored_municipalities(spark, sf)).select("id", "nome", "sigla_uf")


def q_list_by_state_id(spark, sf):
    return list_municipalities(_stored_municipalities(spark, sf), LIST_STATE_ID).select("id", "nome")


def q_list_by_state_code(spark, sf):
    return list_municipalities(_stored_municipalities(spark, sf), LIST_STATE_CODE).select("id", "nome")


def _slice(spark, sf, period, territory):
    facts = read_facts(spark, stored(spark, sf, "facts", lambda path: write_facts(fx.aggregate_facts(spark, sf), path)))
    return (aggregate_slice(facts, fx.FACT_TABLE_ID, period, fx.FACT_VARIABLE_ID, territory)
            .select("period", "locality_id", "value"))


def q_agg_slice_all(spark, sf):
    return _slice(spark, sf, SLICE_YEAR, "N3[all]")


def q_agg_slice_one(spark, sf):
    return _slice(spark, sf, SLICE_YEAR, f"N3[{SLICE_STATE}]")


def q_agg_slice_last(spark, sf):
    return _slice(spark, sf, "last", "N1[all]")


def q_agg_slice_last_one(spark, sf):
    return _slice(spark, sf, "last", f"N3[{SLICE_STATE}]")


def q_preview(spark, sf):
    return preview(states(spark, sf), 10, ["id"])


# --- scans and sinks -----------------------------------------------------

def q_parquet_scan(spark, sf):
    return read_parquet(spark, f"{sf.rstrip('/')}/supplier.parquet")


def q_parquet_roundtrip(spark, sf):
    path = write_parquet(states(spark, sf), run_dir(spark, "states_parquet"))
    return read_parquet(spark, path)


def q_csv_scan(spark, sf):
    """Types as inferred from every line: the keys fit 32 bits."""
    path = write_csv(fx.table(spark, sf, "customer"), run_dir(spark, "customer_csv"))
    return read_csv(spark, path)


def q_csv_roundtrip(spark, sf):
    path = write_csv(municipalities(spark, sf, sort=False), run_dir(spark, "municipalities_csv"))
    return read_csv(spark, path, schema=MUNICIPALITY_PROCESSED).withColumnRenamed(CORRUPT_COLUMN, "corrupt")


def q_csv_misfits(spark, sf):
    """Lines whose key is no number or that have a field too many carry themselves."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    lines = fx.table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("no "), key, F.lit(";"), name))
         .when(F.col("c_custkey") % 11 == 0, F.concat(key, F.lit(";"), name, F.lit(";surplus")))
         .otherwise(F.concat(key, F.lit(";"), name)).alias("value"))
    path = run_dir(spark, "misfits_csv")
    lines.write.text(path)
    schema = StructType([StructField("key", LongType()), StructField("name", StringType())])
    return read_csv(spark, path, header=False, schema=schema).withColumnRenamed(CORRUPT_COLUMN, "corrupt")


def q_json_scan(spark, sf):
    path = write_json(fx.raw_municipalities(spark, sf), run_dir(spark, "municipalities_json"))
    raw = read_json(spark, path, MUNICIPALITY_RAW)
    return raw.select(
        "id", "nome",
        F.col("microrregiao.id").alias("microrregiao_id"),
        F.col("microrregiao.mesorregiao.UF.sigla").alias("uf_sigla"),
        F.col("microrregiao.mesorregiao.UF.regiao.nome").alias("regiao_nome"),
        F.col("`regiao-imediata`.id").alias("imediata_id"),
        F.col("`regiao-intermediaria`.id").alias("intermediaria_id"),
        F.col(CORRUPT_COLUMN).alias("corrupt"),
    )


def q_json_roundtrip(spark, sf):
    path = write_json(fx.raw_states(spark, sf), run_dir(spark, "states_json"))
    return flatten(read_json(spark, path, STATE_RAW).drop(CORRUPT_COLUMN))


def q_fallback_scan(spark, sf):
    raw = write_json(fx.raw_municipalities(spark, sf), run_dir(spark, "fallback_raw"))
    missing = run_dir(spark, "fallback_processed")
    df = read_preferred(spark, missing, raw, MUNICIPALITY_RAW, {
        "microrregiao.mesorregiao.UF.sigla": "sigla_uf",
        "microrregiao.mesorregiao.UF.regiao.nome": "regiao_nome",
    })
    return df.select("id", "sigla_uf", "regiao_nome")


# --- landing -------------------------------------------------------------

def landed(df: DataFrame) -> DataFrame:
    """Landed rows with the load time without its zone, as the oracle has it."""
    return df.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


def q_stamp_day(spark, sf):
    """Two days written, one read back from its own folder."""
    target = run_dir(spark, "stamped")
    batch = materialised(spark, municipalities(spark, sf, sort=False).select("id", "nome"), "stamped_batch")
    for ts in (LOAD_TS, LOAD_TS_DAY2):
        stamp(batch, ts).write.mode("append").partitionBy("load_date").parquet(target)
    return landed(read_day(spark, target, LOAD_DAY))


def changed_batch(muni: DataFrame) -> DataFrame:
    return (muni.where(F.col("sigla_uf") != CHANGED_STATE)
                .withColumn("nome", F.upper("nome")))


def materialised(spark, df: DataFrame, name: str) -> DataFrame:
    """Write a processed batch once (as the daily job does) and read it back,
    so gates and loads scan Parquet instead of recomputing the lineage."""
    return read_parquet(spark, write_parquet(df, run_dir(spark, name)))


def q_replace_day(spark, sf):
    target = run_dir(spark, "landing_municipalities")
    muni = materialised(spark, municipalities(spark, sf, sort=False), "processed_municipalities")
    limits = Q.MUNICIPALITY_LANDING_RULES
    replace_day(muni, target, LOAD_TS, Q.MUNICIPALITIES_CONTRACT, limits)
    replace_day(muni, target, LOAD_TS_DAY2, Q.MUNICIPALITIES_CONTRACT, limits)
    replace_day(changed_batch(muni), target, LOAD_TS_DAY2, Q.MUNICIPALITIES_CONTRACT, limits)
    return read_parquet(spark, target).select("id", "nome", "sigla_uf", "load_date")


def q_landing_dupes(spark, sf):
    target = run_dir(spark, "landing_unchecked")
    batch = stamp(transform_municipalities(fx.raw_municipalities(spark, sf), deduplicate=False, sort=False), LOAD_TS)
    batch.write.mode("append").partitionBy("load_date").parquet(target)
    return landing_duplicates(read_parquet(spark, target))


def q_load_counts(spark, sf):
    base = run_dir(spark, "landing")
    # landing tables have no order: materialise the batches unsorted
    load_all(spark, {"states": materialised(spark, states(spark, sf, sort=False), "processed_states"),
                     "municipalities": materialised(spark, municipalities(spark, sf, sort=False),
                                                     "processed_municipalities")},
             base, LOAD_TS)
    return landing_rows(spark, base)


def landing_rows(spark, base, datasets=("states", "municipalities")):
    """The day's landed rows of the tables: id, name, state code and load time."""
    parts = [landed(read_day(spark, landing_path(base, name), LOAD_DAY)).select(
                 F.lit(name).alias("dataset"), "id", "nome", F.col(code).alias("code"), "load_date", "loaded_at")
             for name, code in (("states", "sigla"), ("municipalities", "sigla_uf")) if name in datasets]
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def q_daily_run(spark, sf):
    base = run_dir(spark, "daily")
    for _ in range(2):
        run_day(spark, fx.raw_states(spark, sf), fx.raw_municipalities(spark, sf), base, LOAD_TS)
    return landing_rows(spark, base)


def q_landing_ddl(spark, sf):
    """A landing table made by DDL, loaded through the catalogue by column name, read back."""
    table = f"terrapipe_landing.states_{uuid.uuid4().hex}"
    create_landing(spark, table, STATE_PROCESSED, STATE_COMMENT, run_dir(spark, "landing_ddl"), STATE_LIMITS)
    batch = materialised(spark, states(spark, sf, sort=False), "ddl_states")
    swapped = batch.select(*reversed(batch.columns))
    replace_day(swapped, table, LOAD_TS, Q.STATES_CONTRACT, Q.STATE_LANDING_RULES, as_table=True)
    return landed(spark.table(table))


def q_reject_keeps_day(spark, sf):
    """A batch with repeated ids is refused; the day keeps the rows of the good load."""
    target = run_dir(spark, "landing_reject")
    good = materialised(spark, municipalities(spark, sf, sort=False), "good_municipalities")
    replace_day(good, target, LOAD_TS, Q.MUNICIPALITIES_CONTRACT, Q.MUNICIPALITY_LANDING_RULES)
    bad = materialised(spark, faulted_municipalities(spark, sf), "bad_municipalities")
    refused = _refused(lambda: replace_day(bad, target, LOAD_TS, Q.MUNICIPALITIES_CONTRACT, Q.MUNICIPALITY_LANDING_RULES))
    return landed(read_day(spark, target, LOAD_DAY)).select("id", "nome", "sigla_uf", "loaded_at", F.lit(refused).alias("refused"))


def _refused(load: Callable[[], object]) -> bool:
    try:
        load()
    except Q.DataQualityError:
        return True
    return False


def q_unregistered_load(spark, sf):
    """A table without a contract is loaded as it is, faults and repeated ids included."""
    base = run_dir(spark, "landing_unregistered")
    load_all(spark, {"drafts": materialised(spark, faulted_municipalities(spark, sf), "drafts")}, base, LOAD_TS)
    return read_day(spark, landing_path(base, "drafts"), LOAD_DAY).select("id", "nome", "sigla_uf", "load_date")


def q_column_contract(spark, sf):
    """A processed table with a text id and without the state code, against the contract."""
    batch = materialised(spark, municipalities(spark, sf, sort=False).withColumn("id", F.col("id").cast("string")).drop("sigla_uf"), "mistyped")
    return Q.MUNICIPALITIES_CONTRACT.column_report(batch).withColumn("rows", batch.select(F.count(F.lit(1))).scalar())


# --- stages ----------------------------------------------------------------

def q_ingest_land(spark, sf):
    """Gate 1, then the raw batch as landed."""
    path = ingest(fx.raw_states(spark, sf), "states", run_dir(spark, "ingest"))
    return flatten(read_json(spark, path, STATE_RAW).drop(CORRUPT_COLUMN))


def q_ingest_rejected(spark, sf):
    """Batches with bad rows: refused by either way of ingesting, no file left."""
    rows = []
    for dataset, raw in (("states", fx.raw_states(spark, sf, faults=True)),
                         ("municipalities", fx.raw_municipalities(spark, sf, faults=True))):
        for single_pass in (False, True):
            base = run_dir(spark, "ingest_rejected")
            refused = _refused(lambda raw=raw, dataset=dataset, base=base, once=single_pass: ingest(raw, dataset, base, once))
            rows.append((dataset, single_pass, refused, count_files(spark, base)))
    return spark.createDataFrame(rows, "dataset string, single_pass boolean, refused boolean, files_left long")


def _staged(spark, sf):
    """The transform stage over landed states and a municipality input that does not exist."""
    raw = ingest(fx.raw_states(spark, sf), "states", run_dir(spark, "stage_raw"))
    return transform_stage(spark, {"states": raw, "municipalities": run_dir(spark, "stage_missing")}, run_dir(spark, "stage"))


def q_transform_stage(spark, sf):
    """The stage's CSV export, read back."""
    return read_csv(spark, _staged(spark, sf)["states"]["csv"], schema=STATE_PROCESSED).drop(CORRUPT_COLUMN)


def q_optional_dataset(spark, sf):
    """Rows that the stage produced by dataset; the missing input is skipped, not an error."""
    result = _staged(spark, sf)
    counts = [read_parquet(spark, entry["path"]).agg(F.lit(name).alias("dataset"), F.lit(False).alias("skipped"), F.count(F.lit(1)).alias("rows"))
              if not entry["skipped"] else spark.range(1).select(F.lit(name).alias("dataset"), F.lit(True).alias("skipped"), F.lit(0).cast("long").alias("rows"))
              for name, entry in result.items()]
    return counts[0].unionByName(counts[1])


def q_order_proof(spark, sf):
    """O1 as written: each row's place, by part file and row within it, next to its values."""
    path = write_parquet(municipalities(spark, sf), run_dir(spark, "ordered"))
    rows = read_parquet(spark, path).select("nome", "id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))  # a row per part file
    return rows.join(before, "file").select("id", "nome", (F.col("before") + F.col("row") + 1).alias("place"))


# --- projections and scalar functions ------------------------------------

def q_cast_ids(spark, sf):
    c = fx.table(spark, sf, "customer")
    return c.select(
        "c_custkey",
        to_int(F.substring("c_name", 10, 20)).alias("from_name"),
        to_int(F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" "))).alias("padded"),
        to_int("c_mktsegment").alias("from_text"),
        to_int(F.concat(F.col("c_custkey").cast("string"), F.lit("0000000"))).alias("wide"),
    )


def q_normalize_names(spark, sf):
    p = fx.table(spark, sf, "part")
    dirty = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return p.select("p_partkey", clean_title(dirty).alias("p_name_clean"),
                    clean_title(F.concat(F.lit(" "), F.col("p_type"))).alias("p_type_clean"))


def q_normalize_codes(spark, sf):
    c = fx.table(spark, sf, "customer")
    dirty = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  "))
    return c.select("c_custkey", clean_code(dirty).alias("segment_code"))


def q_nested_extract(spark, sf):
    raw = fx.raw_municipalities(spark, sf)
    return raw.select(
        "id",
        F.col("microrregiao.id").alias("microrregiao_id"),
        F.col("microrregiao.mesorregiao.id").alias("mesorregiao_id"),
        F.col("microrregiao.mesorregiao.UF.id").alias("uf_id"),
        F.col("microrregiao.mesorregiao.UF.sigla").alias("uf_sigla"),
        F.col("microrregiao.mesorregiao.UF.regiao.sigla").alias("regiao_sigla"),
        F.col("microrregiao.mesorregiao.UF.regiao.nome").alias("regiao_nome"),
    )


def q_optional_nested(spark, sf):
    raw = fx.raw_municipalities(spark, sf)
    return raw.select(
        "id",
        optional_path(raw, "`regiao-imediata`.id", IntegerType()).alias("imediata_id"),
        optional_path(raw, "`regiao-imediata`.nome", StringType()).alias("imediata_nome"),
        optional_path(raw, "`regiao-intermediaria`.id", IntegerType()).alias("intermediaria_id"),
        optional_path(raw, "`regiao-intermediaria`.nome", StringType()).alias("intermediaria_nome"),
    )


def q_flatten_struct(spark, sf):
    return flatten(fx.raw_municipalities(spark, sf))


def q_first_present(spark, sf):
    muni = municipalities(spark, sf, sort=False).withColumnRenamed("sigla_uf", "sigla")
    chosen = first_present(muni, ["sigla_uf", "sigla"])
    return muni.select("id", F.col(chosen).alias("uf"))


def q_dedup(spark, sf):
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedup(li, "l_orderkey")


# --- gates and contracts -------------------------------------------------

def q_gate1_states(spark, sf):
    return _report(Q.check(fx.raw_states(spark, sf, faults=True),
                           [Q.non_empty(), *Q.RAW_STATE_RULES]))


def q_gate1_municipalities(spark, sf):
    return _report(Q.check(fx.raw_municipalities(spark, sf, faults=True),
                           [Q.non_empty(), *Q.RAW_MUNICIPALITY_RULES]))


def q_gate_report(spark, sf):
    return _report(Q.check(fx.raw_municipalities(spark, sf, faults=True),
                           list(Q.RAW_MUNICIPALITY_RULES)), example=True)


def q_gate_report_states(spark, sf):
    return _report(Q.check(fx.raw_states(spark, sf, faults=True), list(Q.RAW_STATE_RULES)), example=True)


def q_dq_positive(spark, sf):
    return _report(Q.check(faulted_municipalities(spark, sf), [Q.positive("id")]), example=True)


def q_dq_unique(spark, sf):
    return _report(Q.check(faulted_municipalities(spark, sf), [Q.unique("id")]), example=True)


def q_dq_not_null(spark, sf):
    return _report(Q.check(faulted_municipalities(spark, sf), [Q.not_null("sigla_uf")]))


def q_dq_length(spark, sf):
    return _report(Q.check(faulted_states(spark, sf), [Q.length_between("sigla", 2, 2)]))


def q_dq_isin(spark, sf):
    return _report(Q.check(faulted_municipalities(spark, sf), [Q.isin("sigla_uf", UF_CODES)]))


def q_dq_max_length(spark, sf):
    return _report(Q.check(faulted_municipalities(spark, sf), list(Q.MUNICIPALITY_LANDING_RULES)))


def q_dq_in_table(spark, sf):
    return Q.check_in_table(faulted_municipalities(spark, sf), "sigla_uf", states(spark, sf), "sigla")


def q_contract_states(spark, sf):
    return _report(Q.STATES_CONTRACT.check(faulted_states(spark, sf)))


def q_contract_municipalities(spark, sf):
    return _report(Q.MUNICIPALITIES_CONTRACT.check(faulted_municipalities(spark, sf)))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
