"""Further queries of the catalogue: versions, payloads, summaries, hierarchy, history, changes, order, layout, gaps and streams.

As in :mod:`terrapipe.plans.catalog`, each is a callable ``(spark, sf_dir) ->
DataFrame`` over the whole driver tables; the SQL that must give the same rows
is in :mod:`terrapipe.plans.extended_oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrapipe.functions.clean import clean_title
from terrapipe.operators import quality as Q
from terrapipe.operators.ancestry import aggregate_below, ancestors, hierarchy_faults, units
from terrapipe.operators.changes import day_changes
from terrapipe.operators.hierarchy import transform_municipalities
from terrapipe.operators.history import as_of, versions
from terrapipe.operators.series import missing_periods, with_gaps
from terrapipe.operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, day_sketches, range_distinct, range_frequent, range_quantiles,
)
from terrapipe.plans import fixtures as fx
from terrapipe.plans.catalog import (
    LOAD_DAY, LOAD_TS, LOAD_TS_DAY2, SLICE_YEAR, changed_batch, landed, landing_rows, materialised, municipalities, stored,
)
from terrapipe.plans.daily import ingest
from terrapipe.schemas import MUNICIPALITY_COMMENT, MUNICIPALITY_LIMITS, MUNICIPALITY_PROCESSED, MUNICIPALITY_RAW
from terrapipe.session import run_dir
from terrapipe.sinks.bucketed import append_bucketed_day, bucketed_day
from terrapipe.sinks.files import write_parquet
from terrapipe.sinks.landing import create_landing, landing_duplicates, stamp
from terrapipe.sinks.switch import switch_day
from terrapipe.sources.listing import list_municipalities
from terrapipe.sources.payload import payload_facts, payload_faults, read_payload
from terrapipe.sources.readers import read_parquet, read_preferred
from terrapipe.streaming.events import run_hourly
from terrapipe.streaming.incremental import load_new_collections

Query = Callable[[SparkSession, str], DataFrame]

#: Range of order dates that the summaries are asked about, and the quantiles.
RANGE = ("1995-01-01", "1996-12-31")
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
COLLATION = "pt"
#: Beginnings of names that binary order and the language's order place differently.
ACCENTED = ("Água", "agua", "Zé", "Éden", "eden", "Ômega", "omega", "ção", "Cao", "Agua")
BUCKETS = 8
#: Territories that the facts below are summed for.
BELOW_REGION, BELOW_ALL = "N2[2]", "N3[all]"


def _table_name(name: str) -> str:
    return f"terrapipe_landing.{name}_{uuid.uuid4().hex}"


# --- landing ---------------------------------------------------------------

def q_switch_day(spark, sf):
    """Two days, the second loaded again with other rows: each load moved in by one statement of the catalogue."""
    table = _table_name("switched")
    create_landing(spark, table, MUNICIPALITY_PROCESSED, MUNICIPALITY_COMMENT, run_dir(spark, "landing_switched"), MUNICIPALITY_LIMITS)
    batch = materialised(spark, municipalities(spark, sf, sort=False), "switched_municipalities")
    for rows, ts in ((batch, LOAD_TS), (batch, LOAD_TS_DAY2), (changed_batch(batch), LOAD_TS_DAY2)):
        switch_day(rows, table, ts, Q.MUNICIPALITIES_CONTRACT, Q.MUNICIPALITY_LANDING_RULES)
    return spark.table(table).select("id", "nome", "sigla_uf", "load_date")


def _repeated(spark, sf) -> DataFrame:
    """Municipalities as transformed, with their repeated and renamed copies."""
    raw = fx.raw_municipalities(spark, sf)
    return transform_municipalities(raw, deduplicate=False, sort=False).select("id", "nome", "sigla_uf", "uf_id")


def _two_days(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The batch, and the batch a day later: some ids gone, some new, some renamed, some without a code."""
    after = batch.where("id % 13 <> 0").select(
        F.when(F.col("id") % 17 == 0, -F.col("id")).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 5 == 0, F.upper("nome")).otherwise(F.col("nome")).alias("nome"),
        F.when(F.col("id") % 7 != 0, F.col("sigla_uf")).alias("sigla_uf"), "uf_id")
    return batch, after


def q_day_changes(spark, sf):
    before, after = _two_days(materialised(spark, _repeated(spark, sf), "changing_municipalities"))
    return _change_rows(day_changes(before, after, "id"))


def _change_rows(changes: DataFrame) -> DataFrame:
    return changes.withColumn("changed", F.concat_ws(",", "changed"))


def q_day_changes_empty(spark, sf):
    """Against a day without rows every id is deleted, with all its repetitions."""
    before = materialised(spark, _repeated(spark, sf), "emptied_municipalities")
    return _change_rows(day_changes(before, before.limit(0), "id"))


def _bucketed(spark, sf) -> str:
    table, location = _table_name("bucketed"), run_dir(spark, "landing_bucketed")
    for batch, ts in zip(_two_days(materialised(spark, _repeated(spark, sf), "bucketed_municipalities")), (LOAD_TS, LOAD_TS_DAY2)):
        append_bucketed_day(batch, table, BUCKETS, location, ts)
    return table


def q_landing_dupes_bucketed(spark, sf):
    """The audit of repeated ids over both days, without a shuffle."""
    return landing_duplicates(spark.table(_bucketed(spark, sf)))


def q_day_changes_bucketed(spark, sf):
    """Ids of the first day that the second lacks, or has otherwise: two days compared bucket by bucket, without a shuffle."""
    table = _bucketed(spark, sf)
    days = [bucketed_day(spark, table, day).groupBy("id").agg(F.count(F.lit(1)).alias(f"rows_{k}"), F.max("nome").alias(f"nome_{k}"))
            for k, day in enumerate((LOAD_DAY, LOAD_TS_DAY2[:10]), 1)]
    both = days[0].join(days[1].hint("merge"), "id", "full_outer")
    return both.where("NOT (nome_1 <=> nome_2)")


# --- payload ---------------------------------------------------------------

def _payload(spark, sf) -> DataFrame:
    path = run_dir(spark, "payload")
    fx.payload_lines(spark, sf).write.text(path)
    return read_payload(spark, path)


def q_agg_payload(spark, sf):
    return payload_facts(_payload(spark, sf), fx.FACT_TABLE_ID)


def q_agg_payload_faults(spark, sf):
    return payload_faults(_payload(spark, sf)).select(F.regexp_extract("line", r'"localidade":\{"id":"(\d+)"', 1).alias("locality"), "fault")


# --- summaries of days -----------------------------------------------------

def _orders(spark, sf) -> DataFrame:
    return fx.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("load_date"), "o_totalprice", "o_custkey", "o_orderpriority")


def _sketched(spark, sf) -> DataFrame:
    """The days' sketches, stored once per application and input."""
    def write(path: str) -> None:
        write_parquet(day_sketches(_orders(spark, sf), "load_date", "o_totalprice", "o_custkey", "o_orderpriority"), path)

    return read_parquet(spark, stored(spark, sf, "day_sketches", write))


def _in_range(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("load_date").between(F.lit(RANGE[0]).cast("date"), F.lit(RANGE[1]).cast("date")))


def q_sketch_quantiles(spark, sf):
    """Quantiles of the range from the days' sketches, each held against the rows: its rank is within the bound."""
    found = [r["value"] for r in range_quantiles(_sketched(spark, sf), QUANTILES, *RANGE).orderBy("quantile").collect()]  # five numbers
    ranks = [F.sum(F.when(F.col("o_totalprice") <= F.lit(value), 1).otherwise(0)).alias(f"r{i}") for i, value in enumerate(found)]
    counted = _in_range(_orders(spark, sf)).agg(F.count(F.lit(1)).alias("n"), *ranks)
    each = F.explode(F.array(*[F.struct(F.lit(q).alias("quantile"), F.col(f"r{i}").alias("rank")) for i, q in enumerate(QUANTILES)]))
    return counted.select("n", each.alias("e")).select(
        F.col("e.quantile").alias("quantile"), "n",
        (F.abs(F.col("e.rank") / F.col("n") - F.col("e.quantile")) <= RANK_ERROR).alias("within"))


def q_sketch_distinct(spark, sf):
    """Customers of the range, exact, and whether the merged estimate is within its bound."""
    estimate = range_distinct(_sketched(spark, sf), *RANGE).select("distinct").scalar()
    exact = _in_range(_orders(spark, sf)).agg(F.count_distinct("o_custkey").alias("customers"))
    return exact.select("customers", (F.abs(estimate - F.col("customers")) <= DISTINCT_ERROR * F.col("customers")).alias("within"))


def q_sketch_top(spark, sf):
    """The most frequent priorities of the range: exact, as there are fewer values than counters."""
    return range_frequent(_sketched(spark, sf), 3, *RANGE)


# --- hierarchy as a graph ----------------------------------------------------

def _tree(spark, sf) -> DataFrame:
    """The units, stored once per application and input."""
    def write(path: str) -> None:
        write_parquet(units(materialised(spark, municipalities(spark, sf, sort=False), "unit_municipalities")), path)

    return read_parquet(spark, stored(spark, sf, "units", write))


def q_ancestry(spark, sf):
    """Every unit above every municipality."""
    tree = _tree(spark, sf)
    return ancestors(tree, tree.where("level = 'N6'").select("level", "id")).select("start_id", "level", "id", "steps")


def q_hierarchy_faults(spark, sf):
    """A region below one of its states, municipalities without their microregion, and units listed twice."""
    tree = _tree(spark, sf)
    bent = tree.withColumns({
        "parent_level": F.when((F.col("level") == "N2") & (F.col("id") == 2), F.lit("N3")).otherwise(F.col("parent_level")),
        "parent_id": F.when((F.col("level") == "N2") & (F.col("id") == 2), F.lit(2))
                      .when((F.col("level") == "N6") & (F.col("id") % 13 == 0), -F.col("parent_id")).otherwise(F.col("parent_id"))})
    return hierarchy_faults(bent.unionByName(bent.where("level = 'N6' AND id % 11 = 0")))


def _below(spark, sf, territory):
    return aggregate_below(fx.municipality_facts(spark, sf), _tree(spark, sf), fx.FACT_TABLE_ID, SLICE_YEAR, fx.FACT_VARIABLE_ID, territory)


def q_agg_below(spark, sf):
    return _below(spark, sf, BELOW_ALL)


def q_agg_below_one(spark, sf):
    return _below(spark, sf, BELOW_REGION)


# --- history ---------------------------------------------------------------

ATTRIBUTES = ["nome", "sigla_uf"]


def _history(spark, sf) -> DataFrame:
    """Versions of the municipalities over three days: some are renamed on the second, some missing on it, some change code on the third."""
    base = materialised(spark, municipalities(spark, sf, sort=False).select("id", *ATTRIBUTES), "history_base")
    name = F.when(F.col("id") % 5 == 0, F.upper("nome")).otherwise(F.col("nome")).alias("nome")
    code = F.when(F.col("id") % 3 != 0, F.col("sigla_uf")).alias("sigla_uf")
    days = [base, base.where("id % 7 <> 0").select("id", name, "sigla_uf"), base.select("id", name, code)]
    target = run_dir(spark, "history_days")
    for batch, ts in zip(days, (LOAD_TS, LOAD_TS_DAY2, fx.HISTORY_TS_DAY3)):
        stamp(batch, ts).write.mode("append").partitionBy("load_date").parquet(target)
    return versions(read_parquet(spark, target), "id", "load_date", ATTRIBUTES)


def q_dim_history(spark, sf):
    return _history(spark, sf).drop("row_hash")


def q_dim_as_of(spark, sf):
    """Orders of five days, one before the first load day, joined to the version of their municipality valid then."""
    history = materialised(spark, _history(spark, sf), "history")
    facts = fx.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") - F.col("o_orderkey") % 4 + 1).cast("int").alias("id"),
        F.date_add(F.lit(LOAD_DAY).cast("date"), (F.col("o_custkey") % 5 - 1).cast("int")).alias("day"))
    return as_of(facts, history, "id", "day", ATTRIBUTES)


# --- order of names ----------------------------------------------------------

def q_list_collated(spark, sf):
    """Each row's place in the listing as written, in the language's order."""
    names = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("id"),
        F.concat(F.element_at(F.array(*[F.lit(a) for a in ACCENTED]), (F.col("c_custkey") % len(ACCENTED) + 1).cast("int")), F.lit(" "),
                 (F.col("c_custkey") % 41).cast("string")).alias("nome"))
    path = write_parquet(list_municipalities(names, collation=COLLATION), run_dir(spark, "collated"))
    rows = read_parquet(spark, path).select("nome", "id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))  # a row per part file
    return rows.join(before, "file").select("id", "nome", (F.col("before") + F.col("row") + 1).alias("place"))


# --- gaps ------------------------------------------------------------------

def q_agg_gaps(spark, sf):
    return with_gaps(fx.customer_facts(spark, sf)).drop("table_id", "variable_id", "level")


def q_agg_missing(spark, sf):
    return missing_periods(with_gaps(fx.customer_facts(spark, sf))).drop("table_id", "variable_id", "level")


# --- sources and streams -------------------------------------------------------

def q_preferred_scan(spark, sf):
    """The processed batch is there, so it is read and the raw one is not."""
    processed = run_dir(spark, "preferred_processed")
    municipalities(spark, sf, sort=False).select("id", "sigla_uf", F.lower("regiao_nome").alias("regiao_nome")).write.parquet(processed)
    df = read_preferred(spark, processed, run_dir(spark, "preferred_missing"), MUNICIPALITY_RAW, {})
    return df.select("id", "sigla_uf", clean_title("regiao_nome").alias("regiao_nome"))


def q_daily_stream(spark, sf):
    """Two collections found by the stream, the second by a later start: the day has the second's rows."""
    base, raw = run_dir(spark, "streamed"), run_dir(spark, "stream_raw")
    for renamed in (True, False):
        batch = fx.raw_municipalities(spark, sf)
        ingest(batch.withColumn("nome", F.lit("Old Name")) if renamed else batch, "municipalities", raw, single_pass=True)
        load_new_collections(spark, f"{raw}/municipalities", "municipalities", base, f"{base}/checkpoint", LOAD_TS)
    return landing_rows(spark, base, ["municipalities"]).drop("dataset")


def q_events_stream(spark, sf):
    """Hours finished by a stream that is stopped half way and started again, over late and repeated records."""
    source, base = run_dir(spark, "events_source"), run_dir(spark, "events_stream")
    for part in fx.event_files(spark, sf):
        part.write.mode("append").parquet(source)  # many files, by many tasks: a delivery is one micro-batch, as its files are not in order of time
        run_hourly(spark, source, f"{base}/hours", f"{base}/checkpoint", files_per_batch=None)
    return spark.read.parquet(f"{base}/hours")


QUERIES: dict[str, Query] = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
