"""Raw territorial batches derived from the driver's star-schema tables.

Municipality grain = ``orders`` joined to customer, nation and region;
state observations are taken at the same grain (one per order), so every
batch grows with the input. Keys get +1 because 0 is falsy for gate 1 and
not positive for gate 2. All derivation is Spark column arithmetic in one
pass over the joined rows; no row is ever fixed or made up on the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.schemas import UF_CODES

# Identifiers of the aggregate series built from orders.
FACT_TABLE_ID = 6579
FACT_VARIABLE_ID = 9324

# Fault and duplicate injection, keyed on the order key. These
# add copies or alter values on every n-th row; they never drop rows.
HISTORY_TS_DAY3 = "2024-01-03 09:00:00"
PAYLOAD_FAULTS = {"cut": 13, "no_results": 17, "no_locality": 23, "no_number": 19}
STATE_FAULTS = {"zero_id": 13, "empty_code": 17, "null_name": 19}
MUNICIPALITY_FAULTS = {"null_micro": 23, "empty_uf_code": 29, "blank_name": 31,
                       "zero_id": 37, "long_name": 41}
COPY_SAME, COPY_RENAMED, STATE_RENAMED = 7, 11, 11


# Schemas of the driver tables the fixtures read. Declaring them
# spares the footer-reading job that schema inference runs on every read.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer x nation x region, only the columns the fixtures use.

    The orders are dealt by key first: a raw batch comes in many pieces, this
    table in a single row group, which one task would read and transform.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_totalprice").repartition("o_orderkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey))


def _hit(every: int) -> Column:
    return (F.col("o_orderkey") % every) == 0


def _region() -> Column:
    return F.struct(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
        F.lower(F.substring("r_name", 1, 2)).alias("sigla"),
        F.concat(F.lower("r_name"), F.lit(" ")).alias("nome"),
    )


def _uf_id() -> Column:
    return (F.col("n_nationkey") + 1).cast("bigint")


def _uf_code() -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in UF_CODES]), (F.col("n_nationkey") + 1).cast("int"))


def raw_states(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """One raw state object per order: ``id, sigla, nome, regiao{id,sigla,nome}``."""
    g = order_grain(spark, sf_dir)
    name = F.concat(F.lit(" "), F.lower("n_name"),
                    F.when(_hit(STATE_RENAMED), F.lit(" do sul")).otherwise(F.lit("")))
    sid, code = _uf_id(), F.concat(F.lit(" "), F.lower(_uf_code()))
    if faults:
        sid = F.when(_hit(STATE_FAULTS["zero_id"]), F.lit(0).cast("bigint")).otherwise(sid)
        code = F.when(_hit(STATE_FAULTS["empty_code"]), F.lit("")).otherwise(code)
        name = F.when(_hit(STATE_FAULTS["null_name"]), F.lit(None).cast("string")).otherwise(name)
    return g.select(sid.alias("id"), code.alias("sigla"), name.alias("nome"), _region().alias("regiao"))


def raw_municipalities(spark: SparkSession, sf_dir: str, faults: bool = False,
                       duplicates: bool = True, intermediate: bool = False) -> DataFrame:
    """One raw municipality per order, nested four levels deep, with an
    optional ``regiao-imediata`` root (and ``regiao-intermediaria`` only on
    request). Duplicates: an identical copy of every ``id % 7 == 0`` row and
    a renamed copy of every ``id % 11 == 0`` row, made with one explode
    (no lambda, so the expression stays inside generated code)."""
    g = order_grain(spark, sf_dir)
    key = F.col("o_orderkey") + 1
    if duplicates:
        copies = F.array_compact(F.array(
            F.lit(0),
            F.when(key % COPY_SAME == 0, F.lit(1)),
            F.when(key % COPY_RENAMED == 0, F.lit(2)),
        ))
        g = g.withColumn("_copy", F.explode(copies))
    else:
        g = g.withColumn("_copy", F.lit(0))

    uf_id = _uf_id()
    meso_id = uf_id * 10 + F.col("o_custkey") % 5
    micro_id = meso_id * 10 + F.col("o_custkey") % 3
    imm_id = uf_id * 100 + F.col("o_custkey") % 7
    inter_id = uf_id * 1000 + F.col("o_custkey") % 4

    suffix = F.when(F.col("_copy") == 2, F.lower("o_orderstatus")).otherwise(F.lower("o_orderpriority"))
    name = F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "), suffix)
    muni_id = F.col("o_orderkey") + 1
    uf_code = F.lower(_uf_code())
    if faults:
        uf_code = F.when(_hit(MUNICIPALITY_FAULTS["empty_uf_code"]), F.lit("")).otherwise(uf_code)
        name = (F.when(_hit(MUNICIPALITY_FAULTS["blank_name"]), F.lit("  "))
                 .when(_hit(MUNICIPALITY_FAULTS["long_name"]), F.repeat(name, 10))
                 .otherwise(name))
        muni_id = F.when(_hit(MUNICIPALITY_FAULTS["zero_id"]), F.lit(0)).otherwise(muni_id)

    uf = F.struct(uf_id.alias("id"), uf_code.alias("sigla"),
                  F.concat(F.lit(" "), F.lower("n_name")).alias("nome"), _region().alias("regiao"))
    meso = F.struct(meso_id.alias("id"), F.concat(F.lit("meso "), meso_id.cast("string")).alias("nome"),
                    uf.alias("UF"))
    micro = F.struct(micro_id.alias("id"), F.concat(F.lit("micro "), micro_id.cast("string")).alias("nome"),
                     meso.alias("mesorregiao"))
    if faults:
        micro = F.when(_hit(MUNICIPALITY_FAULTS["null_micro"]), F.lit(None)).otherwise(micro)
    cols = [
        muni_id.cast("bigint").alias("id"), name.alias("nome"), micro.alias("microrregiao"),
        F.struct(imm_id.alias("id"),
                 F.concat(F.lit(" imediata "), imm_id.cast("string")).alias("nome")).alias("regiao-imediata"),
    ]
    if intermediate:
        cols.append(F.struct(inter_id.alias("id"),
                             F.concat(F.lit("intermediaria "), inter_id.cast("string")).alias("nome"))
                    .alias("regiao-intermediaria"))
    return g.select(*cols)


def aggregate_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long aggregate series: yearly order value per state (N3) and country
    (N1), one rollup pass over orders x customer."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = (o.join(c, o.o_custkey == c.c_custkey)
             .select(F.year("o_orderdate").cast("string").alias("period"),
                     (F.col("c_nationkey") + 1).cast("int").alias("state"),
                     "o_totalprice"))
    rolled = (rows.rollup("period", "state")
                  .agg(F.sum("o_totalprice").alias("total"), F.grouping("state").alias("_g"),
                       F.grouping("period").alias("_gp"))
                  .where(F.col("_gp") == 0))
    return rolled.select(
        F.lit(FACT_TABLE_ID).alias("table_id"),
        F.col("period"),
        F.lit(FACT_VARIABLE_ID).alias("variable_id"),
        F.when(F.col("_g") == 1, F.lit("N1")).otherwise(F.lit("N3")).alias("level"),
        F.when(F.col("_g") == 1, F.lit(1)).otherwise(F.col("state")).alias("locality_id"),
        F.round("total", 2).alias("value"),
    )


def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cents ordered per customer and year."""
    return _cents(table(spark, sf_dir, "orders")).groupBy(
        F.col("o_custkey").alias("c"), F.year("o_orderdate").cast("string").alias("period")).agg(F.sum("cents").alias("cents"))


def _cents(orders: DataFrame) -> DataFrame:
    return orders.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))


def _facts(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(FACT_TABLE_ID).alias("table_id"), "period", F.lit(FACT_VARIABLE_ID).alias("variable_id"), F.lit("N6").alias("level"),
                       F.col("locality").cast("int").alias("locality_id"), F.col("cents").cast("double").alias("value"))


def customer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series with gaps: what each customer (a locality, N6) ordered per year, in cents."""
    return _facts(_yearly(spark, sf_dir).withColumn("locality", F.col("c") + 1))


def municipality_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of each order, in cents, as a fact of its municipality (N6) and year."""
    rows = _cents(table(spark, sf_dir, "orders"))
    return _facts(rows.select((F.col("o_orderkey") + 1).alias("locality"), F.year("o_orderdate").cast("string").alias("period"), "cents"))


def payload_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer of the statistical service per customer, as a line of JSON: the customer's yearly series.

    On every n-th customer something is wrong: a line is cut off, lacks its
    results or its locality, or has values that are no numbers.
    """
    def hit(fault: str) -> Column:
        return F.col("c_custkey") % PAYLOAD_FAULTS[fault] == 0

    years = _yearly(spark, sf_dir).groupBy("c").agg(F.sort_array(F.collect_list(F.struct("period", "cents"))).alias("years"))  # a few years each
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(years, F.col("c") == F.col("c_custkey"), "left")
    text = F.when(hit("no_number"), F.lit("...")).otherwise(F.lit(None))
    serie = F.map_from_entries(F.transform(F.coalesce("years", F.array().cast("array<struct<period: string, cents: bigint>>")),
                                           lambda y: F.struct(y.period, F.coalesce(text, y.cents.cast("string")))))
    place = F.struct((F.col("c_custkey") + 1).cast("string").alias("id"), F.struct(F.lit("N6").alias("id"), F.lit("Município").alias("nome")).alias("nivel"),
                     F.col("c_name").alias("nome"))
    one = F.struct(F.when(~hit("no_locality") | hit("cut"), place).alias("localidade"), serie.alias("serie"))
    result = F.struct(F.array().cast("array<string>").alias("classificacoes"), F.array(one).alias("series"))
    answer = F.struct(F.lit(str(FACT_VARIABLE_ID)).alias("id"), F.lit("Pedidos").alias("variavel"), F.lit("Centavos").alias("unidade"),
                      F.when(~hit("no_results") | hit("cut"), F.array(result)).alias("resultados"))
    line = F.to_json(F.array(answer))
    return rows.withColumn("line", line).select(
        F.when(hit("cut"), F.expr("substring(line, 1, length(line) - 5)")).otherwise(F.col("line")).alias("value"))


def event_files(spark: SparkSession, sf_dir: str, files: int = 3) -> list[DataFrame]:
    """The events as ``files`` deliveries by time: every 7th record twice, and of the last hour of a delivery every
    3rd record (and every 7th's copy) only with the next one."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step, hour = (last - first) / files, dt.timedelta(hours=1)
    out = []
    for k in range(files):
        begin, end = first + k * step, first + (k + 1) * step if k < files - 1 else last + step
        own = events.where((F.col("ts") >= F.lit(begin)) & (F.col("ts") < F.lit(end)))
        late = (F.col("ts") >= F.lit(end - hour)) if k < files - 1 else F.lit(False)
        held = events.where((F.col("ts") >= F.lit(begin - hour)) & (F.col("ts") < F.lit(begin))) if k else events.limit(0)
        repeated = F.col("event_id") % 7 == 0
        out.append(own.where(~(late & (F.col("event_id") % 3 == 0)))
                   .unionByName(own.where(repeated & ~late))
                   .unionByName(held.where((F.col("event_id") % 3 == 0) | repeated)))
    return out
