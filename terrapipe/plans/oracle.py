"""DuckDB SQL oracles for the query catalogue.

Independent re-statements of each query in plain SQL over the driver's
tables (pre-registered as views): the raw batches are rebuilt with
``struct_pack``, de-duplication is ``QUALIFY row_number()`` instead of
Spark's ``min(struct)``, title case is a word-wise list transform (DuckDB
has no ``initcap``). Column names and types match the Spark results.
"""

from __future__ import annotations

from terrapipe.plans import catalog as C
from terrapipe.plans import fixtures as fx
from terrapipe.schemas import MUNICIPALITY_COLUMNS, MUNICIPALITY_LIMITS, STATE_COLUMNS, UF_CODES

CODES = "[" + ", ".join(f"'{c}'" for c in UF_CODES) + "]"
CODE_SET = "(" + ", ".join(f"'{c}'" for c in UF_CODES) + ")"
MF, SF = fx.MUNICIPALITY_FAULTS, fx.STATE_FAULTS


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            f"lambda w: concat(upper(w[1]), w[2:])), ' ')")


def code(x: str) -> str:
    return f"upper(trim({x}))"


GRAIN = """grain AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_orderstatus,
         c.c_name, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

REGION = ("struct_pack(id := CAST(r_regionkey + 1 AS BIGINT), sigla := lower(substr(r_name, 1, 2)), "
          "nome := lower(r_name) || ' ')")


def raw_states_cte(faults: bool, name: str = "s_raw") -> str:
    sid = "CAST(n_nationkey + 1 AS BIGINT)"
    sig = f"' ' || lower({CODES}[n_nationkey + 1])"
    nom = f"' ' || lower(n_name) || CASE WHEN o_orderkey % {fx.STATE_RENAMED} = 0 THEN ' do sul' ELSE '' END"
    if faults:
        sid = f"CASE WHEN o_orderkey % {SF['zero_id']} = 0 THEN CAST(0 AS BIGINT) ELSE {sid} END"
        sig = f"CASE WHEN o_orderkey % {SF['empty_code']} = 0 THEN '' ELSE {sig} END"
        nom = f"CASE WHEN o_orderkey % {SF['null_name']} = 0 THEN NULL ELSE {nom} END"
    return f"""{name} AS (
  SELECT {sid} AS id, {sig} AS sigla, {nom} AS nome, {REGION} AS regiao FROM grain)"""


def raw_municipalities_cte(faults: bool, name: str = "m_raw", intermediate: bool = False) -> str:
    mid = "o_orderkey + 1"
    suffix = "lower(CASE WHEN copy = 2 THEN o_orderstatus ELSE o_orderpriority END)"
    nom = f"'  ' || lower(c_name) || ' ' || {suffix}"
    uf_code = f"lower({CODES}[n_nationkey + 1])"
    micro_null = "FALSE"
    inter = (""",
    struct_pack(id := inter_id, nome := 'intermediaria ' || CAST(inter_id AS VARCHAR)) AS "regiao-intermediaria\"""" if intermediate else "")
    if faults:
        mid = f"CASE WHEN o_orderkey % {MF['zero_id']} = 0 THEN 0 ELSE {mid} END"
        nom = (f"CASE WHEN o_orderkey % {MF['blank_name']} = 0 THEN '  ' "
               f"WHEN o_orderkey % {MF['long_name']} = 0 THEN repeat({nom}, 10) ELSE {nom} END")
        uf_code = f"CASE WHEN o_orderkey % {MF['empty_uf_code']} = 0 THEN '' ELSE {uf_code} END"
        micro_null = f"o_orderkey % {MF['null_micro']} = 0"
    return f"""{name}_copies AS (
  SELECT *, 0 AS copy FROM grain
  UNION ALL SELECT *, 1 AS copy FROM grain WHERE (o_orderkey + 1) % {fx.COPY_SAME} = 0
  UNION ALL SELECT *, 2 AS copy FROM grain WHERE (o_orderkey + 1) % {fx.COPY_RENAMED} = 0),
{name}_leaf AS (
  SELECT CAST({mid} AS BIGINT) AS id, {nom} AS nome, {micro_null} AS micro_null,
         CAST(n_nationkey + 1 AS BIGINT) AS uf_id, {uf_code} AS uf_sigla, ' ' || lower(n_name) AS uf_nome,
         (n_nationkey + 1) * 10 + o_custkey % 5 AS meso_id,
         ((n_nationkey + 1) * 10 + o_custkey % 5) * 10 + o_custkey % 3 AS micro_id,
         CAST((n_nationkey + 1) * 100 + o_custkey % 7 AS BIGINT) AS imm_id,
         CAST((n_nationkey + 1) * 1000 + o_custkey % 4 AS BIGINT) AS inter_id,
         r_regionkey, r_name
  FROM {name}_copies),
{name} AS (
  SELECT id, nome,
    CASE WHEN micro_null THEN NULL ELSE struct_pack(
      id := CAST(micro_id AS BIGINT), nome := 'micro ' || CAST(micro_id AS VARCHAR),
      mesorregiao := struct_pack(
        id := CAST(meso_id AS BIGINT), nome := 'meso ' || CAST(meso_id AS VARCHAR),
        UF := struct_pack(id := uf_id, sigla := uf_sigla, nome := uf_nome, regiao := {REGION})))
    END AS microrregiao,
    struct_pack(id := imm_id, nome := ' imediata ' || CAST(imm_id AS VARCHAR)) AS "regiao-imediata"{inter}
  FROM {name}_leaf)"""


def transform_states_cte(src: str, name: str, dedup: bool) -> str:
    body = f"""SELECT TRY_CAST(id AS INTEGER) AS id, {code('sigla')} AS sigla, {initcap('nome')} AS nome,
         TRY_CAST(regiao.id AS INTEGER) AS regiao_id, {code('regiao.sigla')} AS regiao_sigla,
         {initcap('regiao.nome')} AS regiao_nome
  FROM {src}"""
    if dedup:
        order = ", ".join(f"{c} NULLS FIRST" for c in STATE_COLUMNS[1:])
        body += f"\n  QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1"
    return f"{name} AS (\n  {body})"


def transform_municipalities_cte(src: str, name: str, dedup: bool, intermediate: bool = False) -> str:
    inter_id, inter_nome = "CAST(NULL AS INTEGER)", "CAST(NULL AS VARCHAR)"
    if intermediate:
        inter_id, inter_nome = 'TRY_CAST("regiao-intermediaria".id AS INTEGER)', initcap('"regiao-intermediaria".nome')
    uf = "microrregiao.mesorregiao.UF"
    body = f"""SELECT TRY_CAST(id AS INTEGER) AS id, {initcap('nome')} AS nome,
         {code(uf + '.sigla')} AS sigla_uf, TRY_CAST({uf}.id AS INTEGER) AS uf_id,
         {initcap(uf + '.nome')} AS uf_nome,
         TRY_CAST({uf}.regiao.id AS INTEGER) AS regiao_id, {code(uf + '.regiao.sigla')} AS regiao_sigla,
         {initcap(uf + '.regiao.nome')} AS regiao_nome,
         TRY_CAST(microrregiao.mesorregiao.id AS INTEGER) AS mesorregiao_id,
         {initcap('microrregiao.mesorregiao.nome')} AS mesorregiao_nome,
         TRY_CAST(microrregiao.id AS INTEGER) AS microrregiao_id,
         {initcap('microrregiao.nome')} AS microrregiao_nome,
         TRY_CAST("regiao-imediata".id AS INTEGER) AS regiao_imediata_id,
         {initcap('"regiao-imediata".nome')} AS regiao_imediata_nome,
         {inter_id} AS regiao_intermediaria_id,
         {inter_nome} AS regiao_intermediaria_nome
  FROM {src}"""
    if dedup:
        order = ", ".join(f"{c} NULLS FIRST" for c in MUNICIPALITY_COLUMNS[1:])
        body += f"\n  QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1"
    return f"{name} AS (\n  {body})"


FACTS = f"""fact_rows AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS period, CAST(c_nationkey + 1 AS INTEGER) AS state, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey),
facts AS (
  SELECT {fx.FACT_TABLE_ID} AS table_id, period, {fx.FACT_VARIABLE_ID} AS variable_id, 'N3' AS level,
         state AS locality_id, round(sum(o_totalprice), 2) AS value
  FROM fact_rows GROUP BY period, state
  UNION ALL
  SELECT {fx.FACT_TABLE_ID}, period, {fx.FACT_VARIABLE_ID}, 'N1', 1, round(sum(o_totalprice), 2)
  FROM fact_rows GROUP BY period)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STATES = with_(GRAIN, raw_states_cte(False), transform_states_cte("s_raw", "s_d", True))
MUNIS = with_(GRAIN, raw_municipalities_cte(False), transform_municipalities_cte("m_raw", "m_d", True))
BOTH = with_(GRAIN, raw_states_cte(False), transform_states_cte("s_raw", "s_d", True),
             raw_municipalities_cte(False), transform_municipalities_cte("m_raw", "m_d", True))
RAW_M = with_(GRAIN, raw_municipalities_cte(False))
RAW_S = with_(GRAIN, raw_states_cte(False))
FAULT_S = with_(GRAIN, raw_states_cte(True, "s_raw"))
FAULT_M = with_(GRAIN, raw_municipalities_cte(True, "m_raw"))
FAULT_ST = with_(GRAIN, raw_states_cte(True, "s_raw"), transform_states_cte("s_raw", "s_t", False))
FAULT_MT = with_(GRAIN, raw_municipalities_cte(True, "m_raw"),
                 transform_municipalities_cte("m_raw", "m_t", False))


INTERMEDIATE = with_(GRAIN, raw_municipalities_cte(False, intermediate=True),
                     transform_municipalities_cte("m_raw", "m_d", True, intermediate=True))


def json_row(columns, chars: int | None = None) -> str:
    fields = ", ".join(f'"{c}" := "{c}"' for c in columns)
    row = f"CAST(to_json(struct_pack({fields})) AS VARCHAR)"
    return row if chars is None else f"substr({row}, 1, {chars})"


def row_rule(rule: str, column: str, bad: str, example: str | None = None) -> str:
    ex = f"min(CASE WHEN {bad} THEN {example} END)" if example else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{rule}' AS rule, '{column}' AS \"column\", CAST(count_if({bad}) AS BIGINT) AS bad_rows, "
            f"CAST(count(*) AS BIGINT) AS total_rows, {ex} AS example")


def non_empty_rule() -> str:
    return ("SELECT 'non_empty' AS rule, '*' AS \"column\", CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) "
            "AS bad_rows, CAST(count(*) AS BIGINT) AS total_rows, CAST(NULL AS VARCHAR) AS example")


def unique_rule(column: str) -> str:
    return f"""SELECT 'unique' AS rule, '{column}' AS "column",
  CAST(coalesce(sum(CASE WHEN k IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT) AS bad_rows,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows,
  CAST(min(CASE WHEN k IS NOT NULL AND n > 1 THEN k END) AS VARCHAR) AS example
FROM (SELECT {column} AS k, count(*) AS n FROM {{src}} GROUP BY {column})"""


def truthy(cols: list[tuple[str, str]]) -> str:
    conds = " AND ".join(
        f"{c} IS NOT NULL AND {c} <> {'0' if kind == 'num' else chr(39) * 2}" for c, kind in cols)
    return f"NOT coalesce({conds}, FALSE)"


RAW_S_TRUTHY = truthy([("id", "num"), ("sigla", "str"), ("nome", "str")])
RAW_M_TRUTHY = truthy([("id", "num"), ("nome", "str"), ("microrregiao.mesorregiao.UF.sigla", "str")])
RAW_M_COLUMNS = ["id", "nome", "microrregiao", "regiao-imediata"]


def positive(c): return f"coalesce({c} <= 0, FALSE)"
def not_null(c): return f"{c} IS NULL"
def length(c, lo, hi): return f"coalesce(NOT (length({c}) BETWEEN {lo} AND {hi}), FALSE)"
def max_len(c, n): return f"coalesce(length({c}) > {n}, FALSE)"
def in_codes(c): return f"coalesce(NOT ({c} IN {CODE_SET}), FALSE)"


def _contract_states() -> list[str]:
    return [row_rule("not_null", "id", not_null("id")), row_rule("gt_0", "id", positive("id")),
            row_rule("not_null", "sigla", not_null("sigla")),
            row_rule("length_2_2", "sigla", length("sigla", 2, 2)),
            row_rule("not_null", "nome", not_null("nome")),
            unique_rule("id"), unique_rule("sigla")]


def _contract_municipalities() -> list[str]:
    return [row_rule("not_null", "id", not_null("id")), row_rule("gt_0", "id", positive("id")),
            row_rule("not_null", "nome", not_null("nome")),
            row_rule("not_null", "sigla_uf", not_null("sigla_uf")),
            row_rule("isin", "sigla_uf", in_codes("sigla_uf")),
            unique_rule("id")]


SLICE = f"FROM facts WHERE table_id = {fx.FACT_TABLE_ID} AND variable_id = {fx.FACT_VARIABLE_ID}"
LOADED = f"DATE '{C.LOAD_DAY}' AS load_date, '{C.LOAD_TS}' AS loaded_at"
LANDED = f"""SELECT 'states' AS dataset, id, nome, sigla AS code, {LOADED} FROM s_d
UNION ALL SELECT 'municipalities', id, nome, sigla_uf, {LOADED} FROM m_d"""


def dim(head: str, key: str, *attributes: str) -> str:
    order = ", ".join(f"{a} NULLS FIRST" for a in attributes)
    return head + f"""SELECT {key}, {", ".join(attributes)} FROM m_d WHERE {key} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


TOP = ("SELECT sigla_uf, count(*) AS count FROM m_d WHERE sigla_uf IS NOT NULL "
       "GROUP BY sigla_uf ORDER BY count DESC, sigla_uf LIMIT 10")
M_COLS = list(MUNICIPALITY_COLUMNS)

ORACLE_SQL: dict[str, str] = {
    "transform_states": STATES + "SELECT * FROM s_d",
    "transform_municipalities": MUNIS + "SELECT * FROM m_d",
    "top_states": MUNIS + TOP,
    "describe_top": MUNIS + f"""SELECT count(*) AS count, round(avg(count), 6) AS mean,
  round(stddev_samp(count), 6) AS std, min(count) AS min,
  round(quantile_cont(count, 0.25), 6) AS p25, round(quantile_cont(count, 0.5), 6) AS p50,
  round(quantile_cont(count, 0.75), 6) AS p75, max(count) AS max
FROM ({TOP})""",
    "freq_region": MUNIS + "SELECT regiao_nome, count(*) AS count FROM m_d WHERE regiao_nome IS NOT NULL GROUP BY regiao_nome",
    "share_region": MUNIS + """SELECT regiao_nome, count,
  round(CAST(count AS DOUBLE) * 100.0 / CAST(sum(count) OVER () AS DOUBLE), 1) AS pct
FROM (SELECT regiao_nome, count(*) AS count FROM m_d WHERE regiao_nome IS NOT NULL GROUP BY regiao_nome)""",
    "summary": BOTH + """SELECT (SELECT count(*) FROM s_d) AS states, count(*) AS municipalities,
  count(DISTINCT sigla_uf) AS states_with_municipalities FROM m_d""",
    "dim_regions": MUNIS + """SELECT regiao_id, regiao_sigla, regiao_nome FROM m_d WHERE regiao_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY regiao_id ORDER BY regiao_sigla NULLS FIRST, regiao_nome NULLS FIRST) = 1""",
    "dim_states": MUNIS + """SELECT uf_id, sigla_uf, uf_nome, regiao_id FROM m_d WHERE uf_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY uf_id
  ORDER BY sigla_uf NULLS FIRST, uf_nome NULLS FIRST, regiao_id NULLS FIRST) = 1""",
    "dim_microregions": MUNIS + """SELECT microrregiao_id, microrregiao_nome, mesorregiao_id FROM m_d
WHERE microrregiao_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY microrregiao_id
  ORDER BY microrregiao_nome NULLS FIRST, mesorregiao_id NULLS FIRST) = 1""",
    "distinct_states": MUNIS + "SELECT count(DISTINCT sigla_uf) AS states_with_municipalities FROM m_d",
    "list_states": STATES + "SELECT id, sigla, nome FROM s_d",
    "list_by_state_id": MUNIS + f"SELECT id, nome FROM m_d WHERE uf_id = {C.LIST_STATE_ID}",
    "list_by_state_code": MUNIS + f"SELECT id, nome FROM m_d WHERE sigla_uf = '{C.LIST_STATE_CODE.upper()}'",
    "agg_slice_all": with_(FACTS) + f"SELECT period, locality_id, value {SLICE} AND level = 'N3' AND period = '{C.SLICE_YEAR}'",
    "agg_slice_one": with_(FACTS) + f"""SELECT period, locality_id, value {SLICE} AND level = 'N3'
  AND locality_id = {C.SLICE_STATE} AND period = '{C.SLICE_YEAR}'""",
    "agg_slice_last": with_(FACTS) + f"""SELECT period, locality_id, value {SLICE} AND level = 'N1'
  AND period = (SELECT max(period) {SLICE} AND level = 'N1')""",
    "preview": STATES + "SELECT * FROM s_d ORDER BY id LIMIT 10",
    "parquet_scan": "SELECT * FROM supplier",
    "parquet_roundtrip": STATES + "SELECT * FROM s_d",
    "csv_scan": "SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey) FROM customer",
    "csv_roundtrip": MUNIS + "SELECT *, CAST(NULL AS VARCHAR) AS corrupt FROM m_d",
    "csv_misfits": """SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS key, c_name AS name,
  CASE WHEN c_custkey % 7 = 0 THEN 'no ' || c_custkey || ';' || c_name
       WHEN c_custkey % 11 = 0 THEN c_custkey || ';' || c_name || ';surplus' END AS corrupt FROM customer""",
    "dim_mesoregions": dim(MUNIS, "mesorregiao_id", "mesorregiao_nome", "uf_id"),
    "dim_immediate": dim(INTERMEDIATE, "regiao_imediata_id", "regiao_imediata_nome", "uf_id"),
    "dim_intermediate": dim(INTERMEDIATE, "regiao_intermediaria_id", "regiao_intermediaria_nome", "uf_id"),
    "list_all_municipalities": MUNIS + "SELECT id, nome, sigla_uf FROM m_d",
    "agg_slice_last_one": with_(FACTS) + f"""SELECT period, locality_id, value {SLICE} AND level = 'N3' AND locality_id = {C.SLICE_STATE}
  AND period = (SELECT max(period) {SLICE} AND level = 'N3' AND locality_id = {C.SLICE_STATE})""",
    "landing_ddl": STATES + f"SELECT *, {LOADED} FROM s_d",
    "reject_keeps_day": MUNIS + f"SELECT id, nome, sigla_uf, '{C.LOAD_TS}' AS loaded_at, TRUE AS refused FROM m_d",
    "unregistered_load": FAULT_MT + f"SELECT id, nome, sigla_uf, DATE '{C.LOAD_DAY}' AS load_date FROM m_t",
    "column_contract": MUNIS + """SELECT v.*, (SELECT count(*) FROM m_d) AS "rows"
FROM (VALUES ('id', 'int', 'string'), ('sigla_uf', 'str', NULL)) v("column", expected, found)""",
    "ingest_land": RAW_S + """SELECT id, sigla, nome, regiao.id AS "regiao.id", regiao.sigla AS "regiao.sigla",
  regiao.nome AS "regiao.nome" FROM s_raw""",
    "ingest_rejected": FAULT_S + f"""SELECT dataset, single_pass,
  (SELECT count(*) FROM s_raw WHERE {RAW_S_TRUTHY}) > 0 AS refused, CAST(0 AS BIGINT) AS files_left
FROM (VALUES ('states'), ('municipalities')) d(dataset), (VALUES (FALSE), (TRUE)) p(single_pass)""",
    "transform_stage": STATES + "SELECT * FROM s_d",
    "optional_dataset": STATES + """SELECT 'states' AS dataset, FALSE AS skipped, count(*) AS "rows" FROM s_d
UNION ALL SELECT 'municipalities', TRUE, 0""",
    "order_proof": MUNIS + "SELECT id, nome, row_number() OVER (ORDER BY nome NULLS FIRST, id NULLS FIRST) AS place FROM m_d",
    "json_scan": RAW_M + """SELECT id, nome, microrregiao.id AS microrregiao_id,
  microrregiao.mesorregiao.UF.sigla AS uf_sigla, microrregiao.mesorregiao.UF.regiao.nome AS regiao_nome,
  "regiao-imediata".id AS imediata_id, CAST(NULL AS BIGINT) AS intermediaria_id,
  CAST(NULL AS VARCHAR) AS corrupt FROM m_raw""",
    "json_roundtrip": RAW_S + """SELECT id, sigla, nome, regiao.id AS "regiao.id", regiao.sigla AS "regiao.sigla",
  regiao.nome AS "regiao.nome" FROM s_raw""",
    "fallback_scan": RAW_M + """SELECT id, microrregiao.mesorregiao.UF.sigla AS sigla_uf,
  microrregiao.mesorregiao.UF.regiao.nome AS regiao_nome FROM m_raw""",
    "stamp_day": MUNIS + f"SELECT id, nome, {LOADED} FROM m_d",
    "replace_day": MUNIS + f"""SELECT id, nome, sigla_uf, DATE '{C.LOAD_DAY}' AS load_date FROM m_d
UNION ALL
SELECT id, upper(nome) AS nome, sigla_uf, DATE '2024-01-02' AS load_date FROM m_d WHERE sigla_uf <> '{C.CHANGED_STATE}'""",
    "landing_dupes": with_(GRAIN, raw_municipalities_cte(False), transform_municipalities_cte("m_raw", "m_t", False))
    + f"""SELECT id, DATE '{C.LOAD_DAY}' AS load_date, count(*) AS count FROM m_t GROUP BY id HAVING count(*) > 1""",
    "load_counts": BOTH + LANDED,
    "daily_run": BOTH + LANDED,
    "cast_ids": """SELECT c_custkey, TRY_CAST(substr(c_name, 10, 20) AS INTEGER) AS from_name,
  TRY_CAST(' ' || CAST(c_custkey AS VARCHAR) || ' ' AS INTEGER) AS padded,
  TRY_CAST(c_mktsegment AS INTEGER) AS from_text,
  TRY_CAST(CAST(c_custkey AS VARCHAR) || '0000000' AS INTEGER) AS wide FROM customer""",
    "normalize_names": f"""SELECT p_partkey, {initcap("'  ' || upper(p_name) || ' '")} AS p_name_clean,
  {initcap("' ' || p_type")} AS p_type_clean FROM part""",
    "normalize_codes": f"SELECT c_custkey, {code(chr(39) + ' ' + chr(39) + ' || lower(c_mktsegment) || ' + chr(39) + '  ' + chr(39))} AS segment_code FROM customer",
    "nested_extract": RAW_M + """SELECT id, microrregiao.id AS microrregiao_id,
  microrregiao.mesorregiao.id AS mesorregiao_id, microrregiao.mesorregiao.UF.id AS uf_id,
  microrregiao.mesorregiao.UF.sigla AS uf_sigla, microrregiao.mesorregiao.UF.regiao.sigla AS regiao_sigla,
  microrregiao.mesorregiao.UF.regiao.nome AS regiao_nome FROM m_raw""",
    "optional_nested": RAW_M + """SELECT id, TRY_CAST("regiao-imediata".id AS INTEGER) AS imediata_id,
  "regiao-imediata".nome AS imediata_nome, CAST(NULL AS INTEGER) AS intermediaria_id,
  CAST(NULL AS VARCHAR) AS intermediaria_nome FROM m_raw""",
    "flatten_struct": RAW_M + """SELECT id, nome,
  microrregiao.id AS "microrregiao.id", microrregiao.nome AS "microrregiao.nome",
  microrregiao.mesorregiao.id AS "microrregiao.mesorregiao.id",
  microrregiao.mesorregiao.nome AS "microrregiao.mesorregiao.nome",
  microrregiao.mesorregiao.UF.id AS "microrregiao.mesorregiao.UF.id",
  microrregiao.mesorregiao.UF.sigla AS "microrregiao.mesorregiao.UF.sigla",
  microrregiao.mesorregiao.UF.nome AS "microrregiao.mesorregiao.UF.nome",
  microrregiao.mesorregiao.UF.regiao.id AS "microrregiao.mesorregiao.UF.regiao.id",
  microrregiao.mesorregiao.UF.regiao.sigla AS "microrregiao.mesorregiao.UF.regiao.sigla",
  microrregiao.mesorregiao.UF.regiao.nome AS "microrregiao.mesorregiao.UF.regiao.nome",
  "regiao-imediata".id AS "regiao-imediata.id", "regiao-imediata".nome AS "regiao-imediata.nome"
FROM m_raw""",
    "first_present": MUNIS + "SELECT id, sigla_uf AS uf FROM m_d",
    "dedup": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST) = 1""",
}


def _union(head: str, src: str, parts: list[str], example: bool) -> str:
    cols = 'rule, "column", bad_rows, total_rows' + (", example" if example else "")
    selects = []
    for p in parts:
        if p.lstrip().startswith("SELECT 'unique'"):
            selects.append(f"SELECT {cols} FROM ({p.format(src=src)})")
        else:
            selects.append(f"SELECT {cols} FROM ({p} FROM {src})")
    return head + "\nUNION ALL\n".join(selects)


ORACLE_SQL.update({
    "gate1_states": _union(FAULT_S, "s_raw", [non_empty_rule(), row_rule("truthy", "id,sigla,nome", RAW_S_TRUTHY)], False),
    "gate1_municipalities": _union(FAULT_M, "m_raw", [
        non_empty_rule(),
        row_rule("truthy", "id,nome,microrregiao.mesorregiao.UF.sigla", RAW_M_TRUTHY)], False),
    "gate_report": _union(FAULT_M, "m_raw", [
        row_rule("truthy", "id,nome,microrregiao.mesorregiao.UF.sigla", RAW_M_TRUTHY, json_row(RAW_M_COLUMNS, 200))], True),
    "gate_report_states": _union(FAULT_S, "s_raw", [
        row_rule("truthy", "id,sigla,nome", RAW_S_TRUTHY, json_row(["id", "sigla", "nome", "regiao"]))], True),
    "dq_positive": _union(FAULT_MT, "m_t", [row_rule("gt_0", "id", positive("id"), json_row(M_COLS))], True),
    "dq_unique": _union(FAULT_MT, "m_t", [unique_rule("id")], True),
    "dq_not_null": _union(FAULT_MT, "m_t", [row_rule("not_null", "sigla_uf", not_null("sigla_uf"))], False),
    "dq_length": _union(FAULT_ST, "s_t", [row_rule("length_2_2", "sigla", length("sigla", 2, 2))], False),
    "dq_isin": _union(FAULT_MT, "m_t", [row_rule("isin", "sigla_uf", in_codes("sigla_uf"))], False),
    "dq_max_length": _union(FAULT_MT, "m_t", [row_rule("not_null", "id", not_null("id"))] + [
        row_rule(f"max_length_{n}", c, max_len(c, n)) for c, n in MUNICIPALITY_LIMITS.items()], False),
    "dq_in_table": with_(GRAIN, raw_states_cte(False), transform_states_cte("s_raw", "s_d", True),
                         raw_municipalities_cte(True, "m_raw"), transform_municipalities_cte("m_raw", "m_t", False))
    + """SELECT 'in_table' AS rule, 'sigla_uf' AS "column",
  CAST(count(*) AS BIGINT) AS bad_rows, (SELECT count(*) FROM m_t) AS total_rows,
  CAST(min(sigla_uf) AS VARCHAR) AS example
FROM m_t WHERE sigla_uf IS NOT NULL AND sigla_uf NOT IN (SELECT sigla FROM s_d WHERE sigla IS NOT NULL)""",
    "contract_states": _union(FAULT_ST, "s_t", _contract_states(), False),
    "contract_municipalities": _union(FAULT_MT, "m_t", _contract_municipalities(), False),
})
