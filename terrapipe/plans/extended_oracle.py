"""DuckDB SQL of the further queries, in the manner of :mod:`terrapipe.plans.oracle`."""

from __future__ import annotations

from terrapipe.plans import catalog as C
from terrapipe.plans import extended as X
from terrapipe.plans import fixtures as fx
from terrapipe.plans import oracle as O
from terrapipe.plans.oracle import MUNIS, with_

PF = fx.PAYLOAD_FAULTS
DAY1, DAY2, DAY3 = C.LOAD_DAY, C.LOAD_TS_DAY2[:10], fx.HISTORY_TS_DAY3[:10]

#: Municipalities with their repetitions, and the same a day later.
REPEATED = with_(O.GRAIN, O.raw_municipalities_cte(False), O.transform_municipalities_cte("m_raw", "m_t", False), """b AS (
  SELECT id, nome, sigla_uf, uf_id FROM m_t)""", """a AS (
  SELECT CASE WHEN id % 17 = 0 THEN -id ELSE id END AS id, CASE WHEN id % 5 = 0 THEN upper(nome) ELSE nome END AS nome,
         CASE WHEN id % 7 <> 0 THEN sigla_uf END AS sigla_uf, uf_id FROM b WHERE id % 13 <> 0)""")


def changes(before: str, after: str) -> str:
    per_key = "SELECT id, count(*) AS n, list_sort(list(nome)) AS nome, list_sort(list(sigla_uf)) AS sigla_uf, list_sort(list(uf_id)) AS uf_id FROM {} GROUP BY id"
    differ = " , ".join(f"CASE WHEN o.{c} IS DISTINCT FROM w.{c} THEN '{c}' END" for c in ("nome", "sigla_uf", "uf_id"))
    return REPEATED + f"""SELECT * FROM (
  SELECT coalesce(o.id, w.id) AS id,
         CASE WHEN o.n IS NULL THEN 'inserted' WHEN w.n IS NULL THEN 'deleted' WHEN concat_ws(',', {differ}) <> '' THEN 'changed' END AS change,
         CASE WHEN o.n IS NULL OR w.n IS NULL THEN '' ELSE concat_ws(',', {differ}) END AS changed,
         coalesce(o.n, 0) AS rows_before, coalesce(w.n, 0) AS rows_after
  FROM ({per_key.format(before)}) o FULL JOIN ({per_key.format(after)}) w ON o.id = w.id) WHERE change IS NOT NULL"""


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
YEARLY = f"""yearly AS (
  SELECT o_custkey AS c, CAST(year(o_orderdate) AS VARCHAR) AS period, CAST(sum({CENTS}) AS BIGINT) AS cents FROM orders GROUP BY ALL)"""
FILLED = """filled AS (
  SELECT s.c, y.p AS year, CAST(v.cents AS DOUBLE) AS value
  FROM (SELECT DISTINCT c FROM yearly) s
  CROSS JOIN (SELECT unnest(range(min(CAST(period AS INT)), max(CAST(period AS INT)) + 1)) AS p FROM yearly) y
  LEFT JOIN yearly v ON v.c = s.c AND CAST(v.period AS INT) = y.p)"""

RANGE = f"CAST(o_orderdate AS DATE) BETWEEN DATE '{X.RANGE[0]}' AND DATE '{X.RANGE[1]}'"
QUANTILES = ", ".join(f"({q})" for q in X.QUANTILES)

HISTORY = f"""days AS (
  SELECT id, nome, sigla_uf, DATE '{DAY1}' AS d FROM m_d
  UNION ALL SELECT id, CASE WHEN id % 5 = 0 THEN upper(nome) ELSE nome END, sigla_uf, DATE '{DAY2}' FROM m_d WHERE id % 7 <> 0
  UNION ALL SELECT id, CASE WHEN id % 5 = 0 THEN upper(nome) ELSE nome END, CASE WHEN id % 3 <> 0 THEN sigla_uf END, DATE '{DAY3}' FROM m_d),
marked AS (
  SELECT *, (lag(d) OVER k IS DISTINCT FROM d - 1 OR lag(nome) OVER k IS DISTINCT FROM nome OR lag(sigla_uf) OVER k IS DISTINCT FROM sigla_uf) AS fresh
  FROM days WINDOW k AS (PARTITION BY id ORDER BY d)),
numbered AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY id ORDER BY d) AS v FROM marked),
history AS (
  SELECT id, min(nome) AS nome, min(sigla_uf) AS sigla_uf, min(d) AS valid_from,
         CASE WHEN max(d) < DATE '{DAY3}' THEN CAST(max(d) + 1 AS DATE) END AS valid_to FROM numbered GROUP BY id, v)"""

PLACES = ", ".join(f"({k}, '{level}', {column})" for k, (level, column) in enumerate(
    [("N6", "id"), ("N9", "microrregiao_id"), ("N8", "mesorregiao_id"), ("N3", "uf_id"), ("N2", "regiao_id"), ("N1", "1")]))

BELOW = f"""SELECT CAST({C.SLICE_YEAR} AS VARCHAR) AS period, {{unit}} AS locality_id, CAST(sum({CENTS}) AS DOUBLE) AS value,
  count(DISTINCT id) AS localities FROM orders JOIN m_d ON id = o_orderkey + 1 WHERE year(o_orderdate) = {C.SLICE_YEAR} {{only}} GROUP BY {{unit}}"""

ACCENTED = "[" + ", ".join(f"'{a}'" for a in X.ACCENTED) + "]"

FAULTY = f"""faulty AS (
  SELECT *, c_custkey + 1 AS locality, CASE WHEN c_custkey % {PF['cut']} = 0 THEN 'not JSON' WHEN c_custkey % {PF['no_results']} = 0 THEN 'no resultados'
    WHEN c_custkey % {PF['no_locality']} = 0 THEN 'no localidade' WHEN period IS NULL THEN 'no serie'
    WHEN c_custkey % {PF['no_number']} = 0 THEN 'no number' END AS fault
  FROM customer LEFT JOIN yearly ON c = c_custkey)"""

ORACLE_SQL: dict[str, str] = {
    "switch_day": O.ORACLE_SQL["replace_day"],
    "day_changes": changes("b", "a"),
    "day_changes_empty": changes("b", "(SELECT * FROM b LIMIT 0)"),
    "landing_dupes_bucketed": REPEATED + f"""SELECT id, DATE '{DAY1}' AS load_date, count(*) AS count FROM b GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, DATE '{DAY2}', count(*) FROM a GROUP BY id HAVING count(*) > 1""",
    "day_changes_bucketed": REPEATED + """SELECT coalesce(o.id, w.id) AS id, rows_1, nome_1, rows_2, nome_2
FROM (SELECT id, count(*) AS rows_1, max(nome) AS nome_1 FROM b GROUP BY id) o
FULL JOIN (SELECT id, count(*) AS rows_2, max(nome) AS nome_2 FROM a GROUP BY id) w ON o.id = w.id
WHERE nome_1 IS DISTINCT FROM nome_2""",
    "agg_payload": with_(YEARLY, FAULTY) + f"""SELECT CAST(locality AS INTEGER) AS locality_id,
  CASE WHEN fault IS NULL THEN CAST(cents AS DOUBLE) END AS value, {fx.FACT_TABLE_ID} AS table_id, {fx.FACT_VARIABLE_ID} AS variable_id,
  'N6' AS level, period, 'Centavos' AS unit, CASE WHEN fault IS NULL THEN CAST(cents AS VARCHAR) ELSE '...' END AS "text"
FROM faulty WHERE fault IS NULL OR fault = 'no number'""",
    "agg_payload_faults": with_(YEARLY, FAULTY) + """SELECT CASE WHEN fault IN ('no resultados', 'no localidade') THEN ''
  ELSE CAST(locality AS VARCHAR) END AS locality, fault FROM faulty WHERE fault IS NOT NULL
QUALIFY fault = 'no number' OR row_number() OVER (PARTITION BY c_custkey) = 1""",
    "sketch_quantiles": f"SELECT CAST(q AS DOUBLE) AS quantile, count(*) AS n, TRUE AS within FROM orders, (VALUES {QUANTILES}) v(q) WHERE {RANGE} GROUP BY q",
    "sketch_distinct": f"SELECT count(DISTINCT o_custkey) AS customers, TRUE AS within FROM orders WHERE {RANGE}",
    "sketch_top": f"""SELECT o_orderpriority AS value, count(*) AS count FROM orders WHERE {RANGE}
GROUP BY o_orderpriority ORDER BY count DESC LIMIT 3""",
    "ancestry": MUNIS + f"""SELECT m_d.id AS start_id, u.level, CAST(u.id AS INTEGER) AS id, CAST(u.steps AS INTEGER) AS steps
FROM m_d, LATERAL (VALUES {PLACES}) u(steps, level, id)""",
    "hierarchy_faults": MUNIS + """SELECT 'N6' AS level, id, 'repeated' AS fault FROM m_d WHERE id % 11 = 0
UNION ALL SELECT 'N6', id, 'orphan' FROM m_d WHERE id % 13 = 0
UNION ALL SELECT level, 2, 'cycle' FROM (VALUES ('N2'), ('N3')) v(level) WHERE EXISTS (SELECT 1 FROM m_d WHERE uf_id = 2 AND regiao_id = 2)""",
    "agg_below": MUNIS + BELOW.format(unit="uf_id", only=""),
    "agg_below_one": MUNIS + BELOW.format(unit="regiao_id", only="AND regiao_id = 2"),
    "dim_history": MUNIS[:-1] + ",\n" + HISTORY + "\nSELECT * FROM history",
    "dim_as_of": MUNIS[:-1] + ",\n" + HISTORY + f""",
facts AS (SELECT o_orderkey, CAST(o_orderkey - o_orderkey % 4 + 1 AS INTEGER) AS id,
  CAST(DATE '{DAY1}' + CAST(o_custkey % 5 - 1 AS INTEGER) AS DATE) AS day FROM orders)
SELECT f.*, h.nome, h.sigla_uf, h.valid_from FROM facts f
LEFT JOIN history h ON h.id = f.id AND f.day >= h.valid_from AND (h.valid_to IS NULL OR f.day < h.valid_to)""",
    "list_collated": f"""WITH n AS (SELECT CAST(c_custkey AS INTEGER) AS id,
  {ACCENTED}[c_custkey % {len(X.ACCENTED)} + 1] || ' ' || CAST(c_custkey % 41 AS VARCHAR) AS nome FROM customer)
SELECT id, nome, row_number() OVER (ORDER BY nome COLLATE {X.COLLATION}, nome, id) AS place FROM n""",
    "agg_gaps": with_(YEARLY, FILLED) + """SELECT CAST(c + 1 AS INTEGER) AS locality_id, CAST(year AS VARCHAR) AS period, value, value IS NULL AS missing,
  last_value(value IGNORE NULLS) OVER upto AS known, CAST(last_value(CASE WHEN value IS NOT NULL THEN year END IGNORE NULLS) OVER upto AS VARCHAR) AS known_since,
  last_value(value IGNORE NULLS) OVER before AS previous, value - last_value(value IGNORE NULLS) OVER before AS change
FROM filled WINDOW upto AS (PARTITION BY c ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  before AS (PARTITION BY c ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "agg_missing": with_(YEARLY, FILLED) + """SELECT CAST(c + 1 AS INTEGER) AS locality_id, CAST(min(year) AS VARCHAR) AS "first",
  CAST(max(year) AS VARCHAR) AS "last", count(*) AS periods
FROM (SELECT c, year, year - row_number() OVER (PARTITION BY c ORDER BY year) AS run FROM filled WHERE value IS NULL) GROUP BY c, run""",
    "preferred_scan": MUNIS + "SELECT id, sigla_uf, regiao_nome FROM m_d",
    "daily_stream": MUNIS + f"SELECT id, nome, sigla_uf AS code, {O.LOADED} FROM m_d",
    "events_stream": """SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, min(value) AS least, max(value) AS greatest,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL
HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
}
