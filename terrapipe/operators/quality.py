"""Declarative data-quality gates.

A rule turns into a boolean "this row breaks me" expression. ``check``
compiles all rules of a table, uniqueness rules included, into ONE pass with
map-side combined counts (plus one over the offending rows for the examples)
and returns a small report DataFrame::

    rule string, column string, bad_rows bigint, total_rows bigint, example string

``enforce`` is the eager gate: it fetches that report (one row per rule,
never data rows) and raises ``DataQualityError`` when any rule failed.
Column presence and type (G5) are checked on ``df.schema`` before any job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    IntegralType,
    StringType,
    StructType,
)

from terrapipe.functions.clean import has_path, quote_path, split_path
from terrapipe.schemas import (
    CORRUPT_COLUMN,
    MUNICIPALITY_LIMITS,
    STATE_LIMITS,
    UF_CODES,
)


class DataQualityError(Exception):
    """A batch failed a data-quality gate."""


# Fixed value: a raw municipality, four levels deep, is shown by this much of it.
MUNICIPALITY_EXAMPLE_CHARS = 200


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    bad: Callable[[DataFrame], Column] | None = None  # row rule predicate
    unique: bool = False
    whole_batch: bool = False  # judged on the row count, not per row
    example_chars: int | None = None  # the example's length; None: the whole row


def _c(name: str) -> Column:
    return F.col(quote_path(name))


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda df: _c(column).isNull())


def positive(column: str) -> Rule:
    """Greater than zero; NULL is not judged here."""
    return Rule("gt_0", column, lambda df: F.coalesce(_c(column) <= 0, F.lit(False)))


def length_between(column: str, low: int, high: int) -> Rule:
    return Rule(
        f"length_{low}_{high}", column,
        lambda df: F.coalesce(~F.char_length(_c(column)).between(low, high), F.lit(False)),
    )


def max_length(column: str, limit: int) -> Rule:
    """Length cap; a column the batch does not carry has nothing to cap."""
    def bad(df: DataFrame) -> Column:
        if not has_path(df.schema, column):
            return F.lit(False)
        return F.coalesce(F.char_length(_c(column)) > limit, F.lit(False))
    return Rule(f"max_length_{limit}", column, bad)


def isin(column: str, values: Iterable[str], label: str = "isin") -> Rule:
    domain = list(values)
    return Rule(label, column, lambda df: F.coalesce(~_c(column).isin(domain), F.lit(False)))


def unique(column: str) -> Rule:
    return Rule("unique", column, unique=True)


def non_empty() -> Rule:
    return Rule("non_empty", "*", whole_batch=True)


def _truthy(df: DataFrame, path: str) -> Column:
    """Python truthiness of a raw field: present, not NULL, not 0, not ''."""
    if not has_path(df.schema, path):
        return F.lit(False)
    dtype = _field_type(df.schema, path)
    c = _c(path)
    if isinstance(dtype, StringType):
        return c.isNotNull() & (c != F.lit(""))
    return c.isNotNull() & (c != F.lit(0))


def truthy(*paths: str, example_chars: int | None = None) -> Rule:
    """Every path truthy; NULL anywhere on a path, or a corrupt line, is bad."""
    def bad(df: DataFrame) -> Column:
        ok = reduce(lambda a, b: a & b, [_truthy(df, p) for p in paths])
        if CORRUPT_COLUMN in df.columns:
            ok = ok & F.col(CORRUPT_COLUMN).isNull()
        return ~F.coalesce(ok, F.lit(False))
    return Rule("truthy", ",".join(paths), bad, example_chars=example_chars)


def _field_type(schema: StructType, path: str) -> DataType:
    current: DataType = schema
    for step in split_path(path):
        current = current[step].dataType  # type: ignore[index]
    return current


def _default_example(df: DataFrame) -> Column:
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != CORRUPT_COLUMN])
    text = F.to_json(row, {"ignoreNullFields": "false"})
    if CORRUPT_COLUMN in df.columns:
        text = F.coalesce(F.col(CORRUPT_COLUMN), text)
    return text


def check(df: DataFrame, rules: Sequence[Rule],
          example: Callable[[DataFrame], Column] | None = None,
          with_examples: bool = True) -> DataFrame:
    """Lazy report DataFrame, one row per rule (see module docstring).

    ``with_examples=False`` leaves ``example`` NULL; the aggregate then has
    fixed-width buffers only (counts) and runs as a codegen'd hash aggregate.
    """
    example = example or _default_example
    row_rules = [r for r in rules if not r.unique]
    no_example = F.lit(None).cast("string")

    bads = {i: r.bad(df) for i, r in enumerate(row_rules) if not r.whole_batch}
    uniques = [r for r in rules if r.unique]
    one = _counts(df, list(bads.values()), uniques)
    if with_examples and bads:
        # examples: one scalar subquery over the offending rows only
        offending = df.where(reduce(lambda a, b: a | b, bads.values()))
        shown = {i: example(df) if (n := row_rules[i].example_chars) is None else F.substring(example(df), 1, n) for i in bads}
        examples = offending.agg(F.struct(*[
            F.min(F.when(b, shown[i])).alias(f"_ex{i}") for i, b in bads.items()
        ]).alias("_examples"))
        one = one.select("*", examples.scalar().alias("_examples"))
    position = {i: k for k, i in enumerate(bads)}
    if not rules:
        raise ValueError("no rules given")
    rows = []
    for i, rule in enumerate(row_rules):
        if rule.whole_batch:
            bad_rows = F.when(F.col("_total") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
            ex = no_example
        else:
            bad_rows = F.col(f"_bad{position[i]}")
            ex = F.col("_examples").getField(f"_ex{i}") if with_examples else no_example
        rows.append(_report_row(rule, bad_rows, ex))
    for j, rule in enumerate(uniques):
        rows.append(_report_row(rule, F.col(f"_dup{j}"), F.col(f"_key{j}") if with_examples else no_example))
    return one.select(F.inline(F.array(*rows)))


def _report_row(rule: Rule, bad_rows: Column, example: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"), F.lit(rule.column).alias("column"),
        bad_rows.alias("bad_rows"), F.col("_total").alias("total_rows"), example.alias("example"))


def _counts(df: DataFrame, bads: Sequence[Column], uniques: Sequence[Rule]) -> DataFrame:
    """One row from one pass: ``_total``, ``_bad<i>`` and, per uniqueness rule,
    ``_dup<j>`` and ``_key<j>`` (a repeated key as text).

    Without uniqueness rules a plain aggregate. With them every row is
    exploded into one element for the row rules and one per key; equal
    elements are combined map-side before the only exchange on keys.
    """
    flags = [b.cast("bigint").alias(f"_b{i}") for i, b in enumerate(bads)]
    if not uniques:
        return df.select(*flags, F.lit(1).alias("_one")).agg(
            F.count("_one").alias("_total"),
            *[F.coalesce(F.sum(f"_b{i}"), F.lit(0)).cast("bigint").alias(f"_bad{i}") for i in range(len(bads))])
    keys = [_c(r.column).alias(f"_k{j}") for j, r in enumerate(uniques)]
    flat = df.select(*flags, *keys)
    kinds = [flat.schema[f"_k{j}"].dataType for j in range(len(uniques))]

    def element(which: int) -> Column:
        return F.struct(
            F.lit(which).alias("_r"),
            *[(F.col(f"_b{i}") if which < 0 else F.lit(0).cast("bigint")).alias(f"_b{i}") for i in range(len(bads))],
            *[(F.col(f"_k{j}") if which == j else F.lit(None).cast(kinds[j])).alias(f"_k{j}") for j in range(len(uniques))])

    elements = flat.select(F.inline(F.array(element(-1), *[element(j) for j in range(len(uniques))])))
    grouped = elements.groupBy("_r", *[f"_k{j}" for j in range(len(uniques))]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(len(bads))])

    def repeated(j: int) -> Column:
        return (F.col("_r") == j) & F.col(f"_k{j}").isNotNull() & (F.col("_n") > 1)

    return grouped.agg(
        F.coalesce(F.sum(F.when(F.col("_r") < 0, F.col("_n"))), F.lit(0)).cast("bigint").alias("_total"),
        *[F.coalesce(F.sum(f"_b{i}"), F.lit(0)).cast("bigint").alias(f"_bad{i}") for i in range(len(bads))],
        *[F.coalesce(F.sum(F.when(repeated(j), F.col("_n"))), F.lit(0)).cast("bigint").alias(f"_dup{j}") for j in range(len(uniques))],
        *[F.min(F.when(repeated(j), F.col(f"_k{j}"))).cast("string").alias(f"_key{j}") for j in range(len(uniques))])


def check_in_table(df: DataFrame, column: str, domain: DataFrame, domain_column: str | None = None,
                   label: str = "in_table") -> DataFrame:
    """G10 with the domain given as a table: non-NULL values of ``column``
    missing from ``domain``. Values are counted first (map-side combine), so
    the left-anti join sees one row per distinct value however skewed the
    column is; Spark broadcasts a side only when its statistics say it is
    small. Same report shape as ``check``."""
    values = domain.select(F.col(quote_path(domain_column or column)).alias("_v")).distinct()
    counts = (df.where(_c(column).isNotNull())
                .groupBy(_c(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
    outside = counts.join(values, F.col("_k") == F.col("_v"), "left_anti")
    total = df.select(F.count(F.lit(1))).scalar()
    return outside.agg(
        F.lit(label).alias("rule"), F.lit(column).alias("column"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("bad_rows"), total.alias("total_rows"),
        F.min("_k").cast("string").alias("example"),
    )


def failures(report_rows: Sequence) -> list:
    return [r for r in report_rows if r["bad_rows"] > 0]


def _fast_counts(df: DataFrame, rules: Sequence[Rule]) -> list[dict]:
    """Counts only, in one action and one pass over the batch."""
    row_rules = [r for r in rules if not r.unique and not r.whole_batch]
    uniq = [r for r in rules if r.unique]
    row = _counts(df, [r.bad(df) for r in row_rules], uniq).first()
    total = int(row["_total"])
    out = []
    for rule in rules:
        if rule.whole_batch:
            bad = int(total == 0)
        elif rule.unique:
            bad = int(row[f"_dup{uniq.index(rule)}"])
        else:
            bad = int(row[f"_bad{row_rules.index(rule)}"])
        out.append({"rule": rule.name, "column": rule.column, "bad_rows": bad, "total_rows": total})
    return out


def enforce(df: DataFrame, rules: Sequence[Rule], source: str = "batch",
            columns: dict[str, str] | None = None) -> int:
    """Eager gate: raise ``DataQualityError`` on any failing rule.

    The common (passing) case reads the batch once; examples are computed in
    a second pass only for the rules that failed. Returns the row count.
    """
    if columns:
        check_columns(df, columns, source)
    rules = list(rules) + [non_empty()]
    report = _fast_counts(df, rules)
    failed = failures(report)
    if failed:
        failing = {(r["rule"], r["column"]) for r in failed}
        failed = check(df, [r for r in rules if (r.name, r.column) in failing]).collect()
        detail = "; ".join(
            f"{r['rule']}({r['column']}): {r['bad_rows']}/{r['total_rows']} e.g. {r['example']}"
            for r in failed
        )
        raise DataQualityError(f"{source}: {detail}")
    return int(report[0]["total_rows"])


def enforce_while_writing(df: DataFrame, rules: Sequence[Rule], write: Callable[[DataFrame], object],
                          source: str = "batch") -> int:
    """Gate a batch in the same pass that writes it: the row-rule counts are
    ``Observation`` metrics of the write, so the input is read once, not
    twice. Only for a target nothing reads before the gate passed (a fresh
    run directory): on failure the written files stay unpublished and
    ``DataQualityError`` is raised. Uniqueness needs a grouped pass; use
    ``enforce`` for it."""
    if any(r.unique for r in rules):
        raise ValueError("uniqueness rules need a grouped pass; use enforce()")
    rules = list(rules) + [non_empty()]
    row_rules = [r for r in rules if not r.whole_batch]
    observation = Observation()
    write(df.observe(observation, F.count(F.lit(1)).alias("_total"),
                     *[F.count_if(r.bad(df)).alias(f"_bad{i}") for i, r in enumerate(row_rules)]))
    metrics = observation.get
    if "_total" not in metrics:  # of a batch without rows Spark drops the rest of the plan, and the counts with it
        return enforce(df, rules[:-1], source)
    total = int(metrics["_total"])
    failing = [r for r in rules
               if (total == 0 if r.whole_batch else metrics[f"_bad{row_rules.index(r)}"] > 0)]
    if failing:
        failed = check(df, failing).collect()
        detail = "; ".join(
            f"{r['rule']}({r['column']}): {r['bad_rows']}/{r['total_rows']} e.g. {r['example']}"
            for r in failed
        )
        raise DataQualityError(f"{source}: {detail}")
    return total


# Column kinds accepted by the contracts (D4): "int" is any integral type.
_KINDS: dict[str, Callable[[DataType], bool]] = {
    "int": lambda t: isinstance(t, IntegralType),
    "str": lambda t: isinstance(t, StringType),
}


def column_violations(df: DataFrame, columns: dict[str, str]) -> list[tuple[str, str, str | None]]:
    """``(column, expected kind, found type)`` of missing (None) and mistyped columns, from the schema alone."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [(name, kind, types[name].simpleString() if name in types else None)
            for name, kind in columns.items() if name not in types or not _KINDS[kind](types[name])]


def check_columns(df: DataFrame, columns: dict[str, str], source: str = "batch") -> None:
    """Presence and type on the schema alone; extra columns allowed."""
    problems = [f"missing column {name}" if found is None else f"column {name} is {found}, expected {kind}"
                for name, kind, found in column_violations(df, columns)]
    if problems:
        raise DataQualityError(f"{source}: " + "; ".join(problems))


@dataclass(frozen=True)
class Contract:
    name: str
    columns: dict[str, str]
    rules: tuple[Rule, ...]

    def check(self, df: DataFrame) -> DataFrame:
        check_columns(df, self.columns, self.name)
        return check(df, self.rules)

    def column_report(self, df: DataFrame) -> DataFrame:
        """G5 as a table: ``column, expected, found`` (NULL: missing) of every violation."""
        return df.sparkSession.createDataFrame(column_violations(df, self.columns), "column string, expected string, found string")

    def enforce(self, df: DataFrame) -> int:
        return enforce(df, self.rules, self.name, self.columns)


STATES_CONTRACT = Contract(
    "states",
    {"id": "int", "sigla": "str", "nome": "str"},
    (
        not_null("id"), positive("id"), unique("id"),
        not_null("sigla"), length_between("sigla", 2, 2), unique("sigla"),
        not_null("nome"),
    ),
)

MUNICIPALITIES_CONTRACT = Contract(
    "municipalities",
    {"id": "int", "nome": "str", "sigla_uf": "str"},
    (
        not_null("id"), positive("id"), unique("id"),
        not_null("nome"),
        not_null("sigla_uf"), isin("sigla_uf", UF_CODES),
    ),
)

# Contract registry keyed by (namespace, table) (G11); a table without an
# entry is loaded unchecked.
CONTRACTS: dict[tuple[str, str], Contract] = {
    ("territory", "states"): STATES_CONTRACT,
    ("territory", "municipalities"): MUNICIPALITIES_CONTRACT,
}


def landing_limits(limits: dict[str, int]) -> tuple[Rule, ...]:
    """L3: landing column limits as rules (id NOT NULL, VARCHAR caps)."""
    return (not_null("id"), *[max_length(c, n) for c, n in limits.items()])


STATE_LANDING_RULES = landing_limits(STATE_LIMITS)
MUNICIPALITY_LANDING_RULES = landing_limits(MUNICIPALITY_LIMITS)

# Gate 1 on raw batches.
RAW_STATE_RULES = (truthy("id", "sigla", "nome"),)
RAW_MUNICIPALITY_RULES = (truthy("id", "nome", "microrregiao.mesorregiao.UF.sigla",
                                 example_chars=MUNICIPALITY_EXAMPLE_CHARS),)


def gate_raw_states(df: DataFrame) -> int:
    return enforce(df, RAW_STATE_RULES, "raw states")


def gate_raw_municipalities(df: DataFrame) -> int:
    return enforce(df, RAW_MUNICIPALITY_RULES, "raw municipalities")
