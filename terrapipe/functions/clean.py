"""Casts, text normalisation and nested-field helpers.

Everything returns a built-in ``Column`` expression, so it stays inside
whole-stage codegen; the schema walks run on the driver against
``df.schema`` only and never trigger a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructType


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str) -> Column:
    """32-bit id: bad strings, fractions and overflow become NULL."""
    return _as_col(c).try_cast(IntegerType())


def clean_title(c: Column | str) -> Column:
    """Trim spaces and capitalise each space-separated word."""
    return F.initcap(F.trim(_as_col(c)))


def clean_code(c: Column | str) -> Column:
    """Trim spaces and upper-case."""
    return F.upper(F.trim(_as_col(c)))


def quote_path(path: str) -> str:
    """Back-quote every step of a dotted path (names may hold hyphens)."""
    return ".".join(f"`{step.strip('`')}`" for step in split_path(path))


def split_path(path: str) -> list[str]:
    steps, buf, quoted = [], [], False
    for ch in path:
        if ch == "`":
            quoted = not quoted
        elif ch == "." and not quoted:
            steps.append("".join(buf))
            buf = []
            continue
        buf.append(ch)
    steps.append("".join(buf))
    return [s.strip("`") for s in steps]


def has_path(schema: StructType, path: str) -> bool:
    """True when every step of ``path`` exists as a (nested) struct field."""
    current: DataType = schema
    for step in split_path(path):
        if not isinstance(current, StructType) or step not in current.fieldNames():
            return False
        current = current[step].dataType
    return True


def optional_path(df: DataFrame, path: str, dtype: DataType) -> Column:
    """Typed NULL when any step of the path is absent, else a safe cast."""
    if has_path(df.schema, path):
        return F.col(quote_path(path)).try_cast(dtype)
    return F.lit(None).cast(dtype)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Expand nested structs into one column per leaf, in one ``select``.

    Leaf names join the path with ``sep``; arrays and maps stay as they are.
    """
    columns: list[Column] = []

    def walk(dtype: DataType, prefix: list[str]) -> None:
        if isinstance(dtype, StructType):
            for field in dtype.fields:
                walk(field.dataType, [*prefix, field.name])
        else:
            columns.append(F.col(quote_path(".".join(f"`{p}`" for p in prefix)))
                           .alias(sep.join(prefix)))

    walk(df.schema, [])
    return df.select(*columns)


def first_present(df: DataFrame, names: list[str] | tuple[str, ...]) -> str:
    """First of ``names`` that is a column of ``df``; fail naming what exists."""
    for name in names:
        if name in df.columns:
            return name
    raise KeyError(f"none of {list(names)} is present; columns: {df.columns}")
