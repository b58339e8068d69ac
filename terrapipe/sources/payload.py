"""The statistical payload: raw answers of unknown shape to the long series.

An answer is one line of JSON: a list of variables, each with ``resultados``,
each with ``series``, each with a ``localidade`` and a ``serie`` that maps
periods to values::

    [{"id": "9324", "variavel": "...", "unidade": "Pessoas", "resultados": [{"classificacoes": [], "series": [
        {"localidade": {"id": "1", "nivel": {"id": "N1"}, "nome": "..."}, "serie": {"2021": "213317639"}}]}]}]

Answers come without a schema and not all have all nodes, so a line is parsed
once into a VARIANT and every level is a ``variant_explode`` of it: objects
(period to value) and lists alike become rows. Nothing is cast that may not
fit: a value that is no number (``"..."``, ``"-"``, ``"X"``) is a null value
with its text beside it. What cannot be read is named by
:func:`payload_faults`, a row per line and missing node, and never fails the
rest of the batch.

Both plans are narrow: one scan of the lines, explodes, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a parsed line.
LINES = ("file", "line", "payload")


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines: ``file``, ``line`` (the text) and ``payload`` (VARIANT; null where the text is no JSON)."""
    raw = spark.read.text(path).where("trim(value) <> ''")
    return raw.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"), F.try_parse_json("value").alias("payload"))


def _exploded(df: DataFrame, node: str, name: str) -> DataFrame:
    """A row per entry of the list or object at ``node``; one with nulls where there is none."""
    keep = [F.col(f"t.`{c}`") for c in df.columns]
    entries = df.sparkSession.tvf.variant_explode_outer(F.try_variant_get(F.col(f"t.{node.split('.')[0]}").outer(), _path(node), "variant"))
    return df.alias("t").lateralJoin(entries.alias(name)).select(
        *keep, F.col(f"{name}.pos").alias(f"{name}_pos"), F.col(f"{name}.key").alias(f"{name}_key"), F.col(f"{name}.value").alias(name))


def _path(node: str) -> str:
    return "$" + "".join(f".{step}" for step in node.split(".")[1:])


def _nodes(lines: DataFrame) -> DataFrame:
    """A row per line, variable, result and series, with nulls from the first missing node on."""
    down = lines
    for node, name in (("payload", "variable"), ("variable.resultados", "result"), ("result.series", "series")):
        down = _exploded(down, node, name).drop(f"{name}_key")
    text = {"variable_id": ("variable", "$.id"), "unit": ("variable", "$.unidade"), "level": ("series", "$.localidade.nivel.id"),
            "locality_id": ("series", "$.localidade.id"), "locality": ("series", "$.localidade.nome")}
    return down.withColumns({name: F.try_variant_get(node, path, "string") for name, (node, path) in text.items()})


def payload_facts(lines: DataFrame, table_id: int) -> DataFrame:
    """The long series in the columns of the stored facts, with ``unit`` and the value's ``text``.

    A series without a variable, locality, level or period has no place in the
    facts; :func:`payload_faults` names it.
    """
    points = _exploded(_nodes(lines), "series.serie", "point")
    value = F.try_variant_get("point", "$", "string")
    return points.select(
        F.expr("try_cast(locality_id AS int)").alias("locality_id"), value.try_cast("double").alias("value"),
        F.lit(table_id).alias("table_id"), F.expr("try_cast(variable_id AS int)").alias("variable_id"), "level",
        F.col("point_key").alias("period"), "unit", value.alias("text"),
    ).where("locality_id IS NOT NULL AND variable_id IS NOT NULL AND level IS NOT NULL AND period IS NOT NULL")


def payload_faults(lines: DataFrame) -> DataFrame:
    """What the lines lack: ``file``, ``line`` and ``fault``, the first missing node on each way down."""
    points = _exploded(_nodes(lines), "series.serie", "point")
    value = F.try_variant_get("point", "$", "string")
    fault = (F.when(F.col("payload").isNull(), "not JSON")
              .when(F.col("variable").isNull(), "no variable")
              .when(F.expr("try_cast(variable_id AS int)").isNull(), "no variable id")
              .when(F.col("result").isNull(), "no resultados")
              .when(F.col("series").isNull(), "no series")
              .when(F.expr("try_cast(locality_id AS int)").isNull() | F.col("level").isNull(), "no localidade")
              .when(F.col("point_key").isNull(), "no serie")
              .when(value.try_cast("double").isNull(), "no number"))
    first = F.coalesce("point_pos", F.lit(0)) == 0  # what a series lacks is said once, not once per period
    return points.withColumn("fault", fault).where(F.when(F.col("fault") != "no number", first).otherwise(True)).select(
        "file", "line", "fault").where("fault IS NOT NULL")
