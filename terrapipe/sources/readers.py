"""File scans.

JSON is read with an explicit schema by default (no inference pass) and
with a corrupt-record column, so malformed lines surface as bad rows in
gate 1 instead of silently changing the schema. JSON Lines is the default
because it splits; ``multi_line`` reads pretty-printed array files (one
task per file).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from terrapipe.functions.clean import flatten
from terrapipe.schemas import CORRUPT_COLUMN, with_corrupt_column
from terrapipe.session import path_exists


def read_json(spark: SparkSession, path: str, schema: StructType | None = None,
              multi_line: bool = False) -> DataFrame:
    reader = (spark.read.option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    if schema is not None:
        reader = reader.schema(with_corrupt_column(schema))
    return reader.json(path, multiLine=multi_line)


def read_csv(spark: SparkSession, path: str, sep: str = ";", header: bool = True,
             schema: StructType | None = None) -> DataFrame:
    """With a schema (the way at scale: one pass), lines that do not fit it, by
    a value of another type or by their number of fields, keep what fits and
    carry the whole line in the corrupt-record column. Without one, types are
    inferred from every line, an extra pass."""
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if schema is not None:
        reader = (reader.schema(with_corrupt_column(schema)).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
                  .option("columnPruning", "false"))
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan; a declared schema skips the footer-reading inference job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_if_present(spark: SparkSession, path: str, read: Callable[[], DataFrame]) -> DataFrame | None:
    """The scan, or None when nothing lies at ``path``."""
    return read() if path_exists(spark, path) else None


def read_preferred(spark: SparkSession, processed: str, raw: str, schema: StructType,
                   renames: dict[str, str] | None = None, multi_line: bool = False) -> DataFrame:
    """The processed Parquet if present, else the raw JSON flattened and
    renamed, else ``FileNotFoundError``."""
    df = read_if_present(spark, processed, lambda: read_parquet(spark, processed))
    if df is not None:
        return df
    df = read_if_present(spark, raw, lambda: read_json(spark, raw, schema, multi_line))
    if df is None:
        raise FileNotFoundError(f"neither {processed} nor {raw} exists; run the collector or the transform first")
    flat = flatten(df.drop(CORRUPT_COLUMN))
    return flat.withColumnsRenamed(renames or {})
