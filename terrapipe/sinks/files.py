"""File sinks (K1-K4) and publishing a finished run.

Writers are eager and return the path written. Output always goes to a
fresh run directory; a reader switches to it only after the write
succeeded (``publish``), so a failed overwrite never leaves an empty
dataset behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines of a compressed JSON file at most: some 100 MB of raw municipalities, as much as a task reads of a file that splits.
COMPRESSED_LINES = 250_000


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
              single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV export. ``single_file`` funnels through one task: small tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compressed: bool = False) -> str:
    """JSON Lines, UTF-8, non-ASCII kept as is, NULL fields kept.

    ``compressed`` writes files a fraction of the size, which readers know by
    their names. Such a file is read whole by one task, so none has more than
    ``COMPRESSED_LINES`` lines.
    """
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if compressed:
        writer = writer.option("compression", "snappy").option("maxRecordsPerFile", COMPRESSED_LINES)
    writer.json(path)
    return path


def preview(df: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows under a total order (top-k, no full sort)."""
    cols = order or df.columns
    return df.orderBy(*[F.col(f"`{c}`") for c in cols]).limit(n)


def publish(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    """Point ``table`` at a finished run directory."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")
