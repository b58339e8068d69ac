"""Landing laid out by key (A2, L4, L7, S7): bucketed and sorted, so that audits by key plan no shuffle.

Rows of a key lie in one bucket on every day. Grouping by key (the audit of
repeated ids, de-duplication) and joining two days by key (the day comparison)
then read each bucket where it lies, in one stage without an exchange; a
lookup of one id reads one bucket. A load pays one shuffle by key for it,
which also keeps the files at one per bucket and day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.operators.quality import Contract, enforce
from terrapipe.schemas import LOAD_DAY_COLUMN
from terrapipe.sinks.landing import stamp


def append_bucketed_day(df: DataFrame, table: str, buckets: int, location: str, load_ts: dt.datetime | str | None = None,
                        contract: Contract | None = None, limits=(), key: str = "id") -> None:
    """Gate a batch and add it as a day to a bucketed landing table, made if missing.

    The rows are dealt to ``buckets`` tasks as the buckets deal them, so each
    task writes one file. The table is an append target: a day that it already
    holds is refused, as replacing part of a bucketed table is not atomic.
    """
    spark = df.sparkSession
    if contract is not None:
        enforce(df, tuple(contract.rules) + tuple(limits), contract.name, contract.columns)
    else:
        enforce(df, tuple(limits), table)
    stamped = stamp(df, load_ts)
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    if spark.catalog.tableExists(table):
        day = stamp(spark.range(1), load_ts).select(LOAD_DAY_COLUMN)
        if not spark.table(table).join(day, LOAD_DAY_COLUMN, "left_semi").isEmpty():
            raise ValueError(f"{table} already holds the day")
        stamped = stamped.select(*spark.table(table).columns)
    (stamped.repartition(buckets, key).write.mode("append").option("path", location).partitionBy(LOAD_DAY_COLUMN)
     .bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table))


def bucketed_day(spark: SparkSession, table: str, day: dt.date | str) -> DataFrame:
    """One day of the table; its buckets stay known to the planner."""
    return spark.table(table).where(F.col(LOAD_DAY_COLUMN) == F.lit(str(day)).cast("date"))
