"""A day that readers see whole or not at all (L4, L5): loads side by side, one catalogue statement to move the day.

``replace_day`` puts a day's files where readers look; a driver lost between
deleting the old files and renaming the new ones leaves no day. Here every
load goes to a folder of its own, below the table's ``loads``, and the
catalogue says which folder a day is. ``switch_day`` gates the batch, writes
the folder, and only when all of it is written points the day there, by a
single statement. Before it readers see the old day, after it the new one; a
lost job leaves a folder that nothing points to.

Old folders stay for readers that began before the switch, and to go back to
(:func:`point_day`); :func:`unused_loads` names them for the retention job.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.operators.quality import Contract, enforce
from terrapipe.schemas import LOAD_DAY_COLUMN
from terrapipe.session import child_folders
from terrapipe.sinks.landing import stamp


def _base(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0].rstrip("/")


def day_folder(spark: SparkSession, table: str, day: dt.date | str) -> str | None:
    """The folder that the catalogue has for a day; None if it has no such day."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({LOAD_DAY_COLUMN} = DATE '{day}')")
        return rows.where("col_name = 'Location'").select("data_type").collect()[0][0].rstrip("/")
    except AnalysisException as error:
        if "PARTITIONS_NOT_FOUND" in str(error) or "NoSuchPartition" in str(error):
            return None
        raise


def point_day(spark: SparkSession, table: str, day: dt.date | str, folder: str) -> None:
    """Make ``folder`` the day, by one statement of the catalogue."""
    part = f"PARTITION ({LOAD_DAY_COLUMN} = DATE '{day}')"
    if day_folder(spark, table, day) is None:
        spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def switch_day(df: DataFrame, table: str, load_ts: dt.datetime | str | None = None, contract: Contract | None = None, limits=()) -> str:
    """Gate the batch, write it to a folder of its own, then make that folder the day of ``load_ts``.

    ``table`` is a landing table of the catalogue (see ``create_landing``), whose
    columns are taken from the batch by name. Returns the folder. Gate and write
    each read ``df``: pass a stored batch.
    """
    spark = df.sparkSession
    if load_ts is None:  # "now" is one moment for the rows and their day
        load_ts = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if contract is not None:
        enforce(df, tuple(contract.rules) + tuple(limits), contract.name, contract.columns)
    else:
        enforce(df, tuple(limits), table)
    stamped = stamp(df, load_ts)
    columns = spark.table(table).columns
    if missing := [c for c in columns if c not in stamped.columns]:
        raise ValueError(f"{table}: the batch has no column {', '.join(missing)}")
    day = stamp(spark.range(1), load_ts).select(LOAD_DAY_COLUMN).first()[0]
    folder = f"{_base(spark, table)}/loads/day={day}/load={uuid.uuid4().hex}"
    stamped.select(*[f"`{c}`" for c in columns if c != LOAD_DAY_COLUMN]).write.parquet(folder)
    point_day(spark, table, day, folder)
    return folder


def unused_loads(spark: SparkSession, table: str) -> list[str]:
    """Finished or abandoned load folders that no day points to, by name: a row per load, never per file."""
    days = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    used = {day_folder(spark, table, day).rsplit("/", 1)[-1] for day in days}
    found = [load for day in child_folders(spark, f"{_base(spark, table)}/loads") for load in child_folders(spark, day)]
    return sorted(load for load in found if load.rsplit("/", 1)[-1] not in used)
