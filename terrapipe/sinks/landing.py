"""Landing tables with one slice per load day.

``replace_day`` is the idempotent daily load: gate first (nothing is
touched when the batch is rejected), then stamp ``loaded_at`` and
``load_date`` and write with *dynamic* partition overwrite, so only the
batch's day is replaced and other days stay. New files are staged first: a
batch that fails while it is written leaves the previous day in place. The
commit itself deletes the day and renames the new files in, so a driver lost
between these two leaves no day until the load is run again; where readers
must never see that, load with :func:`terrapipe.sinks.switch.switch_day`.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrapipe.operators.quality import Contract, enforce
from terrapipe.schemas import LOAD_DAY_COLUMN, LOAD_TS_COLUMN, landing_schema


def _ts(load_ts: dt.datetime | str | None) -> F.Column:
    if load_ts is None:
        return F.current_timestamp()
    text = load_ts.isoformat(sep=" ") if isinstance(load_ts, dt.datetime) else str(load_ts)
    return F.lit(text).cast("timestamp")


def stamp(df: DataFrame, load_ts: dt.datetime | str | None = None) -> DataFrame:
    """L2: add ``loaded_at`` and the day key ``load_date`` (session time zone)."""
    return df.withColumns({
        LOAD_TS_COLUMN: _ts(load_ts),
        LOAD_DAY_COLUMN: F.to_date(_ts(load_ts)),
    })


def create_landing(spark: SparkSession, table: str, processed: StructType,
                   comment: str, location: str | None = None, limits: dict[str, int] | None = None) -> None:
    """L1, L3: namespace and partitioned landing table, if missing.

    Columns in ``limits`` are declared ``VARCHAR(n)``, so the table itself
    refuses a longer value, whoever writes it.
    """
    limits = limits or {}
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    cols = ", ".join(
        f"`{f.name}` {f'varchar({limits[f.name]})' if f.name in limits else f.dataType.simpleString()}"
        + (" NOT NULL" if f.name == "id" else "")
        for f in landing_schema(processed).fields
    )
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
        f"PARTITIONED BY ({LOAD_DAY_COLUMN}) COMMENT '{comment}'{loc}"
    )


def replace_day(df: DataFrame, target: str, load_ts: dt.datetime | str | None = None,
                contract: Contract | None = None, limits=(), as_table: bool = False) -> int:
    """Gate, then replace the batch's day slice of ``target``.

    ``target`` is a directory (default) or, with ``as_table``, a catalog
    table, whose columns are taken from the batch by name (a missing one is
    an error). Gate and write each read ``df``: pass a stored batch, as the
    daily job and the stream do, so that what is checked is what is written.
    A table without a contract is only refused when empty.
    Returns the number of rows loaded.
    """
    if contract is not None:
        rows = enforce(df, tuple(contract.rules) + tuple(limits), contract.name, contract.columns)
    else:
        rows = enforce(df, tuple(limits), target)
    stamped = stamp(df, load_ts)
    if as_table:
        columns = df.sparkSession.table(target).columns
        if missing := [c for c in columns if c not in stamped.columns]:
            raise ValueError(f"{target}: the batch has no column {', '.join(missing)}")
        (stamped.select(*[F.col(f"`{c}`") for c in columns]).write.option("partitionOverwriteMode", "dynamic")
                .insertInto(target, overwrite=True))
    else:
        (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(LOAD_DAY_COLUMN).parquet(target))
    return rows


def read_day(spark: SparkSession, target: str, day: dt.date | str) -> DataFrame:
    """One day slice; the predicate prunes partitions."""
    return spark.read.parquet(target).where(F.col(LOAD_DAY_COLUMN) == F.lit(str(day)).cast("date"))


def landing_duplicates(landing: DataFrame, key: str = "id") -> DataFrame:
    """Keys loaded more than once on the same day (must be empty)."""
    return (landing.groupBy(key, LOAD_DAY_COLUMN).agg(F.count(F.lit(1)).alias("count"))
                   .where(F.col("count") > 1))


def replace_day_jdbc(spark: SparkSession, df: DataFrame, url: str, table: str,
                     load_ts: dt.datetime | str | None = None, contract: Contract | None = None,
                     limits=(), properties: dict[str, str] | None = None) -> int:
    """The same replace-day into a relational table.

    The batch is gated, then written in parallel by the executors into a
    staging table of this run; one transaction on the driver compares its row
    count with the gate's (a re-run task may have written rows twice), deletes
    the day and inserts from staging, so readers see either the old or the new
    day. The staging table is dropped in any case. Not exercised here: it needs
    a relational database.
    """
    props = dict(properties or {})
    if contract is not None:
        rows = enforce(df, tuple(contract.rules) + tuple(limits), contract.name, contract.columns)
    else:
        rows = enforce(df, tuple(limits), table)
    if load_ts is None:  # pin "now" once, so the rows and the deleted day agree
        load_ts = spark.range(1).select(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    staging = f"{table}_staging_{uuid.uuid4().hex}"
    stamped = stamp(df, load_ts)
    stamped.write.jdbc(url, staging, mode="overwrite", properties=props)
    day = spark.range(1).select(F.to_date(_ts(load_ts))).first()[0]  # evaluates the literal only
    cols = ", ".join(f'"{c}"' for c in stamped.columns)
    jvm = spark.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(url, props.get("user"), props.get("password"))
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        found = stmt.executeQuery(f"SELECT count(*) FROM {staging}")
        found.next()
        if found.getLong(1) != rows:
            raise RuntimeError(f"{staging} holds {found.getLong(1)} rows, the gate counted {rows}")
        stmt.executeUpdate(f"DELETE FROM {table} WHERE \"{LOAD_DAY_COLUMN}\" = DATE '{day}'")
        stmt.executeUpdate(f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}")
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.createStatement().executeUpdate(f"DROP TABLE {staging}")
        conn.commit()
        conn.close()
    return rows
