"""Run the daily load whenever a new raw collection lands (X3 as a stream).

A collection is a run directory of raw JSON Lines files below ``raw_dir``. A
stream of files (names and times, no content) tells which directories have new
ones; each of them is then read whole, once, in the order in which they were finished, and goes through gate
1 and the transform in one pass, a Parquet write of its own (deleted again if
gate 1 rejects the collection), gate 2 and ``replace_day``. So
a later collection of the day replaces an earlier one even if one trigger
finds both, and a collection whose files are found by two triggers is loaded
whole by the second. The stream's checkpoint (below the shared checkpoint
folder) records which files were seen; a micro-batch retried after a failure
replaces the same day again and cannot duplicate rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrapipe.functions.clean import split_path
from terrapipe.operators import quality as Q
from terrapipe.plans.daily import DATASETS, landing_path
from terrapipe.schemas import CORRUPT_COLUMN, with_corrupt_column
from terrapipe.session import delete_path
from terrapipe.sinks.files import write_parquet
from terrapipe.sinks.landing import replace_day
from terrapipe.sources.readers import read_json, read_parquet

#: What a stream of files has; ``content`` is never read here.
FILES = "path string, modificationTime timestamp, length long, content binary"


def _corrupt_as_gated(raw: DataFrame, schema: StructType, rules: Sequence[Q.Rule]) -> DataFrame:
    """A line is corrupt for gate 1 if what the gate reads of it is: of its other fields the transform keeps what fits.

    Only lines that the scan of all fields calls corrupt are looked at again.
    """
    read = {split_path(path)[0] for rule in rules for path in rule.column.split(",")}
    gated = with_corrupt_column(StructType([f for f in schema.fields if f.name in read]))
    again = F.from_json(CORRUPT_COLUMN, gated, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    return raw.withColumn(CORRUPT_COLUMN, F.when(F.col(CORRUPT_COLUMN).isNotNull(), again[CORRUPT_COLUMN]))


def load_new_collections(spark: SparkSession, raw_dir: str, dataset: str, base: str,
                         checkpoint: str, load_ts: dt.datetime | str | None = None) -> list[int]:
    """Process every collection not seen yet, then stop (``availableNow``).

    Returns the row count loaded by each collection, in load order.
    """
    schema, raw_rules, transform, key, limits = DATASETS[dataset]
    files = (spark.readStream.format("binaryFile").schema(FILES).load(raw_dir)
             .select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("modificationTime").alias("finished")))
    loaded: list[int] = []

    def handle(batch: DataFrame, epoch_id: int) -> None:
        found = batch.groupBy("folder").agg(F.max("finished").alias("finished")).orderBy("finished", "folder").collect()
        for row in found:  # one row per collection
            raw = _corrupt_as_gated(read_json(spark, row["folder"], schema), schema, raw_rules)
            run = f"{base.rstrip('/')}/processed/{dataset}/run={uuid.uuid4().hex}"
            try:  # gated while it is transformed: the text, the largest form of a collection, is parsed once
                Q.enforce_while_writing(raw, raw_rules, lambda checked, run=run: write_parquet(transform(checked, sort=False), run),
                                        f"raw {dataset} ({row['folder']})")
            except Exception:
                delete_path(spark, run)
                raise
            processed = read_parquet(spark, run)
            loaded.append(replace_day(processed, landing_path(base, dataset), load_ts, Q.CONTRACTS.get(key), limits))

    query = (files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return loaded
