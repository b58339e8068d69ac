"""Events as a stream: late and repeated records (X3), counted by hour and type.

Records come with an id and an event time, out of order and more than once.
Each id counts once: the state store remembers an id until the watermark has
passed its event time, so state is bounded by the records of ``delay``, not by
the stream. Hourly windows are final once the watermark has passed them and are
appended then, never rewritten, so the sink needs no update.

The query's checkpoint has the read files, the watermark and the state; the
file sink keeps a log of its committed batches. A query that was stopped, or
whose machines were lost, goes on from there, and what it appends in all is
what a single batch over the same records gives, as long as no record is later
than ``delay``. Records that are later are dropped, the only ones that are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def distinct_events(events: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Each event once: its first record, as long as the others come within ``delay``."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly(events: DataFrame) -> DataFrame:
    """Events, their least and greatest value, and the sum of the values in cents, by hour and type.

    The sum is of integers, so that it is the same in whatever order the records come.
    """
    cents = F.round(F.col("value") * 100).cast("long")
    return (events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"), F.min("value").alias("least"), F.max("value").alias("greatest"), F.sum(cents).alias("cents"))
            .select(F.col("w.start").alias("hour"), "event_type", "events", "least", "greatest", "cents"))


def run_hourly(spark: SparkSession, source: str, target: str, checkpoint: str, delay: str = "2 hours", files_per_batch: int | None = 1) -> int:
    """Read the files not seen yet below ``source``, in the order in which they came, append the finished hours, and stop.

    ``files_per_batch=None`` takes all files not seen yet as one delivery, in one
    micro-batch: after each micro-batch the watermark moves on, so the files of a
    delivery that many tasks wrote, each with records of all its time, must not
    be spread over several. Returns the number of micro-batches. The hours still
    open stay in the state for the next call.
    """
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source)
    query = (hourly(distinct_events(stream, delay)).writeStream.format("parquet").outputMode("append").option("path", target)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(query.recentProgress)
