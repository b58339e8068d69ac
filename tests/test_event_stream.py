"""Late and repeated events: a stream stopped and started again appends what one batch over distinct events gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from terrapipe.streaming.events import EVENTS, hourly, run_hourly

T0 = dt.datetime(2024, 1, 1)


def write(spark, rows, source):
    (spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source))


def event(i, minutes, value=1.0):
    return (i, T0 + dt.timedelta(minutes=minutes), i % 5, "ab"[i % 2], value, None)


def rows_of(df):
    return sorted((str(r.hour), r.event_type, r.events, r.least, r.greatest, r.cents) for r in df.collect())


@pytest.mark.parametrize("stops", [1, 3])
def test_replay_after_stops_equals_the_batch(spark, scratch, stops):
    rng = random.Random(9)
    events = [event(i, i, round(rng.random() * 50, 2)) for i in range(900)]
    deliveries = [[], [], []]
    for e in events:
        k = e[0] // 300
        late = rng.random() < 0.2 and e[0] % 300 > 250 and k < 2  # up to 50 minutes late, with the next delivery
        deliveries[k + late].append(e)
        if rng.random() < 0.3:
            deliveries[k + late].append(e)
    source, target, checkpoint = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    for k, rows in enumerate(deliveries):
        rng.shuffle(rows)
        write(spark, rows, source)
        if stops == 3 or k == 2:
            run_hourly(spark, source, target, checkpoint)
    last = events[-1][1] - dt.timedelta(hours=2)
    batch = hourly(spark.createDataFrame(events, EVENTS)).where(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(last))
    assert rows_of(spark.read.parquet(target)) == rows_of(batch) and batch.count() > 20
    assert run_hourly(spark, source, target, checkpoint) == 0 or rows_of(spark.read.parquet(target)) == rows_of(batch)


def test_too_late_and_null_times(spark, scratch):
    """A record behind the watermark is dropped; one without a time has no hour."""
    source, target, checkpoint = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    write(spark, [event(1, 0), event(2, 30), event(3, 600)], source)
    run_hourly(spark, source, target, checkpoint)
    write(spark, [event(4, 10), (5, None, 1, "a", 1.0, None), event(6, 1200)], source)
    run_hourly(spark, source, target, checkpoint)
    assert [(r[0], r[2]) for r in rows_of(spark.read.parquet(target))] == [(str(T0), 1), (str(T0), 1), (str(T0 + dt.timedelta(hours=10)), 1)]


def test_a_delivery_of_many_files_is_one_micro_batch(spark, scratch):
    """Each file has records of the delivery's whole time: none is behind the watermark of another."""
    source, target, checkpoint = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt"
    events = [event(i, i) for i in range(900)]
    for k in range(2):
        spark.createDataFrame(events[k * 450:(k + 1) * 450], EVENTS).repartition(4, "event_id").write.mode("append").parquet(source)
        run_hourly(spark, source, target, checkpoint, files_per_batch=None)
    batch = hourly(spark.createDataFrame(events, EVENTS)).where(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(events[-1][1] - dt.timedelta(hours=2)))
    assert rows_of(spark.read.parquet(target)) == rows_of(batch) and batch.count() > 20


def test_events_are_delivered_by_many_tasks(spark, scratch, monkeypatch):
    """No task writes a whole delivery: the events' files are read and delivered side by side."""
    from terrapipe.plans import extended

    (spark.range(8000).select("id", (F.col("id") * 10).alias("s")).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.lit("a").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props")).repartition(4, "event_id").write.parquet(f"{scratch}/events.parquet"))
    folders = []
    monkeypatch.setattr(extended, "run_dir", lambda spark, name: folders.append(f"{scratch}/{name}") or folders[-1])
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task for each file
    try:
        hours = extended.q_events_stream(spark, scratch).agg(F.sum("events")).first()[0]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert 0 < hours <= 8000
    files = spark.read.parquet(folders[0]).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 3
