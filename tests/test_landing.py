import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from terrapipe.operators import quality as Q
from terrapipe.schemas import MUNICIPALITY_COMMENT, MUNICIPALITY_PROCESSED
from terrapipe.sinks.landing import (
    create_landing, landing_duplicates, read_day, replace_day, stamp,
)

DAY1, DAY2 = "2024-03-01 10:00:00", "2024-03-02 23:30:00"


def _batch(spark, rows):
    return spark.createDataFrame(rows, "id int, nome string, sigla_uf string, uf_nome string")


def _load(df, target, ts):
    return replace_day(df, target, ts, Q.MUNICIPALITIES_CONTRACT, Q.MUNICIPALITY_LANDING_RULES)


def _day_rows(spark, target, day):
    return sorted((r.id, r.nome) for r in read_day(spark, target, day).collect())


def test_stamp_day_in_session_zone(spark):
    row = stamp(_batch(spark, [(1, "a", "RJ", "x")]), "2024-01-01 23:30:00").selectExpr(
        "CAST(load_date AS STRING) AS day", "CAST(loaded_at AS STRING) AS at").first()
    assert (row.day, row.at) == ("2024-01-01", "2024-01-01 23:30:00")


def test_replace_day_is_idempotent_and_keeps_other_days(spark, tmp):
    target = os.path.join(tmp, "landing")
    a = _batch(spark, [(1, "A", "RJ", "x"), (2, "B", "SP", "y")])
    assert _load(a, target, DAY1) == 2
    assert _load(a, target, DAY2) == 2
    assert _load(a, target, DAY2) == 2  # rerun on the same day
    b = _batch(spark, [(3, "C", "RJ", "z")])
    assert _load(b, target, DAY2) == 1
    assert _day_rows(spark, target, "2024-03-01") == [(1, "A"), (2, "B")]
    assert _day_rows(spark, target, "2024-03-02") == [(3, "C")]
    assert landing_duplicates(spark.read.parquet(target)).count() == 0


def test_rejected_batch_changes_nothing(spark, tmp):
    target = os.path.join(tmp, "landing")
    _load(_batch(spark, [(1, "A", "RJ", "x")]), target, DAY1)
    for bad in ([(1, "A", "XX", "x")], [(1, "A", "RJ", "x"), (1, "B", "SP", "y")], []):
        with pytest.raises(Q.DataQualityError):
            _load(_batch(spark, bad), target, DAY1)
    assert _day_rows(spark, target, "2024-03-01") == [(1, "A")]


def test_over_long_value_rejected_by_landing_limits(spark, tmp):
    with pytest.raises(Q.DataQualityError, match="max_length_100"):
        _load(_batch(spark, [(1, "A", "RJ", "x" * 101)]), os.path.join(tmp, "l"), DAY1)


def test_failure_midway_keeps_previous_day(spark, tmp):
    target = os.path.join(tmp, "landing")
    _load(_batch(spark, [(1, "A", "RJ", "x"), (2, "B", "SP", "y")]), target, DAY1)
    new = _batch(spark, [(i, f"N{i}", "RJ", "z") for i in range(1, 200)]).repartition(4)
    # no rule reads this column, so the gate passes and the row fails in the write
    boom = new.withColumn("regiao_id", F.when(F.col("id") == 150, F.raise_error(F.lit("boom"))).otherwise(F.lit(1)).cast("int"))
    rules = (*Q.MUNICIPALITIES_CONTRACT.rules, *Q.MUNICIPALITY_LANDING_RULES)
    assert Q.enforce(boom, rules, "gate alone", Q.MUNICIPALITIES_CONTRACT.columns) == 199
    with pytest.raises(Exception, match="boom"):
        _load(boom, target, DAY1)
    assert _day_rows(spark, target, "2024-03-01") == [(1, "A"), (2, "B")]
    assert _load(new, target, DAY1) == 199 and len(_day_rows(spark, target, "2024-03-01")) == 199


def test_table_columns_are_matched_by_name(spark, tmp):
    table = f"terrapipe_by_name_{os.path.basename(tmp).replace('-', '_')}"
    spark.sql(f"CREATE TABLE {table} (id int, nome string, sigla_uf string, loaded_at timestamp, load_date date) "
              f"USING parquet PARTITIONED BY (load_date) LOCATION '{tmp}/t'")
    batch = _batch(spark, [(1, "A", "RJ", "x")])
    replace_day(batch.select("sigla_uf", "uf_nome", "nome", "id"), table, DAY1, Q.MUNICIPALITIES_CONTRACT, as_table=True)
    assert [(r.id, r.nome, r.sigla_uf) for r in spark.table(table).collect()] == [(1, "A", "RJ")]
    with pytest.raises(ValueError, match="no column nome"):
        replace_day(batch.drop("nome"), table, DAY1, as_table=True)
    spark.sql(f"DROP TABLE {table}")


def test_unregistered_table_is_refused_only_when_empty(spark, tmp):
    odd = spark.createDataFrame([(None, "x"), (None, "x")], "id int, anything string")
    assert replace_day(odd, f"{tmp}/odd", DAY1) == 2
    with pytest.raises(Q.DataQualityError, match="non_empty"):
        replace_day(odd.limit(0), f"{tmp}/odd", DAY1)
    assert read_day(spark, f"{tmp}/odd", "2024-03-01").count() == 2


def test_read_day_prunes_partitions(spark, tmp):
    target = os.path.join(tmp, "landing")
    _load(_batch(spark, [(1, "A", "RJ", "x")]), target, DAY1)
    _load(_batch(spark, [(2, "B", "RJ", "x")]), target, DAY2)
    plan = plan_text(read_day(spark, target, "2024-03-02"))
    assert "PartitionFilters: [isnotnull(load_date" in plan
    assert _day_rows(spark, target, "2024-03-02") == [(2, "B")]


def test_landing_duplicates_found(spark, tmp):
    target = os.path.join(tmp, "landing")
    df = stamp(_batch(spark, [(1, "A", "RJ", "x"), (1, "B", "RJ", "x"), (2, "C", "RJ", "x")]), DAY1)
    df.write.partitionBy("load_date").parquet(target)
    assert [(r.id, r["count"]) for r in landing_duplicates(spark.read.parquet(target)).collect()] == [(1, 2)]


def test_catalog_table_ddl_and_insert_into(spark, tmp):
    table = "terrapipe_test.municipalities_landing"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_landing(spark, table, MUNICIPALITY_PROCESSED, MUNICIPALITY_COMMENT, os.path.join(tmp, "tbl"))
    create_landing(spark, table, MUNICIPALITY_PROCESSED, MUNICIPALITY_COMMENT)  # IF NOT EXISTS
    cols = [f.name for f in MUNICIPALITY_PROCESSED.fields]
    batch = spark.createDataFrame([(1, "A", "RJ"), (2, "B", "SP")], "id int, nome string, sigla_uf string")
    full = batch.select(*[F.col(c) if c in batch.columns else F.lit(None).cast(
        MUNICIPALITY_PROCESSED[c].dataType).alias(c) for c in cols])
    assert replace_day(full, table, DAY1, Q.MUNICIPALITIES_CONTRACT, as_table=True) == 2
    assert replace_day(full.where("id = 1"), table, DAY1, Q.MUNICIPALITIES_CONTRACT, as_table=True) == 1
    assert replace_day(full, table, DAY2, Q.MUNICIPALITIES_CONTRACT, as_table=True) == 2
    got = spark.table(table).groupBy("load_date").count().orderBy("load_date").collect()
    assert [r["count"] for r in got] == [1, 2]
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert desc.get("Comment") == MUNICIPALITY_COMMENT
    spark.sql(f"DROP TABLE {table}")


def test_day_write_needs_no_sort(spark, tmp):
    """The day key is a literal, so the writer's partition sort folds away."""
    spark.sql("DROP TABLE IF EXISTS terrapipe_sortless")
    spark.sql("CREATE TABLE terrapipe_sortless (id int, nome string, loaded_at timestamp, load_date date) "
              f"USING parquet PARTITIONED BY (load_date) LOCATION '{tmp}/t'")
    stamp(_batch(spark, [(1, "A", "RJ", "x")]).select("id", "nome"), DAY1).createOrReplaceTempView("day_batch")
    plan = spark.sql("EXPLAIN INSERT OVERWRITE TABLE terrapipe_sortless PARTITION (load_date) "
                     "SELECT id, nome, loaded_at, load_date FROM day_batch").first()[0]
    assert "WriteFiles" in plan and "Sort" not in plan
    spark.sql("DROP TABLE terrapipe_sortless")


def test_replace_day_is_dynamic_even_in_a_static_session(spark, tmp):
    """A caller's session may default to static overwrite, which would wipe
    every other day; the writer option keeps the load to its own day."""
    target = os.path.join(tmp, "landing")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        _load(_batch(spark, [(1, "A", "RJ", "x")]), target, DAY1)
        _load(_batch(spark, [(2, "B", "RJ", "x")]), target, DAY2)
        _load(_batch(spark, [(3, "C", "RJ", "x")]), target, DAY2)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert _day_rows(spark, target, "2024-03-01") == [(1, "A")]
    assert _day_rows(spark, target, "2024-03-02") == [(3, "C")]


def test_the_table_itself_refuses_longer_values(spark, tmp):
    """L3: limits are VARCHAR(n) in the DDL, so no writer gets past them."""
    from terrapipe.schemas import STATE_COMMENT, STATE_LIMITS, STATE_PROCESSED

    create_landing(spark, "terrapipe_landing.limited_states", STATE_PROCESSED, STATE_COMMENT, os.path.join(tmp, "limited"), STATE_LIMITS)
    ddl = spark.sql("SHOW CREATE TABLE terrapipe_landing.limited_states").first()[0]
    assert "sigla VARCHAR(2)" in ddl and "nome VARCHAR(100)" in ddl and "id INT" in ddl
    good = spark.createDataFrame([(1, "AC", "Acre", 1, "N", "Norte")], STATE_PROCESSED)
    replace_day(good, "terrapipe_landing.limited_states", "2024-01-01 10:00:00", as_table=True)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        replace_day(good.withColumn("nome", F.repeat("nome", 30)), "terrapipe_landing.limited_states", "2024-01-01 11:00:00", as_table=True)
    assert [r.nome for r in spark.table("terrapipe_landing.limited_states").collect()] == ["Acre"]
