"""A key holding a third of all rows: results stay whole and every keyed
aggregate combines map-side before its shuffle."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from terrapipe.operators import quality as Q
from terrapipe.operators.analytics import describe_counts, frequency, share
from terrapipe.operators.dedup import dedup
from terrapipe.sinks.landing import landing_duplicates


@pytest.fixture(scope="module")
def hot(spark):
    n = 30000
    return (spark.range(n).repartition(8)
            .select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                    F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
                    F.lit("2024-01-01").cast("date").alias("load_date"))
            .withColumnRenamed("k", "id"))


def test_dedup_hot_key(spark, hot):
    out = dedup(hot, "id")
    assert out.count() == 30000 - 10000 + 1
    assert out.where("id = -1").first().v == "v0"  # smallest string among the 10,000 copies
    assert "partial_min" in plan_text(out)  # map-side combine of the 10,000 copies


def test_counts_hot_key(spark, hot):
    top = frequency(hot, "id", 1).first()
    assert (top.id, top["count"]) == (-1, 10000)
    assert "partial_count" in plan_text(frequency(hot, "id", 1))
    assert share(hot, "id").where("id = -1").first().pct == round(100 * 10000 / 30000, 1)
    d = describe_counts(hot, "id", None).first()
    assert (d["count"], d["max"]) == (20001, 10000)
    assert "Sort " not in plan_text(describe_counts(hot, "id", None)).split("Exchange")[0]


def test_unique_rule_and_landing_audit_hot_key(spark, hot):
    r = Q.check(hot, [Q.unique("id")]).first()
    assert (r.bad_rows, r.total_rows, r.example) == (10000, 30000, "-1")
    dup = landing_duplicates(hot).collect()
    assert [(x.id, x["count"]) for x in dup] == [(-1, 10000)]
    assert "partial_count" in plan_text(landing_duplicates(hot))
