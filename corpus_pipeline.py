"""From raw documents to packed training sequences, in stages that each write Parquet.

Every stage works on all rows that its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.llm import toxicity
from terrapipe.llm.decontaminate import contamination
from terrapipe.llm.packing import pack
from terrapipe.llm.pii import pseudonymise
from terrapipe.llm.queries import pseudonym_key, vocabulary
from terrapipe.llm.shared import staged, table, unused
from terrapipe.llm.simhash import near_duplicates
from terrapipe.session import run_dir

#: Calibrated probability from which the toxicity stage rejects a document.
TOXIC_FROM = 0.3


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model learns from all labels."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model, TOXIC_FROM)


def placed(docs: DataFrame, place: str) -> DataFrame:
    """``docs`` with a number per row, stored: numbers computed again could fall on other rows, as they follow the splits."""
    return staged(docs.withColumn(place, F.monotonically_increasing_id()), "pipeline-rows")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (4-word shingles, 4 bits) the row with the smallest id, the first of equal ones."""
    place, key = unused(docs, "_place"), unused(docs, "_key")
    rows = placed(docs, place)
    keyed = rows.withColumn(key, F.struct(F.col("doc_id"), F.col(place).alias("place")))
    groups = near_duplicates(keyed, shingle=4, max_bits=4, id_column=key)
    others = staged(groups.where("id <> component_id").select(F.col("id.place").alias(place)), "pipeline-copies")
    return rows.join(others, place, "left_anti").select(*docs.columns)


def not_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    place = unused(docs, "_place")
    rows = placed(docs, place)
    found = contamination(rows, table(spark, sf_dir, "benchmark"), id_column=place)
    found = staged(found.select(F.col("id").alias(place)).distinct(), "pipeline-leaks")
    return rows.join(found, place, "left_anti").select(*docs.columns)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values replaced in the texts; ``n_chars`` follows the new text."""
    return pseudonymise(docs, pseudonym_key(spark), found_column=None).withColumn(
        "n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences of what is left."""
    return pack(docs, vocabulary(), max_len=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("near-duplicates", one_of_each),
    ("decontamination", not_benchmark),
    ("pii", pseudonyms),
    ("packing", packed),
]

#: Compression distances, tokens and keyed permutations have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = run_dir(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
