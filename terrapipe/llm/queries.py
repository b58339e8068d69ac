"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapipe.llm import quality, toxicity
from terrapipe.llm.collocations import collocations
from terrapipe.llm.decontaminate import contamination
from terrapipe.llm.html_text import extract
from terrapipe.llm.packing import pack
from terrapipe.llm.pii import pseudonymise
from terrapipe.llm.repeats import remove_repeats
from terrapipe.llm.shared import table
from terrapipe.llm.simhash import near_duplicates
from terrapipe.llm.token_files import token_files
from terrapipe.llm.url_rules import judge
from terrapipe.llm.warc import archive
from terrapipe.llm.whitening import whiten

#: The key of a session that names none; a deployment sets ``spark.terrapipe.pseudonymKey`` to its own, kept secret.
PSEUDONYM_KEY = "terrapipe registered query"


def pseudonym_key(spark: SparkSession) -> bytes:
    return spark.conf.get("spark.terrapipe.pseudonymKey", PSEUDONYM_KEY).encode()


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(), max_len=2048, end_id=1).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, pseudonym_key(spark)).withColumn("n_replaced", F.size("pii").cast("long"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4).withColumnRenamed("id", "doc_id")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), vocabulary(), end_id=2).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = toxicity.fit(docs, labels, where=fold != 2)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.5)


#: The curated part of the URL filter.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad where its document is labelled of low quality or toxic."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge(table(spark, sf_dir, "pages"), labels, URL_RULES)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=32)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_pack": op2_pack,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_html_text": op5_html_text,
    "op6_token_files": op6_token_files,
    "op7_repeats": op7_repeats,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_url_rules": op11_url_rules,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op7_repeats": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        n AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
        w AS (SELECT doc_id, s, array_slice(b, s + 1, s + 50) AS k FROM (SELECT doc_id, b, unnest(range(n - 49)) AS s FROM n WHERE n >= 50)),
        f AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k),
        hit AS (SELECT doc_id, s FROM w JOIN f USING (k) WHERE least < doc_id),
        edge AS (SELECT doc_id, s, coalesce(s > lag(s) OVER o + 50, TRUE) AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
        run AS (SELECT doc_id, s, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM edge),
        span AS (SELECT doc_id, g, min(s) AS a, max(s) + 50 AS z FROM run GROUP BY doc_id, g),
        cut AS (SELECT doc_id, list(a ORDER BY g) AS a, list(z ORDER BY g) AS z, sum(z - a) AS gone, count(*) AS spans FROM span GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
          sha256(CASE WHEN spans IS NULL THEN b ELSE unhex(array_to_string(list_transform(range(spans + 1), lambda i: coalesce(hex(array_slice(b,
            CASE WHEN i = 0 THEN 1 ELSE z[i] + 1 END, CASE WHEN i = spans THEN n ELSE a[i + 1] END)), '')), '')) END) AS kept_sha256
        FROM n LEFT JOIN cut USING (doc_id)""",
    "op10_warc": """
        WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
                          octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
             f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op13_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, i, k, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                                                           FROM (SELECT *, unnest([1, 2, 3]) AS k FROM w))),
        f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
        total AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
        part AS MATERIALIZED (SELECT *, g[:m] AS gl, g[m + 1:] AS gr FROM (SELECT *, unnest(range(1, k)) AS m FROM c)),
        cut AS (SELECT part.lang, part.k, part.g, part.f AS a, l.f AS l, r.f AS r, m,
                       CAST((1000000::HUGEINT * part.f * part.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
                FROM part JOIN f AS l ON l.lang = part.lang AND l.g = gl JOIN f AS r ON r.lang = part.lang AND r.g = gr),
        worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, m) = 1),
        longer AS (SELECT lang, part, max(f) AS most FROM (SELECT lang, f, unnest([g[:2], g[2:]]) AS part FROM c WHERE k = 3) GROUP BY ALL)
        SELECT worst.lang, row_number() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank,
               array_to_string(g, ' ') AS phrase, a, l, r, n, score
        FROM worst JOIN total ON worst.lang = total.lang LEFT JOIN longer ON longer.lang = worst.lang AND longer.part = worst.g
        WHERE most IS NULL OR 100 * most < 50 * a
        QUALIFY rank <= 2000""",
}
