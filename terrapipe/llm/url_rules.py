"""Verdicts on URLs: a curated list first, mined association rules for the rest.

Method, all in DataFrame operations and Spark's own FP-growth:

1. A URL is a set of tokens: its scheme, the labels of its host, the segments
   of its path and the keys of its query (runs of digits are one ``0``).
2. The labelled rows' tokens that speak most clearly for one label become items
   (:func:`_items`); FP-growth finds the combinations of items and label that
   reach ``min_support`` of the labelled rows. A rule "these items, therefore
   bad" (or good) stays if it holds for ``min_confidence`` of the rows with the
   items, counted by all items of the rows.
3. An inverted index has each rule under its rarest item. A URL's items look
   their rules up, and a rule counts if the URL has all its items. Of those that
   count the most confident one decides (then the best supported; a bad one
   before a good one), so a pattern that is mostly bad does not condemn the part
   of it that is known to be good. Each distinct set of items is looked up once,
   not each URL.

Bounds: mining takes about ``labelled`` rows (by a hash of the id; all, if there
are no more), ``items`` tokens in all and ``per_url`` of a URL (those that speak
most clearly), so a URL of thousands of tokens cannot make the combinations
explode. The model is therefore bounded, and the driver holds its items only.
All rows of ``pages`` are judged, by all their items. Sets of items are joined
back as a plain join, which Spark broadcasts if they are few, and whose skew
adaptive execution splits if not.

The curated list is a short list in the session: one expression tests it.

Defined results: a null or empty URL, or one without ``://``, has an empty host
and path, fits no curated rule and has no tokens, so it is allowed. Null and
repeated ids are judged by their URLs like any others. Labels that are null,
have a null id or no page are ignored; of several labels of an id the bad one
counts; without labels (or without bad ones) nothing is mined and all other
URLs are allowed. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapipe.llm.shared import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The items that stand for the labels. A token has its kind before a colon, so none equals them.
BAD, GOOD = "bad", "good"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def curated(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the (verdict, ``host/path``) rules that fits, as a struct of rule and verdict; null if none does.

    A rule fits its host and the hosts below it, where the path starts with the
    rule's. Of rules of one length the first in the list counts.
    """
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        here = (host == name) | host.endswith(f".{name}")
        fits.append(F.when(here & path.startswith(slash + rest), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits, F.lit(None).cast("struct<rule: string, verdict: string>"))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, each with its kind: ``scheme:https``, ``host:www``, ``path:0.html``, ``key:page``."""
    def of(kind: str, parts: Column) -> Column:
        plain = F.transform(parts, lambda t: F.regexp_replace(t, "[0-9]+", "0"))
        return F.transform(F.filter(plain, lambda t: t != ""), lambda t: F.concat(F.lit(f"{kind}:"), t))

    scheme = F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), UPPER, LOWER)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda t: F.substring_index(t, "=", 1))
    every = F.concat(of("scheme", F.array(scheme)), of("host", F.split(host_of(url), r"\.")), of("path", F.split(path_of(url), "/")),
                     of("key", keys))
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


def _labelled(pages: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """About ``most`` labelled rows, with a number, whether they are bad, and their tokens."""
    said = labels.where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(F.max("bad").alias("bad"))
    rows = staged(pages.join(said, "id").select("id", "url", "bad"), "url-labelled")
    chosen = F.pmod(F.xxhash64("id"), F.greatest(rows.select(F.count(F.lit(1))).scalar(), F.lit(1))) < most
    return staged(rows.where(chosen).select(F.monotonically_increasing_id().alias("row"), "bad", tokens_of(F.col("url")).alias("tokens")),
                  "url-transactions")


def _items(rows: DataFrame, least: int, most: int, n: int, bad: int) -> DataFrame:
    """The tokens that set bad and other rows apart most clearly: token, count and weight.

    The weight is the share of the rows that the token moves between the labels,
    against the labels' shares over all rows.
    """
    counts = (rows.select(F.explode("tokens").alias("token"), F.col("bad").cast("long").alias("bad")).groupBy("token")
              .agg(F.count(F.lit(1)).alias("count"), F.sum("bad").alias("bad")).where(F.col("count") >= least))
    weight = F.abs(F.col("bad") - F.col("count") * F.lit(bad / n)) / F.sqrt("count")
    return counts.select("token", "count", weight.alias("weight")).orderBy(F.desc("weight"), "token").limit(most)


def mine(pages: DataFrame, labels: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, labelled: int = 200_000,
         items: int = 4096, per_url: int = 12) -> DataFrame | None:
    """The rules: ``tokens`` that together speak for a label, whether it is ``bad``, support, confidence and the rarest token.

    ``pages`` has id and url, ``labels`` id and bad. None if there is nothing to mine.
    """
    rows = _labelled(pages, labels, labelled)
    n, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))).first()
    if not bad:
        return None
    found = staged(_items(rows, max(1, int(min_support * n)), items, n, bad), "url-items")
    first = F.slice(F.sort_array(F.collect_list(F.struct("weight", "token")), asc=False), 1, per_url)
    sets = (rows.select("row", "bad", F.explode("tokens").alias("token")).join(found, "token")
            .groupBy("row", "bad").agg(F.transform(first, lambda t: t.token).alias("tokens"))
            .select(F.array_append("tokens", F.when(F.col("bad"), F.lit(BAD)).otherwise(F.lit(GOOD))).alias("items")))
    sets = staged(sets, "url-sets")
    held = sets.count()
    if not held:
        return None
    share = min(1.0, min_support * n / held)  # rows without items count as well: support is of all labelled rows
    rules = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(sets).associationRules
    rules = rules.where(F.element_at("consequent", 1).isin(BAD, GOOD)).select(F.sort_array("antecedent").alias("tokens")).distinct()
    rarest = (rules.select("tokens", F.explode("tokens").alias("token")).join(found, "token")
              .groupBy("tokens").agg(F.min_by("token", F.struct("count", "token")).alias("rarest")))
    index = staged(rarest, "url-index")
    # counted again by all items of the rows, as a long URL entered the mining with some of its items only
    held = rows.select("bad", _items_of("tokens", _tokens(index)).alias("met")).groupBy("met").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    counted = _meets(held, index).groupBy("tokens", "rarest").agg(F.sum("n").alias("all"), F.sum("bad").alias("bad"))
    each = F.explode(F.array(F.struct(F.lit(True).alias("bad"), F.col("bad").alias("of")),
                             F.struct(F.lit(False).alias("bad"), (F.col("all") - F.col("bad")).alias("of"))))
    rules = counted.select("tokens", "rarest", "all", each.alias("label")).select(
        "tokens", "rarest", F.col("label.bad").alias("bad"), (F.col("label.of") / F.col("all")).alias("confidence"),
        (F.col("label.of") / F.lit(n)).alias("support"))
    return staged(rules.where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)), "url-rules")


def _tokens(rules: DataFrame) -> list[str]:
    """The tokens that stand in rules: at most the items."""
    return [r[0] for r in rules.select(F.explode("tokens").alias("token")).distinct().collect()]


def _items_of(tokens: str | Column, known: list[str]) -> Column:
    return F.sort_array(F.filter(tokens, lambda t: t.isin(known)))


def _meets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Each distinct set of items (``met``) with the rules whose tokens it has, looked up under its items."""
    return (sets.where(F.size("met") > 0).withColumn("rarest", F.explode("met")).join(rules, "rarest")
            .where(F.size(F.array_except("tokens", "met")) == 0))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], id_column: str = "page_id", url_column: str = "url",
          **mining) -> DataFrame:
    """Every row's host and path, the curated rule that fits it, and the verdict: the rule's, else of the mined rules.

    Further columns: ``because``, the tokens of the strongest mined rule the URL meets, and its ``confidence``.
    """
    source = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    mined = mine(source, labels, **mining)
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    read = source.withColumns({"host": host_of(url), "path": path_of(url)}).withColumn("fit", curated(host, path, rules))
    if mined is None:
        read = read.withColumns({"bad": F.lit(False), "because": F.lit(None).cast("array<string>"), "confidence": F.lit(None).cast("double")})
    else:
        read = read.withColumn("met", _items_of(tokens_of(url), _tokens(mined)))
        meets = (_meets(read.select("met").distinct(), mined)
                 .groupBy("met").agg(F.max(F.struct("confidence", "support", "bad", "tokens")).alias("best"))
                 .select("met", F.col("best.bad").alias("bad"), F.col("best.tokens").alias("because"), F.col("best.confidence").alias("confidence")))
        read = read.join(staged(meets, "url-matches"), "met", "left")
    verdict = F.coalesce("fit.verdict", F.when(F.col("bad"), F.lit("block")), F.lit("allow"))
    return read.select(F.col("id").alias(id_column), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "because",
                       "confidence")
