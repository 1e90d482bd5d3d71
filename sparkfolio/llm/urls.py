"""URL filtering by list rules and mined association rules (DataFrame and Spark ML functions only)."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import lower_ascii
from sparkfolio.storage import materialise

#: (verdict, host, path) of the list in use.
LIST_RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
BAD = "label:block"


def host_of(url: Column) -> Column:
    """Between the first "://" and the next "/", "?", "#" or end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to "?", "#" or end; empty without "://"."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels with place, path words (numbers as one), query keys, fragment."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    words = F.filter(F.split(path, "/"), lambda x: x != "")
    words = F.transform(words, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "#")))
    keys = F.filter(F.split(query, "&"), lambda x: x != "")
    keys = F.transform(keys, lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^([^=]*)", 1)))
    rest = F.array(
        F.concat(F.lit("s:"), F.regexp_extract(url, r"(?s)^(.*?)://", 1)),
        F.when(F.contains(url, F.lit("#")), F.lit("f:")),
    )
    tokens = F.filter(F.concat(labels, words, keys, rest), lambda x: x.isNotNull())
    return F.coalesce(F.array_distinct(tokens), F.array().cast("array<string>"))


def token_items(labelled: DataFrame, min_support: float) -> DataFrame:
    """(token, item, n): frequent tokens of (url, tokens), those that stand in the same urls as one item; n urls have it.

    Urls are told by count, sum and exclusive or of their hashes, so no list
    of urls is gathered. Frequent tokens are at most the mean number of tokens
    of a url divided by ``min_support``.
    """
    h = F.xxhash64("url")
    rows = labelled.select(h.alias("h"), F.xxhash64("url", F.lit(1)).alias("g"), F.explode("tokens").alias("token"))
    cover = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("g").alias("x"))
    total = labelled.agg(F.count("*").alias("total"))
    cover = cover.join(F.broadcast(total)).filter(F.col("n") >= F.ceil(F.col("total") * min_support))  # one row
    same = cover.groupBy("n", "s", "x").agg(F.min("token").alias("item"))
    return cover.join(same, ["n", "s", "x"]).select("token", "item", "n")


def with_items(urls: DataFrame, items: DataFrame) -> DataFrame:
    """``urls`` (url, tokens, one row each) with the items of their tokens, those that have any."""
    found = urls.select("url", F.explode("tokens").alias("token")).join(items, "token")
    return urls.join(found.groupBy("url").agg(F.collect_set("item").alias("items")), "url")


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """(rules "these items -> blocked", items of tokens) from (url, bad), by FP-growth.

    Rules have antecedent, confidence, support, and key, the item that fewest
    labelled urls have: the inverted index's. Tokens that always stand
    together are one item, so they make no subsets; a rule that has all items
    of another of at least its confidence says nothing and is left out. Both
    leave the verdicts as they are.
    """
    baskets = labelled.select("url", "bad", url_tokens(F.col("url")).alias("tokens"))
    items = materialise(token_items(baskets, min_support), "url-items")
    rows = baskets.select(F.monotonically_increasing_id().cast("string").alias("url"), "bad", "tokens")
    rows = materialise(rows, "url-baskets")
    found = with_items(rows.select("url", "tokens"), items).select("url", "items")
    none = F.array().cast("array<string>")
    mark = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(none)
    marked = rows.join(found, "url", "left").select(F.concat(F.coalesce("items", none), mark).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(marked)
    rules = model.associationRules
    rules = rules.filter(F.array_contains("consequent", BAD)).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    return prune(materialise(rules, "url-rules"), items), items


def prune(rules: DataFrame, items: DataFrame) -> DataFrame:
    """Rules that no smaller one of at least their confidence implies, each under the rarest item of its antecedent."""
    size = items.select("item", "n").distinct()
    keyed = rules.select("*", F.explode("antecedent").alias("item")).join(size, "item")
    keyed = keyed.groupBy("antecedent", "confidence", "support").agg(F.min_by("item", F.struct("n", "item")).alias("key"))
    small = keyed.select("key", F.col("antecedent").alias("part"), F.col("confidence").alias("sure"))
    within = keyed.select("antecedent", "confidence", F.explode("antecedent").alias("key")).join(small, "key")
    implied = within.filter((F.size("part") < F.size("antecedent")) & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("part", "antecedent")) == 0))
    return keyed.join(implied.select("antecedent").distinct(), "antecedent", "left_anti")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    list_rules=LIST_RULES,
    min_support: float = 0.005,
    min_confidence: float = 0.6,
) -> DataFrame:
    """Verdict for each page: page_id, url, host, path, rule, verdict, confidence.

    The longest list rule that fits decides (ties: the smaller text). Other
    urls are blocked if all items of a mined rule occur in them, else
    allowed. Mining uses pages whose id has a label (doc_id, quality, toxic),
    bad being quality 0 or toxic 1. ``confidence`` is the best matched rule's.

    Null url or one without "://": empty host and path, no list rule. Null
    labels count as good; unlabelled ids are not mined. Repeated rows each
    give a row. Empty tables: no rows, or no mined rules. Extra columns are
    ignored. ``list_rules`` is a parameter of a few entries. Tokens whose urls
    nest without being equal, many levels deep and all frequent, still make
    many itemsets.
    """
    p = pages.select("page_id", "url")
    marks = labels.select(
        F.col("doc_id").alias("page_id"),
        F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)).alias("bad"),
    )
    labelled = p.filter(F.col("url").isNotNull()).join(marks, "page_id").select("url", "bad")
    rules, items = mine_rules(labelled, min_support, min_confidence)
    urls = p.select("url").filter(F.col("url").isNotNull()).distinct().select("url", url_tokens(F.col("url")).alias("tokens"))
    found = with_items(urls, items).select("url", "items")
    found = found.withColumn("key", F.explode("items")).join(rules, "key")
    found = found.filter(F.size(F.array_except("antecedent", "items")) == 0)
    found = found.groupBy("url").agg(F.max("confidence").alias("confidence"))

    out = p.join(found, "url", "left").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    fits = F.array(
        *(
            F.when(
                ((F.col("host") == h) | F.endswith("host", F.lit("." + h))) & F.startswith("path", F.lit(q)),
                F.struct(F.lit(-len(h + q)).alias("o"), F.lit(h + q).alias("rule"), F.lit(v).alias("verdict")),
            )
            for v, h, q in list_rules
        )
    )
    out = out.withColumn("best", F.array_min(fits))
    mined = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", mined).alias("verdict"), "confidence"
    )
