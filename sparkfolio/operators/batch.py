"""Plans of collection batches and summaries of their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Sites by tier in the order they run; sites left out as complete or blocked; sites of high value.
TIERS = {
    "E": "met whitney wikidata".split(),
    "A": "mca_australia louisiana lenbachhaus maxxi pompidou saopaulo_biennial barbican sydney_biennale yokohama_triennale kunsthaus kw_institute".split(),
    "B": "berlin_biennale ucca maiiam psa brooklyn_museum ngv njpac liverpool_biennial beyeler whitney_biennial venice_biennale sharjah_biennale documenta momat hamburger_bahnhof vam".split(),
    "C": "mca_chicago national_gallery_sg new_museum kunsthal reina_sofia palaistokyo hammer_museum zkm astrup_fearnley baltic".split(),
    "D": "museum_ludwig taipei_biennale kanazawa21 south_london_gallery leeum pinakothek".split(),
}
SKIP_KEYS = ("aic", "moma", "serpentine", "tate", "mori", "mplus")
BLOCKED_KEYS = ("dia", "flv", "guggenheim", "hayward", "hirshhorn", "lacma", "mass_moca", "whitechapel")


def runnable(keys: DataFrame, key: str = "key") -> DataFrame:
    """Keys without those that are left out."""
    return keys.filter(~F.col(key).isin(*SKIP_KEYS, *BLOCKED_KEYS))


def batch_plan(spark: SparkSession, tiers: tuple[str, ...] = tuple(TIERS), sites: tuple[str, ...] = (), timeout: int = 600) -> DataFrame:
    """(place, tier, key, timeout) of the sites that a batch runs, in order; given sites come instead of tiers."""
    keys = [(None, k) for k in sites] or [(t, k) for t in tiers for k in TIERS[t]]
    rows = spark.createDataFrame([(i, t, k, timeout) for i, (t, k) in enumerate(keys)], "place int, tier string, key string, timeout int")
    return runnable(rows).orderBy("place")


def retries(plan: DataFrame, results: DataFrame) -> DataFrame:
    """The plan of a second run of what failed (key, success), with twice the time."""
    return plan.join(results.filter(~F.col("success")).select("key"), "key", "left_semi").withColumn("timeout", F.col("timeout") * 2).orderBy("place")


def with_retries(results: DataFrame, second: DataFrame) -> DataFrame:
    """Results (key, success, saved, error) where a second run that succeeded replaces the first."""
    s = second.filter("success").select(F.col("key").alias("_k"), F.col("saved").alias("_saved"))
    out = results.join(s, F.col("key") == F.col("_k"), "left")
    won = F.col("_k").isNotNull()
    return out.select("key", (F.col("success") | won).alias("success"), F.when(won, F.col("_saved")).otherwise(F.col("saved")).alias("saved"), F.when(~won, F.col("error")).alias("error"))


def batch_summary(results: DataFrame) -> DataFrame:
    """Parsers run, ok and failed, and records saved."""
    return results.agg(
        F.count("*").alias("total_parsers"),
        F.count_if("success").alias("ok"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("exhibitions_saved"),
    )


def seeded_sample(keys: DataFrame, n: int, seed: int = 42, key: str = "key") -> DataFrame:
    """``n`` keys in an order that the seed alone decides (ties by key)."""
    return keys.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def limited(rows: DataFrame, stored: DataFrame, site: str, order: str, limit: int, key: str = "url", skip_first: bool = True) -> DataFrame:
    """The first ``limit`` rows of each site that are processed.

    ``skip_first``: stored rows are left out before they count (one page
    after another); otherwise rows are cut first and stored ones are then
    left out (all pages at once).
    """
    place = Window.partitionBy(site).orderBy(order)
    known = stored.select(key)
    fresh = rows.join(known, key, "left_anti") if skip_first else rows
    cut = fresh.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= limit).drop("_n")
    return cut if skip_first else cut.join(known, key, "left_anti")


def outcome(saved: Column, skipped: Column, error: Column) -> Column:
    """What became of one item; an error, kept to 500 characters, never stops the others."""
    return F.struct(
        F.when(skipped, "skipped").when(error.isNotNull(), "failed").when(saved, "saved").otherwise("failed").alias("status"),
        F.substring(error, 1, 500).alias("error"),
    )


def retry_later(status: Column, tries: Column, most: int = 3) -> Column:
    """Seconds before a request is tried again, null if it isn't: no answer or 429, 502, 503, 504; 1, 2, 4 up to 10."""
    again = (status.isNull() | status.isin(429, 502, 503, 504)) & (tries < most)
    return F.when(again, F.least(F.lit(10.0), F.greatest(F.lit(1.0), F.pow(F.lit(2.0), tries - 1))))
