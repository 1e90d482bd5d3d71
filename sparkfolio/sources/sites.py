"""The dimension of collected sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Key, source, city, institution type, strategy, number of link patterns, extra lists, flags, has history.
SITES = (
    ("aic", "Art Institute of Chicago", "Chicago", "museum", "REST_API", 0, 0, "", True),
    ("astrup_fearnley", "Astrup Fearnley Museet", "Oslo", "museum", "HTML_LLM", 1, 0, "", False),
    ("baltic", "BALTIC", "Gateshead", "museum", "HTML_LLM", 1, 0, "", False),
    ("barbican", "Barbican Centre", "London", "museum", "HTML_LLM", 1, 0, "", False),
    ("berlin_biennale", "Berlin Biennale", "Berlin", "biennial", "HTML_LLM", 1, 0, "", False),
    ("beyeler", "Fondation Beyeler", "Basel", "museum", "HTML_LLM", 1, 1, "playwright", True),
    ("venice_biennale", "Venice Biennale", "Venice", "biennial", "HTML_LLM", 3, 0, "", False),
    ("brooklyn_museum", "Brooklyn Museum", "New York", "museum", "HTML_LLM", 1, 0, "", False),
    ("dia", "Dia Art Foundation", "New York", "museum", "HTML_LLM", 1, 0, "BLOCKED_CLOUDFLARE", False),
    ("documenta", "Documenta", "Kassel", "quintennial", "HTML_LLM", 1, 0, "", False),
    ("flv", "Fondation Louis Vuitton", "Paris", "museum", "HTML_LLM", 1, 0, "BLOCKED_SPA", False),
    ("guggenheim", "Guggenheim Museum", "New York", "museum", "HTML_LLM", 1, 0, "BLOCKED_CLOUDFLARE", False),
    ("hamburger_bahnhof", "Hamburger Bahnhof", "Berlin", "museum", "HTML_LLM", 1, 1, "", True),
    ("hammer_museum", "Hammer Museum", "Los Angeles", "museum", "HTML_LLM", 1, 0, "", False),
    ("hayward", "Hayward Gallery", "London", "museum", "HTML_LLM", 1, 0, "curl_cffi, BLOCKED_CLOUDFLARE", False),
    ("hirshhorn", "Hirshhorn Museum and Sculpture Garden", "Washington D.C.", "museum", "REST_API", 0, 0, "BLOCKED_API_KEY", True),
    ("kanazawa21", "21st Century Museum", "Kanazawa", "museum", "HTML_LLM", 1, 0, "", False),
    ("kunsthal", "Kunsthal Rotterdam", "Rotterdam", "museum", "HTML_LLM", 1, 0, "", False),
    ("kunsthaus", "Kunsthaus Zürich", "Zürich", "museum", "HTML_LLM", 1, 0, "", True),
    ("kw_institute", "KW Institute", "Berlin", "museum", "HTML_LLM", 1, 0, "", False),
    ("lacma", "LACMA", "Los Angeles", "museum", "HTML_LLM", 1, 0, "curl_cffi, BLOCKED_CLOUDFLARE", False),
    ("leeum", "Leeum Samsung Museum", "Seoul", "museum", "HTML_LLM", 1, 0, "playwright", False),
    ("lenbachhaus", "Lenbachhaus", "Munich", "museum", "HTML_LLM", 1, 0, "", False),
    ("liverpool_biennial", "Liverpool Biennial", "Liverpool", "biennial", "HTML_LLM", 1, 0, "", False),
    ("louisiana", "Louisiana Museum", "Humlebæk", "museum", "HTML_LLM", 1, 2, "", True),
    ("maiiam", "MAIIAM", "Chiang Mai", "museum", "HTML_LLM", 1, 0, "", False),
    ("mass_moca", "MASS MoCA", "North Adams", "museum", "HTML_LLM", 2, 0, "curl_cffi, BLOCKED_CLOUDFLARE", False),
    ("maxxi", "MAXXI", "Rome", "museum", "HTML_LLM", 1, 0, "", False),
    ("mca_australia", "MCA Australia", "Sydney", "museum", "HTML_LLM", 1, 0, "playwright", False),
    ("mca_chicago", "MCA Chicago", "Chicago", "museum", "HTML_LLM", 1, 0, "", False),
    ("met", "The Met", "New York", "museum", "HTML_LLM", 1, 0, "", False),
    ("moma", "MoMA", "New York", "museum", "CSV_REMOTE", 0, 0, "", True),
    ("momat", "MOMAT", "Tokyo", "museum", "HTML_LLM", 1, 0, "", False),
    ("mori", "Mori Art Museum", "Tokyo", "museum", "HTML_LLM", 1, 0, "", True),
    ("mplus", "M+ Museum", "Hong Kong", "museum", "HTML_LLM", 1, 1, "", True),
    ("museum_ludwig", "Museum Ludwig", "Cologne", "museum", "HTML_LLM", 1, 0, "", False),
    ("national_gallery_sg", "National Gallery Singapore", "Singapore", "museum", "HTML_LLM", 1, 0, "", False),
    ("new_museum", "New Museum", "New York", "museum", "HTML_LLM", 1, 0, "playwright", False),
    ("nga", "National Gallery of Art", "Washington D.C.", "museum", "ARTWORK_ONLY", 0, 0, "", True),
    ("ngv", "NGV", "Melbourne", "museum", "HTML_LLM", 1, 0, "", False),
    ("njpac", "Nam June Paik Art Center", "Yongin", "museum", "HTML_LLM", 1, 0, "", False),
    ("palaistokyo", "Palais de Tokyo", "Paris", "museum", "HTML_LLM", 1, 0, "", False),
    ("pinakothek", "Pinakothek der Moderne", "Munich", "museum", "HTML_LLM", 1, 1, "playwright", True),
    ("pompidou", "Centre Pompidou", "Paris", "museum", "HTML_LLM", 1, 0, "", False),
    ("psa", "Power Station of Art", "Shanghai", "museum", "HTML_LLM", 1, 0, "playwright", True),
    ("reina_sofia", "Museo Reina Sofía", "Madrid", "museum", "HTML_LLM", 1, 0, "", False),
    ("saopaulo_biennial", "São Paulo Biennial", "São Paulo", "biennial", "HTML_LLM", 1, 0, "no-ssl-verify", False),
    ("serpentine", "Serpentine Galleries", "London", "museum", "HTML_LLM", 1, 0, "", True),
    ("sharjah_biennale", "Sharjah Biennial", "Sharjah", "biennial", "HTML_LLM", 1, 0, "", False),
    ("south_london_gallery", "South London Gallery", "London", "museum", "HTML_LLM", 1, 0, "", False),
    ("sydney_biennale", "Sydney Biennale", "Sydney", "biennial", "HTML_LLM", 1, 0, "", False),
    ("taipei_biennale", "Taipei Biennial", "Taipei", "biennial", "HTML_LLM", 1, 0, "", False),
    ("tate", "Tate Modern", "London", "museum", "HTML_LLM", 1, 0, "", True),
    ("ucca", "UCCA Center for Contemporary Art", "Beijing", "museum", "HTML_LLM", 1, 4, "", True),
    ("vam", "V&A Museum", "London", "museum", "HTML_LLM", 1, 2, "", True),
    ("whitechapel", "Whitechapel Gallery", "London", "museum", "HTML_LLM", 1, 0, "curl_cffi, BLOCKED_CLOUDFLARE", False),
    ("whitney", "Whitney Museum of American Art", "New York", "museum", "REST_API", 0, 0, "", True),
    ("whitney_biennial", "Whitney Biennial", "New York", "biennial", "HTML_LLM", 1, 0, "", False),
    ("wikidata", "Wikidata", "Various", "museum", "SPARQL", 0, 0, "", True),
    ("yokohama_triennale", "Yokohama Triennale", "Yokohama", "triennial", "HTML_LLM", 1, 0, "", False),
    ("zkm", "ZKM", "Karlsruhe", "museum", "HTML_LLM", 1, 1, "", True),
)

# Periodic exhibitions as name, key, city, country, founded year, description.
SERIES = (
    ("Venice Biennale", "venice_biennale", "Venice", "Italy", 1895, "International Art Exhibition of la Biennale di Venezia"),
    ("Documenta", "documenta", "Kassel", "Germany", 1955, "Quinquennial contemporary art exhibition"),
    ("Berlin Biennale", "berlin_biennale", "Berlin", "Germany", 1998, "Berlin Biennale for Contemporary Art"),
    ("São Paulo Biennial", "saopaulo_biennial", "São Paulo", "Brazil", 1951, "Bienal de São Paulo"),
    ("Istanbul Biennial", "istanbul_biennale", "Istanbul", "Turkey", 1987, "Istanbul Biennial"),
    ("Lyon Biennale", "lyon_biennale", "Lyon", "France", 1991, "Biennale de Lyon"),
    ("Liverpool Biennial", "liverpool_biennale", "Liverpool", "UK", 1999, "Liverpool Biennial of Contemporary Art"),
    ("Taipei Biennial", "taipei_biennale", "Taipei", "Taiwan", 1998, "Taipei Biennial"),
    ("Yokohama Triennale", "yokohama_triennale", "Yokohama", "Japan", 2001, "Yokohama Triennale"),
    ("Sydney Biennale", "sydney_biennale", "Sydney", "Australia", 1973, "Biennale of Sydney"),
    ("Sharjah Biennial", "sharjah_biennale", "Sharjah", "UAE", 1993, "Sharjah Biennial"),
    ("Gwangju Biennale", "gwangju_biennale", "Gwangju", "South Korea", 1995, "Gwangju Biennale"),
    ("Whitney Biennial", "whitney_biennial", "New York", "USA", 1932, "Whitney Biennial"),
)
# Strategies with a past to collect, and badges of institution types.
HISTORY_STRATEGIES = ("CSV_LOCAL", "CSV_REMOTE", "REST_API", "SPARQL")
BADGES = {"biennial": " [双年展]", "triennial": " [三年展]"}
# Sites whose curators are worth a second look.
HIGH_VALUE_SITES = ("tate", "mori", "mplus", "serpentine", "momat", "whitney", "psa", "ucca", "whitney_biennial")


def sites(spark: SparkSession) -> DataFrame:
    """A row per site with its capabilities."""
    kind = "key string, source string, city string, institution_type string, strategy string, patterns int, extra_lists int, flags string, history boolean"
    return spark.createDataFrame(SITES, kind).withColumn("blocked", F.contains("flags", F.lit("BLOCKED")))


def capabilities(site_rows: DataFrame) -> DataFrame:
    """(key, strategy_label, has_history, badge) of sites, by key."""
    badge = F.coalesce(*(F.when(F.col("institution_type") == k, F.lit(v)) for k, v in BADGES.items()), F.lit(""))
    history = (F.col("extra_lists") > 0) | F.col("history") | F.col("strategy").isin(*HISTORY_STRATEGIES)
    return site_rows.select("key", F.lower("strategy").alias("strategy_label"), history.alias("has_history"), badge.alias("badge")).orderBy("key")


def high_value(site_rows: DataFrame) -> DataFrame:
    """Keys of high-value sites that are registered."""
    keys = site_rows.sparkSession.createDataFrame([(k,) for k in HIGH_VALUE_SITES], "key string")
    return keys.intersect(site_rows.select("key"))


def series(spark: SparkSession) -> DataFrame:
    """The periodic exhibitions by name; ids are places in the seed."""
    rows = [(i, *x) for i, x in enumerate(SERIES, 1)]
    kind = "id long, series_name string, series_key string, city string, country string, founded_year int, description string"
    return spark.createDataFrame(rows, kind).orderBy("series_name")


def with_records(dimension: DataFrame, records: DataFrame, key: str, record_key: str) -> DataFrame:
    """Rows of a dimension with the number of their records, 0 without any; records are counted before the join."""
    n = records.groupBy(F.col(record_key).alias(key)).agg(F.count("*").alias("n_records"))
    return dimension.join(n, key, "left").withColumn("n_records", F.coalesce("n_records", F.lit(0)))
