"""Keyword search of records by an inverted index of three-character pieces."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.functions.scalars import ascii_lower, like_any_case
from sparkfolio.operators.analytics import SEARCHED
from sparkfolio.storage import materialise

GRAM = 3
_MOST_LISTED = 2000  # texts or ids that go into a scan's filter


def grams_of(text: Column) -> Column:
    """Distinct pieces of a text of ``GRAM`` characters, A-Z lower-cased; none of a shorter or null text."""
    low = ascii_lower(text)
    n = F.length(text) - (GRAM - 1)
    pieces = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(low, i, F.lit(GRAM)))
    return F.when(n > 0, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def grams_in(keyword: str) -> list[str]:
    """Pieces that every match of the keyword holds: those of its parts between the wildcards % and _."""
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), keyword)
    parts = re.split("[%_]", low)
    return sorted({p[i : i + GRAM] for p in parts for i in range(len(p) - GRAM + 1)})


class SearchIndex:
    """Which texts have which pieces, and which parents have which texts in their searched fields or their children's.

    Under one folder: the distinct texts, by their hash; the pairs (piece,
    hash of a text), once for each text, and the pieces' counts; who holds a
    text, as rows (text, id, whether it is the parent's own); and the parents'
    ids. Pairs and holders stay in the task that makes them, each file sorted
    by piece or hash: what all texts or records have is spread over all files,
    and a lookup reads the row groups of its pieces and texts alone. A search
    intersects the rarest pieces of its keyword, verifies the texts that have
    them all by the LIKE rule, and looks up who holds those. Hashes only
    order and filter: holders are matched by the text itself.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(
        cls, spark: SparkSession, path: str, parents: DataFrame, children: DataFrame,
        parent_fields: tuple[str, ...] | None = None, child_fields: tuple[str, ...] = ("artist_name", "work_title"),
    ) -> SearchIndex:
        """Index parents by id and children by exhibition_id; null ids can't be found and are left out."""
        path = path.rstrip("/")
        parent_fields = parent_fields or tuple(c for c in SEARCHED if c in parents.columns)
        parts = ((parents, "id", parent_fields, True), (children, "exhibition_id", child_fields, False))
        held = [df.select(F.col(key).alias("id"), F.explode(F.array(*fields)).alias("text"), F.lit(own).alias("own")) for df, key, fields, own in parts]
        held = held[0].unionByName(held[1]).filter("id IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
        held.sortWithinPartitions("h").write.parquet(f"{path}/holders")
        parents.select("id").filter("id IS NOT NULL").write.parquet(f"{path}/ids")
        texts = spark.read.parquet(f"{path}/holders").select("h", "text").distinct()
        texts.repartitionByRange("h").sortWithinPartitions("h").write.parquet(f"{path}/texts")
        # Dealt anew, since a small file of texts, read by one task, has many times its size in pieces.
        dealt = spark.read.parquet(f"{path}/texts").repartition("h")
        pairs = dealt.select(F.explode(grams_of(F.col("text"))).alias("gram"), "h")
        pairs.sortWithinPartitions("gram", "h").write.parquet(f"{path}/pairs")
        counts = spark.read.parquet(f"{path}/pairs").groupBy("gram").agg(F.count("*").alias("n"))
        counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/counts")
        return cls(spark, path)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def candidates(self, keyword: str, most: int = 4) -> DataFrame | None:
        """Hashes of texts that have the keyword's ``most`` rarest pieces; None if it has no piece, so that all must be looked at."""
        wanted = grams_in(keyword)
        if not wanted:
            return None
        rows = self._table("counts").filter(F.col("gram").isin(wanted)).collect()  # a row per piece of the keyword at most
        counts = {r["gram"]: r["n"] for r in rows}
        rarest = sorted(wanted, key=lambda g: (counts.get(g, 0), g))[:most]
        pairs = self._table("pairs")
        if any(g not in counts for g in wanted):
            return pairs.select("h").limit(0)
        hits = pairs.filter(F.col("gram").isin(rarest))
        return hits.groupBy("h").agg(F.count_distinct("gram").alias("_n")).filter(F.col("_n") == len(rarest)).select("h")

    @staticmethod
    def _among(rows: DataFrame, found: DataFrame, label: str) -> DataFrame:
        """Rows whose columns of ``found`` are among it; a few are put into the scan's filter, which skips row groups."""
        found = materialise(found, label)
        few = found.limit(_MOST_LISTED + 1).collect()
        if len(few) > _MOST_LISTED:
            return rows.join(found, found.columns, "left_semi")
        listed = [F.col(c).isin([r[c] for r in few]) for c in found.columns if c != "text"]
        return rows.filter(reduce(and_, listed)).join(F.broadcast(found), found.columns, "left_semi")  # _MOST_LISTED rows at most

    def search(self, keyword: str) -> DataFrame:
        """Ids of the parents that match, once each: the keyword in a field of their own or of a child, A-Z in any case, % and _ as wildcards."""
        texts, found = self._table("texts"), self.candidates(keyword)
        if found is not None:
            texts = self._among(texts, found, "search-candidates")
        hits = self._among(self._table("holders"), texts.filter(like_any_case("text", keyword)), "search-texts")
        hits = materialise(hits.select("id", "own").distinct(), "search-hits")
        # Children of parents that aren't stored match nobody.
        theirs = self._among(self._table("ids"), hits.filter(~F.col("own")).select("id").distinct(), "search-children")
        return hits.filter("own").select("id").union(theirs).distinct()
