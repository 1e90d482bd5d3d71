"""The dashboard's figures kept up to date by signed changes instead of being counted again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.scalars import extract_year, present
from sparkfolio.operators.analytics import named_artist
from sparkfolio.storage import materialise

SIGN = "sign"


def _inserted(df: DataFrame) -> DataFrame:
    return df if SIGN in df.columns else df.withColumn(SIGN, F.lit(1))


def facts(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Counts (metric, key, part, n) of signed rows: totals, sources, cities, dated sources, years of sources, artists, mediums.

    A column ``sign`` tells inserted rows (1) from deleted ones (-1); without
    it all rows are inserted. Counts of inserts and deletes combine before
    the shuffle.
    """

    def fact(metric: str, key: Column | None = None, when: Column | None = None, part: Column | None = None) -> Column:
        none = F.lit(None).cast("string")
        row = F.struct(F.lit(metric).alias("metric"), (none if key is None else key.cast("string")).alias("key"), (none if part is None else part.cast("string")).alias("part"))
        return row if when is None else F.when(when, row)

    dated = present("start_date")
    of_parents = F.array(
        fact("parents"), fact("source", F.col("source")), fact("city", F.col("city"), present("city")),
        fact("year", F.col("source"), dated, extract_year("start_date")),
    )
    of_children = F.array(fact("children"), fact("artist", F.col("artist_name"), named_artist()), fact("medium", F.col("medium"), present("medium")))
    rows = _inserted(parents).select(SIGN, F.explode(F.array_compact(of_parents)).alias("f")).unionByName(_inserted(children).select(SIGN, F.explode(F.array_compact(of_children)).alias("f")))
    return _nonzero(rows.select("f.*", F.col(SIGN).alias("n")), ["metric", "key", "part"], "n")


def _nonzero(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(value)).filter(F.col(value) != 0)


def _shares(children: DataFrame, names: DataFrame) -> DataFrame:
    """(parent, name, k) of the signed rows of some artists."""
    few = _inserted(children).select(F.col("exhibition_id").alias("parent"), F.col("artist_name").alias("name"), F.col(SIGN).alias("k"))
    return _nonzero(few.join(names, "name", "left_semi"), ["parent", "name"], "k")


def _pairs(shares: DataFrame) -> DataFrame:
    """(source, target, weight): row pairs of two artists in one parent, as often as they meet; at most one row a pair and parent."""
    a = shares.select("parent", F.col("name").alias("source"), F.col("k").alias("ka"))
    b = shares.select("parent", F.col("name").alias("target"), F.col("k").alias("kb"))
    pairs = a.join(b, "parent").filter("source < target")
    return pairs.groupBy("source", "target").agg(F.sum(F.col("ka") * F.col("kb")).alias("weight"))


@dataclass(frozen=True)
class Dashboard:
    """Stored counts, and the co-occurrence of the most frequent artists, from which every view is read.

    ``counts`` has all metrics; ``names`` the tracked artists, the first of
    the artists' ranking; ``shares`` their rows by parent; ``links`` the
    weights of their pairs. Applying a batch of changes costs work in
    proportion to the batch and the stored counts. A pair's weight changes in
    the parents that the batch touches, so those parents' old pairs are taken
    off and their new ones added. When an artist enters the ranking's head,
    its rows are read from the children once; when one falls out, its pairs
    go. Rows with a null parent count as children but meet nobody.
    """

    counts: DataFrame
    names: DataFrame
    shares: DataFrame
    links: DataFrame
    tracked: int

    @classmethod
    def build(cls, parents: DataFrame, children: DataFrame, tracked: int = 40) -> Dashboard:
        counts = materialise(facts(parents, children), "dashboard-counts")
        names = materialise(cls._head(counts, tracked), "dashboard-names")
        shares = materialise(_shares(children, names), "dashboard-shares")
        return cls(counts, names, shares, materialise(_pairs(shares), "dashboard-links"), tracked)

    @staticmethod
    def _head(counts: DataFrame, n: int) -> DataFrame:
        ranked = counts.filter("metric = 'artist'").select(F.col("key").alias("name"), "n")
        return ranked.orderBy(F.desc("n"), "name").limit(n).select("name")

    def apply(self, parents: DataFrame, children: DataFrame, after: DataFrame) -> Dashboard:
        """The dashboard after signed changes of parents and children; ``after`` has all children as they are then."""
        changes = facts(parents, children)
        counts = materialise(_nonzero(self.counts.unionByName(changes.select(*self.counts.columns)), ["metric", "key", "part"], "n"), "dashboard-counts")
        names = materialise(self._head(counts, self.tracked), "dashboard-names")
        stay = self.names.join(names, "name", "left_semi")
        fresh = names.join(self.names, "name", "left_anti")
        old = self.shares.join(stay, "name", "left_semi")
        moved = materialise(_shares(children, stay), "dashboard-moved")
        kept = materialise(_nonzero(old.select("parent", "name", "k").unionByName(moved), ["parent", "name"], "k"), "dashboard-kept")
        touched = moved.select("parent").distinct()
        less = _pairs(old.join(touched, "parent", "left_semi")).withColumn("weight", -F.col("weight"))
        more = _pairs(kept.join(touched, "parent", "left_semi"))
        links = self.links.join(stay.withColumnRenamed("name", "source"), "source", "left_semi").join(stay.withColumnRenamed("name", "target"), "target", "left_semi")
        links = links.select("source", "target", "weight").unionByName(less).unionByName(more)
        entered = materialise(_shares(after.drop(SIGN), fresh), "dashboard-entered")
        shares = materialise(kept.unionByName(entered), "dashboard-shares")
        met = _pairs(shares.join(entered.select("parent").distinct(), "parent", "left_semi"))
        new = F.broadcast(fresh)  # some of the tracked names
        one = met.join(new.withColumnRenamed("name", "source"), "source", "left_semi")
        other = met.join(new.withColumnRenamed("name", "source"), "source", "left_anti").join(new.withColumnRenamed("name", "target"), "target", "left_semi")
        links = links.unionByName(one.select("source", "target", "weight")).unionByName(other.select("source", "target", "weight"))
        links = materialise(_nonzero(links, ["source", "target"], "weight"), "dashboard-links")
        return Dashboard(counts, names, shares, links, self.tracked)

    # --- views
    def _of(self, metric: str) -> DataFrame:
        return self.counts.filter(F.col("metric") == metric)

    def totals(self) -> DataFrame:
        n = lambda m: F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("n"))), F.lit(0)).alias(m)
        return self.counts.agg(n("parents"), n("children"))

    def ranking(self, metric: str, limit: int | None = None) -> DataFrame:
        """(name, n) of sources, cities, artists or mediums, most first."""
        out = self._of(metric).select(F.col("key").alias("name"), "n").orderBy(F.desc("n"), F.col("name").asc_nulls_first())
        return out.limit(limit) if limit else out

    def timeline(self, first: int = 1920, last: int = 2026) -> DataFrame:
        """Dense (year, source, n): each year that occurs with each source that has a date."""
        years = self._of("year").select(F.col("key").alias("source"), F.col("part").cast("int").alias("year"), "n")
        seen = years.filter(F.col("year").between(first, last))
        grid = seen.select("year").distinct().join(years.select("source").distinct())  # a few years and sources
        at = [grid["year"] == F.col("y"), grid["source"].eqNullSafe(F.col("s"))]
        out = grid.join(seen.select(F.col("source").alias("s"), F.col("year").alias("y"), "n"), at, "left")
        return out.select("year", "source", F.coalesce("n", F.lit(0)).alias("n")).orderBy("year", "source")

    def cooccurrence(self, least: int = 2, limit: int = 300) -> DataFrame:
        return self.links.filter(F.col("weight") >= least).orderBy(F.desc("weight"), "source", "target").limit(limit)
