"""A store of records on disk: parents with their children, and cached answers, in buckets of their keys."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkfolio.operators.store import first_of, last_of, new_children, new_parents
from sparkfolio.storage import materialise

REQUIRED = ("source", "title", "url")
_TABLES = ("parents", "children", "cache")
_BATCH = "_batch"


@dataclass(frozen=True)
class Written:
    """What a batch changed: rows added and gone, rows with other values, and the buckets that were written anew."""

    added: int = 0
    removed: int = 0
    changed: int = 0
    buckets: int = 0


class RecordStore:
    """Parents (unique url), children (of a parent's id) and cached answers (unique cache_key) under one folder.

    Rows lie in ``n_buckets`` partition folders by a hash of the url, children
    in their parent's bucket, so an insert, overwrite, delete or update reads
    and writes only the buckets that it touches; files of the others stay as
    they are. Each batch has an id. When all its buckets are written, a marker
    is; a batch with a marker changes nothing when it is run again. Rows carry
    the id of the batch that wrote them, so a batch that broke off in between
    and is run again, before any other, drops its own rows and does them over
    with the same result. Children are written before parents, which still
    tell whose children go. One writer at a time; readers should wait for the
    marker.

    The list of touched buckets, numbers below ``n_buckets``, is all that
    reaches the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        layout = spark.read.text(f"{self.path}/layout").first()
        about = json.loads(layout[0])
        self.n_buckets: int = about["n_buckets"]
        self.schemas = {t: StructType.fromJson(about[t]) for t in _TABLES}

    @classmethod
    def create(cls, spark: SparkSession, path: str, parents: StructType, children: StructType, n_buckets: int = 64) -> RecordStore:
        """An empty store. ``parents`` has id, url, source and title at least, ``children`` exhibition_id, artist_name and work_title."""
        cache = StructType().add("cache_key", "string").add("result_json", "string").add("version", "long")
        about = {"n_buckets": n_buckets, "parents": parents.jsonValue(), "children": children.jsonValue(), "cache": cache.jsonValue()}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path.rstrip('/')}/layout")
        return cls(spark, path)

    # --- reading
    def read(self, table: str) -> DataFrame:
        """All rows of parents, children or cache."""
        return self._stored(table).drop("bucket", _BATCH)

    def record(self, url: str) -> tuple[DataFrame, DataFrame]:
        """(the parent, its children) of a url; one bucket is read."""
        home = F.col("bucket") == self._bucket(F.lit(url))
        parent = self._stored("parents").filter(home & (F.col("url") == url))
        kids = self._stored("children").filter(home).join(parent.select(F.col("id").alias("exhibition_id")), "exhibition_id", "left_semi")
        return parent.drop("bucket", _BATCH), kids.select(*self.schemas["children"].names)

    def applied(self, batch: str) -> bool:
        return self._exists(f"batches/batch={self._named(batch)}/_SUCCESS")

    # --- writing
    def insert(self, batch: str, parents: DataFrame, children: DataFrame, order: str) -> Written:
        """Insert or ignore: parents whose url isn't stored, the first of each url by ``order``, with their children.

        Parents without source, title or url are left out, as are children
        without artist or work; equal children of a parent are stored once.
        """
        if self.applied(batch):
            return Written()
        incoming = self._bucketed(parents.select(*self.schemas["parents"].names, *([] if order in self.schemas["parents"].names else [order])))
        old = self._untouched(batch, "parents", self._buckets(incoming))
        new = new_parents(old, incoming, order, REQUIRED).select(*self.schemas["parents"].names, "bucket")
        new = materialise(new, "store-new")
        return self._commit(batch, new, children, self.spark.createDataFrame([], "url string"))

    def overwrite(self, batch: str, parents: DataFrame, children: DataFrame, order: str) -> Written:
        """Delete with children and insert anew: the first parent of each url replaces the stored one."""
        if self.applied(batch):
            return Written()
        incoming = self._bucketed(parents.select(*self.schemas["parents"].names, *([] if order in self.schemas["parents"].names else [order])))
        new = new_parents(self.spark.createDataFrame([], "url string"), incoming, order, REQUIRED)
        new = materialise(new.select(*self.schemas["parents"].names, "bucket"), "store-new")
        return self._commit(batch, new, children, new.select("url"))

    def delete(self, batch: str, urls: DataFrame) -> Written:
        """Parents of the urls and their children go."""
        if self.applied(batch):
            return Written()
        doomed = self._bucketed(urls.select("url").filter("url IS NOT NULL").distinct())
        stored = self._stored("parents", self._buckets(doomed)).join(doomed.select("url"), "url", "left_semi")
        gone = materialise(stored.select("url"), "store-gone")
        none = self.spark.createDataFrame([], self.schemas["parents"])
        return self._commit(batch, self._bucketed(none), self.spark.createDataFrame([], self.schemas["children"]), gone)

    def delete_where(self, batch: str, predicate: Column) -> Written:
        return self.delete(batch, self.read("parents").filter(predicate))

    def update(self, batch: str, changes: dict[str, Column], where: Column | None = None, dry_run: bool = False) -> tuple[DataFrame, Written]:
        """(changed rows: url and old_ and new_ values, what was written): fields of stored parents set to expressions over them.

        Only rows whose values change count, and only their buckets are
        written; they get this batch's id, so a second try leaves them alone.
        A dry run writes nothing. url and id can't be set.
        """
        if {"url", "id"} & changes.keys():
            raise ValueError("url and id name a record")
        if not dry_run and self.applied(batch):
            return self.spark.createDataFrame([], self._changes_schema(changes)), Written()
        stored = self._stored("parents")
        hit = F.col(_BATCH) != batch
        hit = hit & F.coalesce(where, F.lit(False)) if where is not None else hit
        kinds = self.schemas["parents"]
        new = {c: F.when(hit, v.cast(kinds[c].dataType)).otherwise(F.col(c)) for c, v in changes.items()}
        differs = F.lit(False)
        for c, v in new.items():
            differs = differs | ~F.col(c).eqNullSafe(v)
        pairs = [x for c, v in new.items() for x in (F.col(c).alias(f"old_{c}"), v.alias(f"new_{c}"))]
        changed = materialise(stored.filter(differs).select("url", *pairs, "bucket"), "store-changed")
        report = changed.drop("bucket")
        if dry_run:
            return report, Written(changed=changed.count())
        touched = self._buckets(changed)
        if touched:
            by = F.when(differs, F.lit(batch)).otherwise(F.col(_BATCH))
            self._rewrite("parents", self._stored("parents", touched).withColumns({**new, _BATCH: by}), touched)
        return report, self._mark(batch, Written(changed=changed.count(), buckets=len(touched)))

    def put_cache(self, batch: str, rows: DataFrame) -> Written:
        """Answers (cache_key, result_json, version) replace stored ones of the same key unless those have a greater version."""
        if self.applied(batch):
            return Written()
        rows = rows.select(*self.schemas["cache"].names).filter("cache_key IS NOT NULL")
        new = materialise(self._bucketed(last_of(rows, ["cache_key"], "version"), "cache_key"), "store-cache")
        touched = self._buckets(new)
        if touched:
            old = self._stored("cache", touched)
            every = old.unionByName(new.withColumn(_BATCH, F.lit(batch)).select(*old.columns))
            # Of equal versions the later batch counts.
            every = every.withColumn("_late", F.struct(F.col("version"), (F.col(_BATCH) == batch).alias("new")))
            every = every.withColumn("_late", F.when(F.col("version").isNotNull() | (F.col(_BATCH) == batch), F.col("_late")))
            self._rewrite("cache", last_of(every, ["cache_key"], "_late").drop("_late"), touched)
        return self._mark(batch, Written(added=new.count(), buckets=len(touched)))

    def clear_cache(self, batch: str) -> Written:
        """Drop all answers."""
        if self.applied(batch):
            return Written()
        n = self._stored("cache").count()
        for b in self._buckets(self._stored("cache")):
            self._drop(f"cache/bucket={b}")
        return self._mark(batch, Written(removed=n))

    # --- how
    def _commit(self, batch: str, new: DataFrame, children: DataFrame, gone: DataFrame) -> Written:
        """``new`` parents (with bucket) and their children in, stored parents of the urls in ``gone`` and their children out."""
        doomed = self._bucketed(gone)
        touched = sorted({*self._buckets(new), *self._buckets(doomed)})
        if not touched:
            return self._mark(batch, Written())
        parents, kids = self._untouched(batch, "parents", touched), self._untouched(batch, "children", touched)
        out = parents.join(gone.select("url"), "url", "left_semi").select(F.col("id").alias("exhibition_id"))
        out = materialise(out, "store-out")
        added = new_children(children, new).join(new.select(F.col("id").alias("exhibition_id"), "bucket"), "exhibition_id")
        added = added.withColumn(_BATCH, F.lit(batch)).select(*kids.columns)
        fresh = new.withColumn(_BATCH, F.lit(batch)).select(*parents.columns)
        self._rewrite("children", kids.join(out, "exhibition_id", "left_anti").select(*kids.columns).unionByName(added), touched)
        self._rewrite("parents", parents.join(gone.select("url"), "url", "left_anti").select(*parents.columns).unionByName(fresh), touched)
        return self._mark(batch, Written(added=new.count(), removed=out.count(), buckets=len(touched)))

    def _stored(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType([*self.schemas[table].fields]).add(_BATCH, "string").add("bucket", "integer")
        if not self._exists(table):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        return df if buckets is None else df.filter(F.col("bucket").isin(buckets))

    def _untouched(self, batch: str, table: str, buckets: list[int]) -> DataFrame:
        """Stored rows of some buckets without those that an earlier try of this batch added."""
        return self._stored(table, buckets).filter(F.col(_BATCH) != batch)

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n_buckets)).cast("int")

    def _bucketed(self, df: DataFrame, key: str = "url") -> DataFrame:
        return df.withColumn("bucket", self._bucket(F.col(key)))

    def _buckets(self, df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select("bucket").distinct().collect() if r[0] is not None)

    def _rewrite(self, table: str, df: DataFrame, touched: list[int]) -> None:
        """Write the touched buckets anew; those that are left without rows go."""
        rows = materialise(df, f"store-{table}")
        left = set(self._buckets(rows))
        # Large buckets become several files, small ones share a task.
        rows = rows.hint("rebalance", "bucket")
        rows.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{self.path}/{table}")
        for b in touched:
            if b not in left:
                self._drop(f"{table}/bucket={b}")

    def _mark(self, batch: str, done: Written) -> Written:
        row = [(done.added, done.removed, done.changed, done.buckets)]
        df = self.spark.createDataFrame(row, "added long, removed long, changed long, buckets long").coalesce(1)
        df.write.mode("overwrite").parquet(f"{self.path}/batches/batch={self._named(batch)}")
        return done

    def _changes_schema(self, changes: dict[str, Column]) -> StructType:
        out = StructType().add("url", "string")
        for c in changes:
            kind = self.schemas["parents"][c].dataType
            out = out.add(f"old_{c}", kind).add(f"new_{c}", kind)
        return out

    @staticmethod
    def _named(batch: str) -> str:
        if not re.fullmatch(r"[\w-]+", batch):
            raise ValueError("a batch's id has letters, digits, - and _ only")
        return batch

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _exists(self, name: str) -> bool:
        path = self._path(name)
        return self._fs(path).exists(path)

    def _drop(self, name: str) -> None:
        path = self._path(name)
        self._fs(path).delete(path, True)
