"""Set-based writes: every function returns the resulting relation, to be written by the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from sparkfolio.functions.scalars import slug


def _has_order(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return _has_order(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def _places(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns to compare rows by; those of a type without an order as JSON."""
    return [F.col(c) if _has_order(df.schema[c].dataType) else F.to_json(F.struct(c)) for c in names]


def first_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of least ``order`` of each key, whole; partial minima combine before the shuffle.

    A null order comes last. Rows of equal order are told apart by their
    other columns in turn (nulls first), so the choice doesn't depend on how
    the input is split.
    """
    rest = [c for c in df.columns if c not in keys]
    least = F.struct(F.col(order).isNull(), *_places(df, [order, *rest]))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), least).alias("_r"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


def last_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of greatest ``order`` of each key; a null order gives way to any other, ties as in ``first_of``."""
    rest = [c for c in df.columns if c not in keys]
    most = F.struct(F.col(order).isNotNull(), *_places(df, [order, *rest]))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), most).alias("_r"))
    return best.select(*(F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


def new_parents(target: DataFrame, incoming: DataFrame, order: str, required: tuple[str, ...] = ("source", "title", "url")) -> DataFrame:
    """Rows of ``incoming`` that an insert-or-ignore adds: required columns set, first per url, url not stored yet."""
    ok = incoming
    for c in required:
        ok = ok.filter(F.col(c).isNotNull())
    first = first_of(ok, ["url"], order)
    return first.join(target.select("url"), "url", "left_anti")


def insert_or_ignore(target: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    return target.unionByName(new_parents(target, incoming, order).select(*target.columns))


def new_children(children: DataFrame, added: DataFrame, parent_key: str = "exhibition_id") -> DataFrame:
    """Children of newly added parents only, with both names set, each (parent, artist, work) once."""
    ok = children.filter(F.col("artist_name").isNotNull() & F.col("work_title").isNotNull())
    ok = ok.join(added.select(F.col("id").alias(parent_key)), parent_key, "left_semi")
    keys = [parent_key, "artist_name", "work_title"]
    rest = [c for c in ok.columns if c not in keys]
    return first_of(ok, keys, rest[0]) if rest else ok.distinct()


def delete_cascade(parents: DataFrame, children: DataFrame, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parents and children without those of the urls in ``doomed``."""
    gone = parents.join(doomed.select("url"), "url", "left_semi").select("id")
    left = parents.join(doomed.select("url"), "url", "left_anti")
    return left, children.join(gone.withColumnRenamed("id", "exhibition_id"), "exhibition_id", "left_anti")


def delete_where(parents: DataFrame, children: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    gone = parents.filter(predicate).select("url")
    return delete_cascade(parents, children, gone)


def upsert(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace stored ones of the same key."""
    return target.join(incoming.select(key), key, "left_anti").select(*target.columns).unionByName(incoming.select(*target.columns))


def last_writer_wins(rows: DataFrame, key: str, version: str) -> DataFrame:
    """The latest row of each key, its columns after the key; see ``last_of`` for nulls and ties."""
    return last_of(rows, [key], version).select(key, *(c for c in rows.columns if c != key))


def cleared(cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the empty cache, how many rows went)."""
    return cache.limit(0), cache.agg(F.count("*").alias("removed"))


def skip_existing(incoming: DataFrame, target: DataFrame, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """(rows to process, rows already stored)."""
    keys = target.select(key)
    return incoming.join(keys, key, "left_anti"), incoming.join(keys, key, "left_semi")


def backfill(df: DataFrame, column: str, value: Column, when: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(all rows with the column filled, changed rows only): filled where ``when`` holds, by default where null or empty."""
    when = (F.col(column).isNull() | (F.col(column) == "")) if when is None else when
    hit = when & value.isNotNull()
    out = df.withColumn("_new", F.when(hit, value).otherwise(F.col(column))).withColumn("changed", F.coalesce(hit, F.lit(False)))
    out = out.withColumn(column, F.col("_new")).drop("_new")
    return out, out.filter("changed")


def map_by(df: DataFrame, key: str, dimension: DataFrame, dim_key: str, value: str) -> DataFrame:
    """Left lookup of a value in a dimension table; the optimizer broadcasts it when it is small."""
    d = dimension.select(F.col(dim_key).alias("_k"), F.col(value).alias(f"new_{value}")).dropDuplicates(["_k"])
    return df.join(d, F.col(key) == F.col("_k"), "left").drop("_k")


def backfill_series(parents: DataFrame, series: DataFrame) -> DataFrame:
    """Changes (id, series_id) of records without a series (null or 0) whose parser key is a series' key."""
    s = F.broadcast(series.select(F.col("id").alias("_series"), F.col("series_key").alias("parser_key")))
    return parents.filter(F.coalesce("series_id", F.lit(0)) == 0).join(s, "parser_key").select("id", F.col("_series").alias("series_id"))


def backfill_institution_type(df: DataFrame, value: str = "museum") -> tuple[DataFrame, DataFrame]:
    """(all rows with the type filled, changed rows only)."""
    return backfill(df, "institution_type", F.lit(value))


def mapped_keys(df: DataFrame, keys: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(all rows with an empty parser_key taken from a map of sources, changed rows only); other sources stay empty."""
    value = F.coalesce(*(F.when(F.col("source") == s, F.lit(k)) for s, k in keys.items()))
    return backfill(df, "parser_key", value)


def parser_key_from_source(source: str = "source") -> Column:
    return slug(source)


def reconcile(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Columns of ``schema`` in order: absent ones as typed nulls, others cast."""
    return df.select(*(F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in schema.items()))


def run_state(events: DataFrame) -> DataFrame:
    """Latest view of an append-only log of run starts and finishes (run_id, at, counters)."""
    cols = [c for c in events.columns if c != "run_id"]
    first = F.min("at").alias("started_at")
    finish = F.max_by(F.struct(*cols), F.when(F.col("kind") == "finish", F.col("at"))).alias("f")
    return events.groupBy("run_id").agg(first, finish).select("run_id", "started_at", "f.*")


def fill_guarded(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Changes view of enrichment: a field is replaced only under its own guard.

    concept: missing or under 50 characters, new one of 20 or more; preface:
    missing, new one of 10 or more; others: missing, new one not empty.
    """
    out = df
    for c, new in changes.items():
        old = F.col(c)
        missing = old.isNull() | (old == "") | (old == "[]")
        if c == "concept":
            guard = (missing | (F.length(old) < 50)) & (F.length(new) >= 20)
        elif c == "preface":
            guard = missing & (F.length(new) >= 10)
        else:
            guard = missing & (F.coalesce(new, F.lit("")) != "")
        out = out.withColumn(c, F.when(guard, new).otherwise(old))
    return out
