"""Benchmark decontamination: winnowed fingerprints of both sides are joined and hits extended word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkfolio.llm.text import alnum_words, row_slices
from sparkfolio.session import ship_package
from sparkfolio.storage import materialise

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPANS = "array<struct<start:int,stop:int>>"
_PRINTS = "array<struct<print:long,need:int,at:int,before:string,after:string>>"
_MOST_BITS = 1 << 28  # of the filter that tasks get: 32 MB
_BUCKET = 1 << 15  # bits in one of Spark's bitmaps
_MOST_KNOWN = 1 << 18  # words whose hash a task keeps


def _grams(hashes: np.ndarray, k: int, need: int) -> np.ndarray:
    """Hash of each run of k word hashes, as part of a window of ``need`` words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = np.full(n, need, _U)
    for j in range(k):
        h = (h + hashes[j : j + n]) * _U(_BASE)
        h ^= h >> _U(31)
    return h * _U(_BASE) ^ h >> _U(29)


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions of the rightmost least hash of each w consecutive ones (of all, if there are fewer).

    Equal stretches of w hashes choose the same place in themselves.
    """
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    w = min(w, n)
    at = np.arange(n - w + 1)
    least = grams[: n - w + 1].copy()
    for j in range(1, w):
        here = grams[j : n - w + 1 + j]
        at = np.where(here <= least, np.arange(j, n - w + 1 + j), at)
        np.minimum(least, here, out=least)
    return np.unique(at)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


class Prints:
    """Finds the fingerprints of texts, with the words around them that a window can reach.

    Words of many texts are hashed as one row of numbers, with a number of no
    word after each text; windows of a text are among those of the row.
    """

    def __init__(self, window: int, k: int, bits: np.ndarray | None = None, short: tuple[int, ...] = ()):
        self.window, self.k, self.w = window, k, window - k + 1
        self.bits, self.short = bits, short
        self.known: dict[bytes, int] = {}
        self.hashes = np.zeros(1, _U)

    def _row(self, docs: list[list[bytes]]) -> np.ndarray:
        if len(self.known) > _MOST_KNOWN:
            self.known, self.hashes = {}, self.hashes[:1]
        known, had = self.known, len(self.known)
        ids = np.fromiter((i for d in docs for i in (*(known.setdefault(x, len(known) + 1) for x in d), 0)), np.int64, sum(map(len, docs)) + len(docs))
        new = list(known)[had:]
        self.hashes = np.append(self.hashes, np.array([xxhash.xxh64_intdigest(x) for x in new], _U))
        return self.hashes[ids]

    def _may_be(self, grams: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(grams), bool)
        out = self._set(grams)
        some = np.flatnonzero(out)
        out[some] = self._set(grams[some] >> _U(32))
        return out

    def _set(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the bit of each hash is set."""
        at = hashes & _U(8 * len(self.bits) - 1)
        return (self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & np.uint8(1)).astype(bool)

    def __call__(self, docs: list[list[bytes]]) -> list[list[dict]]:
        """Of each text: fingerprints that the filter lets through, by place."""
        out: list[list[dict]] = [[] for _ in docs]
        lengths = np.array([len(d) for d in docs], np.int64)
        first = np.cumsum(lengths + 1) - lengths - 1
        row = self._row(docs)

        def add(grams: np.ndarray, at: np.ndarray, size: int, need: int, back: int) -> None:
            at = at[self._may_be(grams[at])]
            doc = np.searchsorted(first, at, side="right") - 1
            place = at - first[doc]
            inside = place + size <= lengths[doc]
            for g, d, p in zip(grams[at[inside]].view(np.int64).tolist(), doc[inside].tolist(), place[inside].tolist(), strict=True):
                w = docs[d]
                out[d].append({"print": g, "need": need, "at": p, "before": b" ".join(w[max(0, p - back) : p][::-1]), "after": b" ".join(w[p : p + need])})

        grams = _grams(row, self.k, self.window)
        add(grams, winnow(grams, self.w), self.k, self.window, self.w - 1)
        for m in self.short:
            grams = _grams(row, m, m)
            add(grams, np.arange(len(grams)), m, m, 0)
        return out

    def of_items(self, items: list[list[bytes]]) -> list[list[dict]]:
        """Fingerprints of items: an item of fewer words than a window is one of its own length."""
        out = [[] for _ in items]
        by_need: dict[int, list[int]] = {}
        for i, words in enumerate(items):
            if words:
                by_need.setdefault(min(self.window, len(words)), []).append(i)
        for need, rows in by_need.items():
            if need == self.window:
                found = self([items[i] for i in rows])
            else:
                found = [[{"print": g, "need": need, "at": 0, "before": b"", "after": b" ".join(items[i])}] for i in rows for g in _grams(self._row([items[i]])[:-1], need, need).view(np.int64).tolist()]
            for i, f in zip(rows, found, strict=True):
                out[i] = f
        return out


_PRINTS_KIND = pa.list_(pa.struct([("print", pa.int64()), ("need", pa.int32()), ("at", pa.int32()), ("before", pa.string()), ("after", pa.string())]))


def _mark(batches: Iterator[pa.RecordBatch], find, items: bool, keep: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns ``keep`` with n_words and the fingerprints of each row's text."""
    for batch in batches:
        texts = batch.column("_text")
        for rows in row_slices(batch, 4 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            part = batch.slice(rows.start, len(rows))
            words = [alnum_words(texts[i].as_py()) for i in rows]
            prints = pa.array(find.of_items(words) if items else find(words), _PRINTS_KIND)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array([len(w) for w in words], pa.int64()), prints], [*keep, "_words", "_prints"])


def _marked(df: DataFrame, find: Prints, items: bool = False) -> DataFrame:
    """``df`` without _text, with n_words and fingerprints of _text."""
    kept = [c for c in df.columns if c != "_text"]
    added = StructType.fromDDL(f"_words long, _prints {_PRINTS}").fields
    schema = StructType([*(f for f in df.schema.fields if f.name != "_text"), *added])
    return df.mapInArrow(lambda b: _mark(b, find, items, kept), schema)


def _item_prints(items: DataFrame, window: int, k: int) -> DataFrame:
    """Distinct fingerprints of all items with their surroundings, each with the ids of its items; written."""
    b = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary").alias("_text"))
    p = _marked(b, Prints(window, k), items=True).select("item_id", F.explode("_prints").alias("p"))
    p = p.groupBy("p.print", "p.need", "p.before", "p.after").agg(F.collect_set("item_id").alias("ids"))
    return materialise(p, "item-prints")


def _filter_bits(prints: DataFrame) -> np.ndarray | None:
    """A bitmap with two bits of each fingerprint set, by its low and its high half; some thousand bits for each, 32 MB at most. None without any."""
    n = prints.count()
    if not n:
        return None
    size = min(_MOST_BITS, max(_BUCKET, 1 << (1024 * n - 1).bit_length()))
    halves = F.array(F.col("print"), F.shiftrightunsigned("print", 32))
    at = F.pmod("half", F.lit(size)) + 1  # Spark's bitmaps count from 1
    maps = prints.select(F.explode(halves).alias("half")).groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for bucket, bits in maps.collect():  # at most 8192 of 4 KB
        out[(bucket - 1) * _BUCKET // 8 : bucket * _BUCKET // 8] = np.frombuffer(bits, np.uint8)
    return out


def _equal_ahead(a: Column, b: Column) -> Column:
    """How many leading words two texts have in common."""
    words = lambda c: F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))
    first = F.array_position(F.zip_with(words(a), words(b), lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first == 0, F.size(words(a))).otherwise(first - 1).cast("int")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans made disjoint."""
    for batch in batches:
        spans = [[{"start": a, "stop": b} for a, b in _union([(s["start"], s["stop"]) for s in x])] for x in batch.column("spans").to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))))


def _judged(dirty: DataFrame, prints: DataFrame) -> DataFrame:
    """Rows with fingerprints (a written table), with the spans and items that the words around these confirm."""
    dirty = dirty.withColumn("_row", F.monotonically_increasing_id())
    p = dirty.select("_row", F.explode("_prints").alias("p")).select("_row", "p.*")
    t = prints.select("print", "need", F.col("before").alias("_b"), F.col("after").alias("_a"), "ids")
    hits = p.join(t, ["print", "need"])
    hits = hits.withColumns({"left": _equal_ahead(F.col("before"), F.col("_b")), "right": _equal_ahead(F.col("after"), F.col("_a"))})
    hits = hits.filter(F.col("left") + F.col("right") >= F.col("need"))
    span = F.struct((F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("stop"))
    found = hits.groupBy("_row").agg(F.collect_set(span).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
    found = found.mapInArrow(_joined, found.schema)
    return dirty.drop("_prints").join(found, "_row", "left").drop("_row")


def _split(docs: DataFrame, items: DataFrame, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with their fingerprints, the items' fingerprints); ``docs`` has _text."""
    ship_package(docs.sparkSession)
    prints = _item_prints(items, window, k)
    bits = _filter_bits(prints)
    if bits is None:  # nothing can be found
        bits = np.zeros(_BUCKET // 8, np.uint8)
    short = tuple(r[0] for r in prints.filter(F.col("need") < window).select("need").distinct().collect())  # fewer than window
    return _marked(docs, Prints(window, k, bits, tuple(sorted(short)))), prints


def find_contamination(docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = 10, k: int = 5) -> DataFrame:
    """Documents' words inside any ``window`` consecutive words of an item (item_id, text).

    Winnowing: of every window - k + 1 consecutive k-gram hashes the rightmost
    least is kept on both sides, so each shared run of ``window`` words shares
    one. It comes with the words around it that a window with it can reach.
    Fingerprints of both sides are joined, and the run of equal words around
    each pair tells which windows occur, which makes the result exact. An item
    of fewer words is one window of its own length.

    Equal surroundings of items are one row of the join, with the ids of
    their items. Of the documents' fingerprints only those that a bitmap over
    the items' lets through are kept; it has a size that follows their number,
    up to 32 MB, and what it lets through in error the join drops. Spark
    broadcasts the items' side where its written size allows, or shuffles both
    and splits hot fingerprints. The driver holds the bitmap alone.

    Returns the columns ``keep``, n_words, spans (start and stop word of each
    maximal hit run) and items (sorted distinct ids as text), a row per
    input row. Null or wordless text: no words, no hits; items without words
    have no window; a null item_id reads as empty text; equal items each
    count. Empty tables: no rows, or no hits. Extra columns are ignored.
    """
    names = {c: f"c{i}" for i, c in enumerate(keep)}
    d = docs.select(*(_col(c).alias(n) for c, n in names.items()), F.col("text").cast("binary").alias("_text"))
    marked, prints = _split(d, items, window, k)
    marked = materialise(marked, "doc-prints")
    none = F.size("_prints") == 0
    clean = marked.filter(none).drop("_prints").withColumns({"spans": F.lit(None).cast(_SPANS), "items": F.lit(None).cast("array<string>")})
    out = clean.unionByName(_judged(marked.filter(~none), prints))
    return out.select(
        *(F.col(n).alias(c) for c, n in names.items()), F.col("_words").alias("n_words"),
        F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """``docs`` without the rows that hold a window of an item; columns unchanged.

    Rows with a fingerprint of an item, few, are written and judged; the
    others, looked at a second time, pass as they are.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    d = docs.select(*(_col(c).alias(n) for c, n in names.items()), _col("text").cast("binary").alias("_text"))
    marked, prints = _split(d, items, window, k)
    none = F.size("_prints") == 0
    dirty = _judged(materialise(marked.filter(~none), "doc-prints"), prints)
    kept = marked.filter(none).select(*names.values()).unionByName(dirty.filter(F.col("spans").isNull()).select(*names.values()))
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
