"""Two-pass external shuffle into equal shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from sparkfolio.session import ship_package
from sparkfolio.storage import materialise

#: Bytes counted for a row besides its text.
ROW_BYTES = 16
_MAX_BUCKETS = 1 << 22
_MOST_SENT = 1 << 22  # hashes of 8 bytes; more of them are joined by a shuffle of the rows
_MAX_TASKS = 1 << 16  # several buckets share a task beyond
ADDED = ("_size", "_crc", "_shard", "_slot")


def _shuffle_buckets(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Collect each bucket (rows arrive sorted by bucket and key), permute it (Fisher-Yates), give it out with places."""
    held: list[pa.RecordBatch] = []
    now = None

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        order = np.random.Generator(np.random.Philox(key=[seed, now])).permutation(table.num_rows)
        place = table.schema.get_field_index("_place")
        for i in range(0, table.num_rows, 4096):
            cut = table.take(pa.array(order[i : i + 4096]))
            cut = cut.set_column(place, "_place", pa.array(np.arange(i, i + cut.num_rows)))
            yield from cut.to_batches()

    for batch in batches:
        buckets = batch.column("_bucket").to_numpy()
        edges = np.flatnonzero(np.diff(buckets)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(buckets)], strict=True):
            if lo == hi:
                continue
            if now is not None and buckets[lo] != now:
                yield from out()
                held = []
            now = int(buckets[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield from out()


def shuffle_into_shards(docs: DataFrame, n_shards: int = 40, seed: int = 17, bucket_bytes: int = 16 << 20) -> DataFrame:
    """All rows of ``docs`` in a seeded uniform order, cut into shards whose row counts differ by one at most.

    Rows whose hash another row has are first counted (partial counts combine
    before the shuffle, so a row that makes up a third of the input is one row
    there) and then numbered; no others are grouped. Pass one scatters rows by
    a seeded hash of all their columns and that number into buckets of about
    ``bucket_bytes``, so copies spread like
    any other rows. Pass two permutes each bucket in memory and writes it. A
    row's place in the whole order is its bucket's offset plus its place
    there; equal slices of it are shards. The order depends on the rows and
    the seed alone, not on how the input is split or ordered.

    Returns the columns of ``docs`` with _size (UTF-8 bytes of the text plus
    16), _crc (of the text), _shard and _slot (from 0, gapless in each shard);
    input columns of these names are replaced. Null text: 16 bytes, crc of
    empty text. Repeated rows each have a slot. Empty input: no rows. There
    are at most 2**22 buckets, whose offsets are broadcast: beyond 64 TB of
    text they grow in proportion.
    """
    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ADDED]
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    names = {c: f"c{i}" for i, c in enumerate(kept)}
    is_map = {c: isinstance(kinds[c], MapType) for c in kept}
    col = lambda c: F.col("`" + c.replace("`", "``") + "`")
    d = docs.select(*(F.map_entries(col(c)).alias(n) if is_map[c] else col(c).alias(n) for c, n in names.items()))
    text = F.col(names["text"])
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")
    total = d.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n_buckets = min(_MAX_BUCKETS, max(1, -(-total // bucket_bytes)))
    # Rows whose hash no other row has are their own first copies; the others, equal or not, are counted and numbered.
    hashed = d.withColumn("_h", F.xxhash64(*names.values()))
    shared = materialise(hashed.groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1").select("_h"), "shuffle-shared")
    if shared.count() <= _MOST_SENT:
        shared = F.broadcast(shared)
    alone = hashed.join(shared, "_h", "left_anti").drop("_h").withColumn("_copy", F.lit(1).cast("long"))
    groups = hashed.join(shared, "_h", "left_semi").groupBy("_h", *names.values()).agg(F.count("*").alias("_n")).drop("_h")
    d = alone.unionByName(groups.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n"))
    d = d.withColumn("_key", F.xxhash64(*names.values(), "_copy", F.lit(seed)))
    d = d.withColumns({"_bucket": F.pmod("_key", F.lit(n_buckets)).cast("long"), "_place": F.lit(0).cast("long")})
    tasks = min(n_buckets, _MAX_TASKS)
    d = d.repartitionById(tasks, (F.col("_bucket") % tasks).cast("int")).sortWithinPartitions("_bucket", "_key", "_copy").drop("_copy", "_key")
    d = materialise(d.mapInArrow(lambda b: _shuffle_buckets(b, seed), d.schema), "shuffled", "zstd")
    counts = d.groupBy("_bucket").agg(F.count("*").alias("_n"))
    along = Window.orderBy("_bucket")  # a row per bucket, 2**22 at most
    counts = counts.select(
        "_bucket",
        (F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_ahead"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    counts = materialise(counts, "shuffle-offsets")
    d = d.join(F.broadcast(counts), "_bucket").withColumn("_at", F.col("_ahead") + F.col("_place"))
    d = d.withColumn("_shard", F.expr(f"cast((_at * {n_shards}) div _all as int)"))
    d = d.withColumn("_slot", F.expr(f"_at - (_shard * _all + {n_shards - 1}) div {n_shards}"))
    return d.select(
        *((F.map_from_entries(n) if is_map[c] else F.col(n)).alias(c) for c, n in names.items()),
        size.alias("_size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_crc"), "_shard", "_slot",
    )
