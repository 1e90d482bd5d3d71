"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.llm.text import WORD
from sparkfolio.storage import materialise

#: 2**32 divided by the golden ratio: slot i sits at the point i * GOLDEN mod 2**32.
GOLDEN = 2654435769
#: Least blocks of a source (one per word if it has fewer); sources with no more get exactly their slots.
MIN_BLOCKS = 64


def source_plan(sized: DataFrame, most_repeats: int, min_slots: int, max_block: int) -> DataFrame:
    """One row per source: weight, target, blocks and its range of schedule positions.

    ``sized`` has source and size. The table has a row per source, so its
    windows without a key see sources, never documents.
    """
    everything = Window.partitionBy()
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    s = s.withColumn("weight", (F.col("source_id") - 1) % 3 + 1).withColumn("total", F.sum("source_size").over(everything))
    # Water filling: in the order of cap / weight, a source is capped while its cap stays at or
    # under the level that the sources before it leave.
    s = s.withColumn("cap", most_repeats * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "source_id").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("capped", F.col("ratio") <= (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
    cap_sum = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    weight_sum = F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything), F.lit(0))
    level = (F.col("total") - cap_sum).cast("double") / F.nullif(weight_sum, F.lit(0))
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight")))
    s = s.withColumn("slot_words", F.expr(f"least({max_block}L, greatest(1L, total div {min_slots}))"))
    least = f"least(source_size, {MIN_BLOCKS}L)"
    s = s.withColumn("blocks", F.expr(f"greatest(1L, {least}, (source_size + slot_words - 1) div slot_words)"))
    s = s.withColumn("block_words", F.expr("greatest(1L, (source_size + blocks - 1) div blocks)"))
    s = s.withColumn("blocks", F.expr("greatest(1L, (source_size + block_words - 1) div block_words)"))
    s = s.withColumn(
        "slots", F.expr("case when source_size = 0 then 0L else cast(ceil(target * blocks / source_size) as bigint) end")
    )
    by_id = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("first_slot", F.sum("slots").over(by_id) - F.col("slots"))
    return s.select("source", "source_id", "source_size", "target", "blocks", "block_words", "slots", "first_slot")


def schedule(plan: DataFrame, most_repeats: int, n_slots: int, chunk: int = 1024) -> DataFrame:
    """Slots in order, each with its source, the block it reads and which pass over the source that is.

    Slot i falls at the golden-ratio point of i among the cumulative slot
    weights; its rank among its source's slots picks the block. Ranks come
    from counts per chunk of slots, so no task sees all slots of a source.
    Slots beyond ``most_repeats`` passes stay empty. The points can miss a
    short range by a few slots, so a source of at most ``MIN_BLOCKS`` blocks
    leaves slots beyond its own number empty and reads those that it is short
    of after all others.
    """
    spark = plan.sparkSession
    span = 65536
    plan = plan.withColumn("most", F.expr(f"case when blocks <= {MIN_BLOCKS} then slots else {most_repeats} * blocks end"))
    places = plan.filter("slots > 0").select(
        "source_id",
        "blocks",
        "most",
        "first_slot",
        "slots",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {span}"))).alias("part"),
    )
    places = places.select(
        "source_id",
        "blocks",
        "most",
        F.explode(
            F.expr(f"sequence(first_slot + part * {span}, first_slot + least(slots, (part + 1) * {span}) - 1)")
        ).alias("place"),
    )
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.expr(f"shiftright(((id * {GOLDEN}L) % 4294967296L) * {n_slots}L, 32)").alias("place")
    )
    s = slots.join(places, "place").withColumn("chunk", F.expr(f"slot div {chunk}"))
    upto = Window.partitionBy("source_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = s.groupBy("source_id", "chunk").agg(F.count("*").alias("n"))
    got = counts.groupBy("source_id").agg(F.sum("n").alias("n"))
    counts = counts.select("source_id", "chunk", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source_id", "chunk").orderBy("slot")
    s = s.withColumn("rank", F.row_number().over(inside) - 1).join(counts, ["source_id", "chunk"])
    s = s.withColumn("rank", F.col("rank") + F.col("ahead")).filter("rank < most")
    short = plan.filter(f"blocks <= {MIN_BLOCKS}").join(got, "source_id", "left").filter("coalesce(n, 0L) < slots")
    short = short.withColumn("rank", F.explode(F.expr("sequence(coalesce(n, 0L), slots - 1)")))
    short = short.withColumn("slot", n_slots + F.col("first_slot") + F.col("rank"))
    columns = ["slot", "source_id", "blocks", "rank"]
    s = s.select(columns).union(short.select(columns))
    return s.select("slot", "source_id", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("pass"))


def mix_sources(
    docs: DataFrame, most_repeats: int = 3, min_slots: int = 65536, max_block: int = 1 << 20, bucket_words: int = 1 << 26
) -> DataFrame:
    """How many words of each document a weighted mix of sources takes.

    Sources in code-point order (null last) weigh 1, 2, 3, repeating, and
    share all words; none gets more than ``most_repeats`` times its own.
    Each source's documents, shuffled by the md5 of doc_id, form one stream
    of words cut into equal blocks, at least ``MIN_BLOCKS`` (or one per word);
    the schedule's slots read the blocks in turn, over again when they run
    out. A word counts once per block read.

    Returns doc_id, source, size, source_size, target, taken - a row per
    input row. Null text has size 0 and is taken 0 times; ties of md5 order
    by doc_id and size; repeated rows count each; empty input gives no rows;
    other columns of ``docs`` are ignored.
    """
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = materialise(sized, "mix-sizes")
    plan = materialise(source_plan(sized, most_repeats, min_slots, max_block), "mix-plan")
    n_slots = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    d = sized.join(plan.withColumnRenamed("source", "plan_source"), F.col("source").eqNullSafe(F.col("plan_source")))
    d = d.select("doc_id", "source", "size", "source_id", "source_size", "target", "blocks", "block_words", key.alias("md5"))
    # Buckets of a source follow its size: one for each ``bucket_words`` words, 256 at least.
    buckets = F.greatest(F.lit(256).cast("long"), F.expr(f"source_size div {bucket_words}"))
    d = d.withColumn("bucket", F.conv(F.substring("md5", 1, 8), 16, 10).cast("long") % buckets)
    upto = Window.partitionBy("source_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy("source_id", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.select("source_id", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source_id", "bucket").orderBy("md5", F.col("doc_id").asc_nulls_first(), "size")
    d = d.withColumn("nth", F.row_number().over(inside)).withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    d = d.join(sums, ["source_id", "bucket"]).withColumn("start", F.col("start") + F.col("ahead"))
    d = d.withColumn("block", F.explode(F.expr("sequence(start div block_words, greatest(start, start + size - 1) div block_words)")))
    d = d.withColumn("words", F.expr("greatest(0L, least(start + size, (block + 1) * block_words) - greatest(start, block * block_words))"))
    reads = schedule(plan, most_repeats, n_slots).groupBy("source_id", "block").agg(F.count("*").alias("reads"))
    d = d.join(reads, ["source_id", "block"], "left")
    taken = F.coalesce(F.sum(F.col("words") * F.coalesce("reads", F.lit(0))), F.lit(0)).alias("taken")
    d = d.groupBy("source_id", "bucket", "nth", "doc_id", "source", "size", "source_size", "target").agg(taken)
    return d.select("doc_id", "source", "size", "source_size", "target", "taken")


def apply_mix(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, rounded to whole documents.

    Rows that share a doc_id share the rounded mean. Rows without a word
    weigh nothing and are kept once. Columns are those of ``docs``.
    """
    mix = mix_sources(docs, **params).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    mix = mix.select(
        F.col("doc_id").alias("_mix_id"),
        F.expr("case when size = 0 then 1 else cast(floor(taken / size + 0.5) as int) end").alias("_mix_copies"),
    )
    named = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # no name can clash
    key = named[f"c{docs.columns.index('doc_id')}"]
    out = named.join(mix, key.eqNullSafe(mix["_mix_id"])).filter("_mix_copies > 0")
    out = out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
    return out.select(*named.columns).toDF(*docs.columns)
