"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.llm.decontam import drop_contaminated
from sparkfolio.llm.jaccard import keep_one
from sparkfolio.llm.mixing import apply_mix
from sparkfolio.llm.quality import keep_good
from sparkfolio.llm.shuffle import ADDED, shuffle_into_shards
from sparkfolio.session import load_table
from sparkfolio.storage import drop_but_last, materialise, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, load_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.75."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return drop_contaminated(docs, load_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix of sources takes them."""
    return apply_mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot of a uniform shuffle; columns of these names are replaced."""
    d = shuffle_into_shards(docs.drop("shard", "slot"))
    return d.withColumns({"shard": F.col("_shard"), "slot": F.col("_slot")}).drop(*ADDED)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shards),
]

#: The classifier and the seeded shuffle aren't expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next reads it.

    When a stage's result is written, tables of its own and the result before
    it go.
    """
    docs, before = load_table(spark, sf_dir, "documents"), len(written)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage{i}")
            drop_but_last(spark, before)
    return docs
