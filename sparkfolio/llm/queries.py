"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfolio.llm import chat, decontam, hostrules, jaccard, licenses, lmscore, mixing, packing, periodic, quality, resample, shuffle, urls
from sparkfolio.llm.oracle import ORACLES
from sparkfolio.llm.text import WORD, fold_of, let
from sparkfolio.session import load_table

PROBE = r"\### Assistant: </turn> ok"


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.read_back(chat.format_windows(turns.unionByName(probe), budget=256, history=64))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(load_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_texts(load_table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(load_table(spark, sf_dir, "pages"), load_table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["stop"] - s["start"]))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _judged_hosts(docs: DataFrame, key: str) -> DataFrame:
    judged = hostrules.judge_hosts(hostrules.document_stats(docs, key))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged_hosts(load_table(spark, sf_dir, "documents"), "source")


def host_rules_of_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator with a source's texts of like length as a host, so that hosts differ."""
    section = F.least(F.lit(9), F.floor(F.length("text") / 200)).cast("string")
    docs = load_table(spark, sf_dir, "documents").withColumn("section", F.when(F.col("text").isNotNull() & F.col("source").isNotNull(), F.concat("source", F.lit(" "), section)))
    return _judged_hosts(docs, "section")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(load_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join("best_labels", ",").alias("best_labels"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(load_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    forest = quality.train_quality(docs, load_table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, forest)
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shuffle.shuffle_into_shards(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack_documents(load_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _repeating(doc_id: Column, text: Column) -> Column:
    """The text; that of one document in ten with its tail replaced by repeats of a part of it."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: words[F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")]), " ")).otherwise("")

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(f"({WORD})")), changed)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    found = periodic.periodic_runs(docs.select("doc_id", _repeating(F.col("doc_id"), F.col("text")).alias("text")))
    none = F.lit(None).cast(periodic.RUN)
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(longer(best, r), r).otherwise(best))  # runs stand by start and period
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.importance_resample(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# What SQL can express of operators whose method it can't: the same results, without the method's own columns.
def base_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and unigram scores of op3_lm_score."""
    return op3_lm_score(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 5).alias("base_score"))


def base_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts, paths, list rules and their verdicts of op4_url_rules."""
    out = op4_url_rules(spark, sf_dir)
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict"))


def base_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and phrases of op7_license_scan; and that its labels have the phrases'."""
    out = op7_license_scan(spark, sf_dir)
    kept = F.size(F.array_except(F.split("base_labels", ","), F.split(F.concat("labels", F.lit(",")), ","))) == 0
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", kept.alias("kept"))


def base_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bytes and slots of each shard of op10_sharding; bytes only over all."""
    out = op10_sharding(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("first"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots"), F.sum("size").alias("size"))
    total = F.sum("size").over(Window.partitionBy())
    return out.select("shard", "n", "first", "last", "slots", total.alias("total_size"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_windows, op2_source_mix, op3_lm_score, op4_url_rules, op5_decontamination,
        op6_host_rules, op7_license_scan, op8_jaccard_join, op9_quality, op10_sharding,
        op11_packing, op12_periodic_runs, op13_importance_resampling,
        base_lm_score, base_url_rules, base_license_scan, base_sharding, host_rules_of_sections,
    )
}
ORACLE_SQL = ORACLES
