"""Monitoring of a run log: id, parser_key, started_at, finished_at, urls_discovered, saved, error_message, run_type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.scalars import format_duration, percent, present


def latest_runs(runs: DataFrame, real_only: bool = True, strict: bool = True) -> DataFrame:
    """Each parser's run(s) at its latest start; ties all stay.

    ``strict`` keeps dry runs out altogether; without it a dry run that
    started in the same instant as the latest real one is kept too.
    """
    base = runs.filter(F.col("run_type") != "dry_run") if real_only else runs
    top = base.groupBy("parser_key").agg(F.max("started_at").alias("started_at"))
    return (base if strict else runs).join(top, ["parser_key", "started_at"])


def last_run(runs: DataFrame) -> DataFrame:
    """The run of highest id of each parser; a map-side maximum, not a sort."""
    cols = [c for c in runs.columns if c not in ("parser_key", "id")]
    best = runs.groupBy("parser_key").agg(F.max_by(F.struct("id", *cols), "id").alias("r"))
    return best.select("parser_key", "r.*")


def regressions(runs: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Parsers whose last real run found under ``ratio`` of the one before; only the top two per parser are kept by the window."""
    w = Window.partitionBy("parser_key").orderBy(F.desc("started_at"), F.desc("id"))
    r = runs.filter(F.col("run_type") != "dry_run").withColumn("rn", F.row_number().over(w)).filter("rn <= 2")
    two = r.groupBy("parser_key").agg(
        F.max(F.when(F.col("rn") == 1, F.col("urls_discovered"))).alias("current"),
        F.max(F.when(F.col("rn") == 2, F.col("urls_discovered"))).alias("previous"),
    )
    two = two.filter((F.col("previous") > 0) & (F.col("current") < ratio * F.col("previous")))
    return two.withColumn("drop_pct", percent(F.col("previous") - F.col("current"), F.col("previous")))


def failures(runs: DataFrame, limit: int = 20) -> DataFrame:
    return runs.filter(present("error_message")).orderBy(F.desc("started_at"), F.desc("id")).limit(limit)


def zero_saves(runs: DataFrame) -> DataFrame:
    return latest_runs(runs).filter((F.col("urls_discovered") > 0) & (F.col("saved") == 0))


def stale(runs: DataFrame, cutoff: str) -> DataFrame:
    """Parsers without a run since ``cutoff``, compared as timestamps."""
    last = runs.groupBy("parser_key").agg(F.max("started_at").alias("last_run"))
    return last.filter(F.col("last_run") < F.lit(cutoff).cast("timestamp"))


def history(runs: DataFrame, since: str | None = None, parser_key: str | None = None, failed: bool = False, limit: int = 50) -> DataFrame:
    out = runs
    if parser_key:
        out = out.filter(F.col("parser_key") == parser_key)
    if failed:
        out = out.filter(present("error_message"))
    if since:
        out = out.filter(F.col("started_at") >= F.lit(since).cast("timestamp"))
    out = out.withColumn("duration", format_duration("started_at", "finished_at"))
    return out.orderBy(F.desc("started_at"), F.desc("id")).limit(limit)


def counters(runs: DataFrame, status: Column) -> DataFrame:
    """Counts of each outcome over all rows."""
    s = runs.withColumn("_s", status)
    return s.agg(*(F.count_if(F.col("_s") == k).alias(k) for k in ("saved", "skipped", "failed")), F.count("*").alias("discovered"))


def alerts(runs: DataFrame, cutoff: str) -> DataFrame:
    """All monitors in one relation: kind, severity, parser_key."""
    kinds = (
        (failures(runs, 1 << 30), "failure", "error"),
        (zero_saves(runs), "zero_saves", "warn"),
        (regressions(runs), "regression", "warn"),
        (stale(runs, cutoff), "stale", "info"),
    )
    parts = [df.select(F.lit(k).alias("kind"), F.lit(s).alias("severity"), "parser_key") for df, k, s in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("kind", "severity", "parser_key").agg(F.count("*").alias("n"))
