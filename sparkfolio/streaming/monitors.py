"""Monitors of the run log as streams: state by parser, the same verdicts as the batch forms whatever the order of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sparkfolio.functions.scalars import percent
from sparkfolio.operators.store import last_of
from sparkfolio.session import ship_package

_TWO = "s1 long, i1 long, u1 long, s2 long, i2 long, u2 long"


def _last_two(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep a parser's two latest runs by (start, id); tell them when they change."""
    had = state.get if state.exists else (None,) * 6
    runs = {(had[k], had[k + 1]): had[k + 2] for k in (0, 3) if had[k + 1] is not None}
    for frame in frames:
        for s, i, u in zip(frame["started"], frame["id"], frame["urls"], strict=True):
            runs[int(s), int(i)] = None if pd.isna(u) else int(u)
            if len(runs) > 2:
                del runs[min(runs)]
    top = sorted(runs.items(), reverse=True)
    now = tuple(x for (s, i), u in top for x in (s, i, u)) + (None,) * (6 - 3 * len(top))
    if now != had:
        state.update(now)
        yield pd.DataFrame({"parser_key": [key[0]], **{c: pd.array([now[k]], "Int64") for c, k in (("started", 0), ("current", 2), ("previous", 5))}})


def watch_regressions(runs: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Of each parser whose last two real runs change: current and previous discoveries, drop_pct, and whether that is a regression.

    ``runs`` is a stream of the run log in any order; dry runs don't count,
    nor do rows without start, id or parser. State is two runs a parser. Write
    it in update mode: the latest row of a parser holds.
    """
    ship_package(runs.sparkSession)
    rows = runs.filter("run_type <> 'dry_run' AND started_at IS NOT NULL AND id IS NOT NULL AND parser_key IS NOT NULL")
    rows = rows.select("parser_key", F.unix_micros(F.col("started_at").cast("timestamp")).alias("started"), "id", F.col("urls_discovered").alias("urls"))
    kind = "parser_key string, started long, current long, previous long"
    out = rows.groupBy("parser_key").applyInPandasWithState(_last_two, kind, _TWO, "update", GroupStateTimeout.NoTimeout)
    worse = F.coalesce((F.col("previous") > 0) & (F.col("current") < ratio * F.col("previous")), F.lit(False))
    drop = F.when(worse, percent(F.col("previous") - F.col("current"), F.col("previous")))
    return out.select("parser_key", F.timestamp_micros("started").alias("at"), "current", "previous", worse.alias("regressed"), drop.alias("drop_pct"))


def _stale_after(micros: int):
    def tell(key: tuple, last: int, stale: bool) -> pd.DataFrame:
        return pd.DataFrame({"parser_key": [key[0]], "last": [last], "stale": [stale]})

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, told = state.get if state.exists else (None, None)
        if state.hasTimedOut:
            state.update((last, True))
            yield tell(key, last, True)
            return
        for frame in frames:
            if len(frame):
                last = max(int(frame["started"].max()), -(1 << 62) if last is None else last)
        due = (last + micros) // 1000
        stale = due <= state.getCurrentWatermarkMs()
        state.update((last, stale))
        if not stale:
            state.setTimeoutTimestamp(due)
        yield tell(key, last, stale)

    return follow


def watch_staleness(runs: DataFrame, days: float, delay: str = "1 hour") -> DataFrame:
    """Of each parser: its last run and whether the log has moved on by more than ``days`` since.

    A timer of event time marks a parser stale when the watermark (the latest
    start seen, less ``delay``) passes its last run by ``days``; a run marks it
    alive. Runs that come later than ``delay`` after younger ones of any
    parser are left out. State is a number a parser. Write it in update mode.
    """
    ship_package(runs.sparkSession)
    rows = runs.filter("started_at IS NOT NULL AND parser_key IS NOT NULL")
    rows = rows.withColumn("started_at", F.col("started_at").cast("timestamp")).withWatermark("started_at", delay)
    rows = rows.select("parser_key", "started_at", F.unix_micros("started_at").alias("started"))
    out = rows.groupBy("parser_key").applyInPandasWithState(
        _stale_after(int(days * 86_400_000_000)), "parser_key string, last long, stale boolean", "last long, stale boolean", "update", GroupStateTimeout.EventTimeTimeout
    )
    return out.select("parser_key", F.timestamp_micros("last").alias("at"), "stale")


def keep_verdicts(verdicts: DataFrame, path: str) -> StreamingQuery:
    """Write a stream of verdicts to ``path``, all that is there to be read, then stop; started again it goes on where it was.

    A micro-batch writes a partition of its own, and writes it anew if it is
    run again after a failure, so each verdict is there once.
    """
    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/verdicts/batch={batch}")

    writer = verdicts.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    return writer.foreachBatch(write).start()


def latest_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """The verdict that holds for each parser: the one of the last micro-batch."""
    return last_of(spark.read.parquet(f"{path}/verdicts"), ["parser_key"], "batch").drop("batch")
