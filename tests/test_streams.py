"""Streams over files: the run log's monitors with restarts, first sights of urls, windows and sessions."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import runlog as R
from sparkfolio.streaming import monitors as M
from sparkfolio.streaming import runs as ST

LOG = "id long, parser_key string, started_at timestamp, urls_discovered long, run_type string"


def run_rows(n=400, seed=3):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return [(i, f"p{rng.randrange(25)}", start + dt.timedelta(minutes=rng.randrange(20_000)), rng.choice((None, 0, 5, 50, 100)), rng.choice(("full", "full", "dry_run"))) for i in range(n)]


def landed(spark, folder, rows, kind, parts):
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], kind).coalesce(1).write.mode("append").parquet(folder)


def verdicts(spark, stream, path):
    M.keep_verdicts(stream, path).awaitTermination()
    return M.latest_verdicts(spark, path)


def test_regressions_in_any_order_and_after_a_failure(spark, tmp_path, monkeypatch):
    rows, folder, path = run_rows(), str(tmp_path / "log"), str(tmp_path / "out")
    odd = [(900, None, rows[0][2], 5, "full"), (None, "p1", rows[0][2], 5, "full"), (901, "p2", None, 5, "full")]
    read = lambda: M.watch_regressions(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder))
    landed(spark, folder, rows[:200] + odd, LOG, 2)
    verdicts(spark, read(), path)
    landed(spark, folder, rows[200:], LOG, 2)
    # The sink breaks after a micro-batch is written: it is done over when the stream is started again.
    from pyspark.sql import DataFrameWriter

    write, left = DataFrameWriter.parquet, [1]

    def broken(self, to, *args, **kw):
        write(self, to, *args, **kw)
        if "verdicts/batch=" in to and left:
            left.pop()
            raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", broken)
        with pytest.raises(Exception, match="lost"):
            M.keep_verdicts(read(), path).awaitTermination()
    got = verdicts(spark, read(), path)
    log = spark.createDataFrame(rows, LOG)
    cols = ("parser_key", "current", "previous", "drop_pct")
    assert sorted(map(tuple, got.filter("regressed").select(*cols).collect())) == sorted(map(tuple, R.regressions(log).select(*cols).collect()))
    assert got.count() == len({r[1] for r in rows if r[4] == "full"}) and got.filter("regressed").count() > 2


def test_staleness_by_timers(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    day = lambda d: start + dt.timedelta(days=d)
    folder, path = str(tmp_path / "log"), str(tmp_path / "out")
    read = lambda: M.watch_staleness(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(folder), 7)
    landed(spark, folder, [(1, "a", day(0), 1, "full"), (2, "b", day(1), 1, "full"), (3, "c", day(5), 1, "full"), (4, None, day(5), 1, "full"), (5, "c", None, 1, "full")], LOG, 1)
    state = lambda: {r.parser_key: r.stale for r in verdicts(spark, read(), path).collect()}
    assert state() == {"a": False, "b": False, "c": False}
    landed(spark, folder, [(6, "c", day(9), 1, "full")], LOG, 1)
    assert state() == {"a": True, "b": True, "c": False}
    landed(spark, folder, [(7, "a", day(10), 1, "full"), (8, "d", day(30), 1, "full")], LOG, 1)
    assert state() == {"a": True, "b": True, "c": True, "d": False}


def test_new_urls(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(f"u{i % 9}", start + dt.timedelta(minutes=i)) for i in range(60)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:30], rows[30:]):
        landed(spark, folder, part, "url string, ts timestamp", 1)
        stream = spark.readStream.schema("url string, ts timestamp").parquet(folder)
        writer = ST.new_urls(stream).writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
        writer.format("parquet").start(out).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == [f"u{i}" for i in range(9)]


def test_windows_and_sessions_as_streams(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(i, i % 3, "click" if i % 2 else "view", start + dt.timedelta(minutes=7 * i + 300 * (i // 70))) for i in range(300)]
    kind = "event_id long, user_id long, event_type string, ts timestamp"
    folder = str(tmp_path / "in")
    landed(spark, folder, rows, kind, 1)
    stream = spark.readStream.schema(kind).parquet(folder)
    for name, f in (("windows", lambda df: ST.windowed_counts(df)), ("sessions", lambda df: ST.sessions(df))):
        out = str(tmp_path / name)
        f(stream).writeStream.outputMode("append").option("checkpointLocation", out + "-check").trigger(availableNow=True).format("parquet").start(out).awaitTermination()
        whole = f(spark.createDataFrame(rows, kind))
        end = F.col("window_start") + F.expr("INTERVAL 1 DAY") if name == "windows" else F.col("session_end")
        closed = whole.filter(end <= F.lit(rows[-1][3] - dt.timedelta(hours=1)).cast("timestamp"))
        assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, closed.collect())) != []


def test_a_feed_gives_each_record_once(spark, tmp_path):
    """Pages that grow, a sink that breaks, restarts; new records are what isn't stored yet."""
    from sparkfolio.operators.store import skip_existing
    from sparkfolio.sources.rest import RestFeed

    spark.dataSource.register(RestFeed)
    pages, out, check = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "check")
    pages.mkdir()

    def publish(n, size=10):
        last = -(-n // size)
        for k in range(1, last + 1):
            items = [{"url": f"u{i}"} for i in range((k - 1) * size, min(n, k * size))]
            (pages / f"{k}.json").write_text(json.dumps({"data": items, "pagination": {"total_pages": last}}))

    fails = []

    def store(df, batch):
        found = df.select(F.get_json_object("record", "$.url").alias("url"), "page", "place")
        found.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        if fails:
            raise OSError(fails.pop())

    def run(where=check, **options):
        stream = spark.readStream.format("rest_feed").options(url=f"file://{pages}/{{page}}.json", total="pagination.total_pages", **options).load()
        stream.writeStream.foreachBatch(store).option("checkpointLocation", where).trigger(availableNow=True).start().awaitTermination()

    publish(7)
    run()
    publish(34)
    fails.append("lost")
    with pytest.raises(Exception, match="lost"):
        run()
    publish(36)
    run()
    run()
    publish(50)
    run()
    stored = spark.read.parquet(out)
    assert sorted(r.url for r in stored.collect()) == sorted(f"u{i}" for i in range(50))
    fresh, old = skip_existing(spark.createDataFrame([("u3",), ("u50",)], "url string"), stored)
    assert [r.url for r in fresh.collect()] == ["u50"] and old.count() == 1
    out = str(tmp_path / "later")
    run(str(tmp_path / "check2"), page="3", place="4")
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == [f"u{i}" for i in range(24, 50)]
