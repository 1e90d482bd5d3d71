"""Writes: null and equal orders, batches that are run again or break off, buckets that stay as they are."""

import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import quality as Q
from sparkfolio.operators import reports as M
from sparkfolio.operators import store as W
from sparkfolio.sources.recordstore import RecordStore, Written
from sparkfolio.storage import materialise

PARENT = "id long, source string, title string, url string, city string"
CHILD = "exhibition_id long, artist_name string, work_title string, year string"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def test_written_tables_leave_no_shuffle_files(spark):
    folders = [Path(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    files = lambda: {p for x in folders for p in x.rglob("shuffle_*")}
    before = files()
    dealt = spark.range(20_000).withColumn("k", F.col("id") % 7).repartition(5, "id")
    made = materialise(dealt, "dealt")
    for _ in range(20):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left
    assert made.count() == dealt.count() == 20_000
    other = materialise(dealt.groupBy("k").count(), "other")
    assert rows(other) == rows(dealt.groupBy("k").count())
    kept = dealt.groupBy("k").count()
    assert rows(kept) == rows(kept)  # other queries' files stay


def test_null_and_equal_orders(spark):
    old = spark.createDataFrame([], "id long, source string, title string, url string")
    new = spark.createDataFrame([(None, "s", "t", "u1"), (None, "s", "a", "u1"), (None, "s", "z", "u2"), (4, "s", "y", "u2")], old.schema)
    assert rows(W.insert_or_ignore(old, new, "id")) == [(4, "s", "y", "u2"), (None, "s", "a", "u1")]
    kept = spark.createDataFrame([(1, "b", None), (1, "a", None), (2, "d", 5), (2, "c", 5), (None, "e", 1)], "k long, v string, o int")
    for parts in (1, 5):
        assert rows(Q.keep_first(kept.repartition(parts), ["k"], "o")) == [(1, "a", None), (2, "c", 5), (None, "e", 1)]
        assert rows(W.last_writer_wins(kept.repartition(parts), "k", "o")) == [(1, "b", None), (2, "d", 5), (None, "e", 1)]
    odd = spark.createDataFrame([(1, {"a": 1}, None), (1, {"b": 2}, None)], "k long, m map<string,int>, o int")
    assert Q.keep_first(odd, ["k"], "o").first()["m"] == {"a": 1}


def files(path):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "records/batches" not in at}


@pytest.fixture
def store(spark, tmp_path):
    kind = lambda ddl: spark.createDataFrame([], ddl).schema
    return RecordStore.create(spark, str(tmp_path / "records"), kind(PARENT), kind(CHILD), n_buckets=4)


def batch(spark, ids, title="t"):
    p = spark.createDataFrame([(i, "s", title, f"u{i % 100}", None) for i in ids], PARENT)
    kids = spark.createDataFrame([(i, a, w, y) for i in ids for a, w, y in (("x", "1", "a"), ("x", "1", "b"), ("y", None, None), (None, "2", None), ("z", "3", None))], CHILD)
    return p, kids


def test_batches(spark, store):
    p, kids = batch(spark, [1, 2, 3, 101, 4])
    bad = spark.createDataFrame([(7, None, "t", "u7", None), (8, "s", None, "u8", None), (9, "s", "t", None, None)], PARENT)
    assert store.insert("a", p.union(bad), kids, "id").added == 4
    assert rows(store.read("parents"), "id") == [(1,), (2,), (3,), (4,)]
    assert rows(store.read("children")) == sorted([(i, *r) for i in (1, 2, 3, 4) for r in (("x", "1", "a"), ("z", "3", None))], key=str)
    before = files(store.path)
    assert store.insert("a", *batch(spark, [50]), "id") == Written() and files(store.path) == before
    assert store.insert("same", *batch(spark, [201, 2]), "id") == Written() and files(store.path) == before
    # One more url: files of one bucket change.
    assert store.insert("b", *batch(spark, [5]), "id") == Written(added=1, buckets=1)
    after = files(store.path)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert len({os.path.basename(x) for x in changed}) == 1 and all(after[f] == before[f] for f in before if os.path.dirname(f) not in changed)
    # The stored record and its children give way to the new ones.
    assert store.overwrite("c", *batch(spark, [102, 6], "new"), "id").removed == 1
    assert rows(store.read("parents"), "id", "title") == sorted([(1, "t"), (3, "t"), (4, "t"), (5, "t"), (6, "new"), (102, "new")], key=str)
    assert {r[0] for r in rows(store.read("children"), "exhibition_id")} == {1, 3, 4, 5, 6, 102}
    parent, art = store.record("u2")
    assert rows(parent, "id") == [(102,)] and len(rows(art)) == 2
    # Deletes cascade; the last record of a bucket takes the bucket along.
    assert store.delete("d", spark.createDataFrame([("u2",), ("u2",), ("none",), (None,)], "url string")).removed == 1
    assert store.delete_where("e", F.col("id") > 4).removed == 2
    assert store.delete_where("f", F.col("id") > 4) == Written()
    assert rows(store.read("parents"), "id") == [(1,), (3,), (4,)] and {r[0] for r in rows(store.read("children"), "exhibition_id")} == {1, 3, 4}
    report, done = store.update("g", {"city": F.concat(F.coalesce("city", F.lit("")), F.lit("x"))}, F.col("id") < 4, dry_run=True)
    assert rows(report) == [("u1", None, "x"), ("u3", None, "x")] and done.changed == 2 and rows(store.read("parents"), "city") == [(None,)] * 3
    _, done = store.update("g", {"city": F.concat(F.coalesce("city", F.lit("")), F.lit("x"))}, F.col("id") < 4)
    assert done.changed == 2 and done.buckets <= 2
    again, done = store.update("g", {"city": F.lit("y")})
    assert done == Written() and rows(again) == [] and rows(store.read("parents"), "id", "city") == [(1, "x"), (3, "x"), (4, None)]
    assert RecordStore(spark, store.path).n_buckets == 4 and store.delete_where("h", F.lit(True)).removed == 3
    assert rows(store.read("parents")) == [] == rows(store.read("children"))


@pytest.mark.parametrize(
    "kind,fails_at",
    [("insert", "children"), ("insert", "parents"), ("overwrite", "children"), ("overwrite", "parents"), ("delete", "children"), ("update", "parents"), ("overwrite", "mark")],
)
def test_a_batch_that_breaks_off_is_done_over(spark, store, monkeypatch, kind, fails_at):
    store.insert("a", *batch(spark, range(1, 9)), "id")
    run = {
        "insert": lambda: store.insert("b", *batch(spark, [2, 20, 21, 22]), "id"),
        "overwrite": lambda: store.overwrite("b", *batch(spark, [102, 3, 20], "new"), "id"),
        "delete": lambda: store.delete("b", spark.createDataFrame([("u1",), ("u5",)], "url string")),
        "update": lambda: store.update("b", {"city": F.concat(F.coalesce("city", F.lit("")), F.lit("x"))}),
    }[kind]
    write, mark = RecordStore._rewrite, RecordStore._mark

    def broken(self, table, df, touched):
        write(self, table, df, touched)
        if table == fails_at:
            raise OSError("lost")

    def no_mark(self, batch, done):
        if fails_at == "mark":
            raise OSError("lost")
        return mark(self, batch, done)

    with monkeypatch.context() as m:
        m.setattr(RecordStore, "_rewrite", broken)
        m.setattr(RecordStore, "_mark", no_mark)
        with pytest.raises(OSError, match="lost"):
            run()
    run()
    ids = {"insert": {*range(1, 9), 20, 21, 22}, "overwrite": {1, 102, *range(3, 9), 20}, "delete": {2, 3, 4, 6, 7, 8}, "update": set(range(1, 9))}[kind]
    assert {r[0] for r in rows(store.read("parents"), "id")} == ids == {r[0] for r in rows(store.read("children"), "exhibition_id")}
    assert store.read("parents").count() == len(ids) and store.read("children").count() == 2 * len(ids)
    assert {r[0] for r in rows(store.read("parents"), "city")} == {"x" if kind == "update" else None}


def test_cache(spark, store):
    put = lambda b, *r: store.put_cache(b, spark.createDataFrame(list(r), "cache_key string, result_json string, version long"))
    put("a", ("k", "1", 5), ("n", "1", None), ("m", "1", 1), (None, "x", 1), ("k", "0", 4))
    put("b", ("k", "2", 5), ("n", "2", None), ("m", "0", 0))
    assert put("b", ("k", "3", 9)) == Written()
    assert rows(store.read("cache")) == [("k", "2", 5), ("m", "1", 1), ("n", "2", None)]
    assert store.clear_cache("c").removed == 3 and rows(store.read("cache")) == []


def test_a_duplicate_report_lists_all_ids_of_a_group(spark):
    rows = spark.range(2500).select(F.col("id"), F.when(F.col("id") % 5 < 4, "Same").otherwise("Other").alias("title"), F.lit("k").alias("parser_key"))
    keys = ["parser_key", "title"]
    got = {r.place: r.line for r in M.exact_duplicate_report(Q.duplicate_groups(rows, keys), Q.duplicate_members(rows, keys)).collect()}
    assert got[3] == f"| `k` | Same | 2000 | {','.join(str(i) for i in range(2500) if i % 5 < 4)} |"
    assert got[4] == f"| `k` | Other | 500 | {','.join(str(i) for i in range(4, 2500, 5))} |" and len(got) == 5
