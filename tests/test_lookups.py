"""Row isolation, the search index and the page directory against plain code."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import analytics as A
from sparkfolio.operators import extraction as V
from sparkfolio.operators.isolation import call_apart, isolate, waits
from sparkfolio.operators.pages import PageDirectory
from sparkfolio.operators.searchindex import SearchIndex, grams_in
from sparkfolio.sources import files as S
from sparkfolio.sources.reportfile import batch_json, read_json_lines, write_lines


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_bad_part_is_halved_and_tried_again():
    calls = []

    def call(frame):
        calls.append(list(frame.x))
        if frame.x.isin([3, 77]).any():
            raise KeyError("bad" * 300)
        return frame

    done = list(call_apart(call, pd.DataFrame({"x": range(100)})))
    assert sorted(x for part, e in done if e is None for x in part.x) == [x for x in range(100) if x not in (3, 77)]
    assert [(part.x.tolist(), len(e), e[:9]) for part, e in done if e] == [([3], 500, "KeyError:"), ([77], 500, "KeyError:")]
    assert len(calls) < 35
    left, waited = [2], []

    def shaky(frame):
        if left[0]:
            left[0] -= 1
            raise TimeoutError("slow")
        return frame

    def wait(tried):
        waited.append(waits()(tried))
        return 0

    assert [e for _, e in call_apart(shaky, pd.DataFrame({"x": [1]}), 3, (TimeoutError,), wait)] == [None] and waited == [1.0, 2.0]
    left[0] = 2
    assert [e for _, e in call_apart(shaky, pd.DataFrame({"x": [1]}), 3, (ValueError,), wait)] == ["TimeoutError: slow"]


def test_isolate(spark):
    def call(frame):
        if (frame.v < 0).any() or frame.name.isna().any():
            raise ValueError("no")
        return pd.concat([frame, frame])[["id", "v"]].assign(big=2**60 + 1)

    data = [(i if i % 9 else None, f"n{i}" if i % 50 else None, float(-1 if i % 70 == 1 else i), {"a": i}) for i in range(400)] + [(5, "n", 1.0, None)] * 3
    d = spark.createDataFrame(data, "id long, name string, v double, extra map<string,int>").repartition(3)
    good, bad = isolate(d, call, "id long, v double, big long", ["id", "name"], batch_rows=64)
    want = [r for r in data if r[1] is not None and r[2] >= 0]
    assert rows(good) == sorted([(i, v, 2**60 + 1) for i, _, v, _ in want for _ in range(2)], key=str)
    assert rows(bad) == sorted([(i, n, "ValueError: no") for i, n, v, _ in data if n is None or v < 0], key=str)
    none, errors = isolate(d.limit(0), call, "id long, v double, big long", ["id"])
    assert none.count() == 0 == errors.count() and errors.columns == ["id", "error"]
    with pytest.raises(Exception, match="the function returned"):
        isolate(d, lambda f: f[["id"]], "id long, v double", ["id"])
    with pytest.raises(ValueError, match="taken"):
        isolate(d, call, "id long, _error string", ["id"])


def test_one_call_for_each_key(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def ask(text):
        calls.add(1)
        return '{"title": "T", "start_date": "2020-01-01"}' if "good" in text else "no answer"

    pages = [(f"u{i}", "s", "c", ("good text", "bad text", "good other")[i % 3]) for i in range(60)]
    cache = spark.createDataFrame([], "cache_key string, result_json string")
    told, fresh = V.cached_extract(spark.createDataFrame(pages, "url string, source string, city string, text string"), cache, ask)
    assert told.count() == 60 and told.filter("result_json IS NOT NULL").count() == 40 and fresh.count() == 2
    assert calls.value == 3


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(4)
    words = ["Rose", "stone", "ünder", "100%", "under_score", "a\\b", "Émile", "", "x", "Room 12"]
    text = lambda: rng.choice((None, "", " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))))
    parents = [(i, text(), text(), text()) for i in range(300)] + [(None, "Rose", None, None)]
    kids = [(rng.randrange(330), text(), text()) for _ in range(600)] + [(None, "Rose", "stone")]
    return spark.createDataFrame(parents, "id long, title string, concept string, city string"), spark.createDataFrame(kids, "exhibition_id long, artist_name string, work_title string")


def test_search_index(spark, records, tmp_path, monkeypatch):
    parents, kids = records
    index = SearchIndex.build(spark, str(tmp_path / "index"), parents, kids)
    assert grams_in("Ab%cdeF_gh") == ["cde", "def"]
    keys = ["rose", "ROSE STONE", "12", "100%", "r_s", "nde%sto", "a\\b", "émile", "Émile", "no such", "x", "ünder", "under_s"]
    want = {k: rows(A.search(parents.filter("id IS NOT NULL"), kids, k).select("id")) for k in keys}
    for most in (2000, 0):
        monkeypatch.setattr("sparkfolio.operators.searchindex._MOST_LISTED", most)
        for k in keys if most else keys[:3]:
            assert rows(SearchIndex(spark, index.path).search(k)) == want[k], k
    assert sum(map(bool, want.values())) > 8
    rare = index.candidates("under_score")
    assert rare.count() < 300 and index.candidates("x") is None and index.candidates("qqq").count() == 0


def test_page_directory(spark, tmp_path):
    rng = random.Random(2)
    data = [(i, None if i % 5 == 0 else f"20{rng.randint(10, 12)}", ("a", "b", None)[i % 3]) for i in range(1000)]
    df = spark.createDataFrame(data, "id long, day string, source string").repartition(4)
    pages = PageDirectory.build(spark, str(tmp_path / "pages"), df, [("day", True), ("id", True)], "source", part_rows=90)
    pages = PageDirectory(spark, pages.path)
    for group in (None, "a", "c"):
        want = sorted((r for r in data if group is None or r[2] == group), key=lambda r: (r[1] is None, [-ord(x) for x in r[1] or ""], -r[0]))
        assert pages.total(group).first()[0] == len(want)
        for limit, offset in ((20, 0), (1, 333), (95, 280), (30, len(want) - 7), (5, len(want) + 3), (7, 171)):
            assert [tuple(r) for r in pages.page(limit, offset, group).collect()] == want[max(offset, 0) : offset + limit]
    parts, _ = pages.parts_of(20, 900)
    assert 1 <= len(parts) <= 2
    none = PageDirectory.build(spark, str(tmp_path / "none"), df.limit(0), [("id", False)])
    assert none.page(5).count() == 0 and none.total().first()[0] == 0
    with pytest.raises(ValueError, match="no groups"):
        none.page(5, 0, "a")


def test_positions_over_many_files(spark, tmp_path):
    rng = random.Random(6)
    data = [(str(rng.randrange(40)), f"Show {i}", rng.choice(("Artist", "Curator", "")), f'N{i} "x"\ny') for i in range(900)]
    text = lambda rows: "ExhibitionID,ExhibitionTitle,ExhibitionRole,DisplayName,BeginDate\n" + "".join(f'{a},{b},{c},"{n.replace(chr(34), chr(34) * 2)}",1/2/2001\n' for a, b, c, n in rows)
    one, many = tmp_path / "one.csv", tmp_path / "many"
    many.mkdir()
    one.write_text(text(data))
    at = 0
    for k in range(50):
        n = rng.choice((0, 1, 5, 60)) if k < 49 else len(data)
        (many / f"f{k:02}.csv").write_text(text(data[at : at + n]))
        at += n
    for path in (one, many):
        rows = S.read_csv(spark, str(path))
        assert [r.DisplayName for r in rows.orderBy("pos").collect()] == [n for *_, n in data] and [r.pos for r in rows.orderBy("pos").collect()] == list(range(900))
    fold = lambda path: sorted(map(str, S.fold_exhibitions(S.read_csv(spark, str(path))).collect()))
    assert fold(many) == fold(one)


def test_report_files(spark, tmp_path):
    path = str(tmp_path / "r.md")
    lines = spark.createDataFrame([(i, f"line {i}" if i % 7 else None) for i in range(500)], "place long, line string").repartition(7)
    write_lines(lines, path)
    want = "".join(f"line {i}\n" if i % 7 else "\n" for i in range(500))
    assert open(path).read() == want
    with pytest.raises(FileExistsError):
        write_lines(lines, path)
    bad = lines.withColumn("line", F.when(F.col("place") == 400, F.raise_error(F.lit("no"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="no"):
        write_lines(bad, path, overwrite=True)
    assert open(path).read() == want
    with pytest.raises(Exception, match="no"):
        write_lines(bad, str(tmp_path / "other.md"))
    assert sorted(x.name for x in tmp_path.iterdir() if not x.name.endswith(".crc")) == ["r.md"]
    results = spark.createDataFrame([("b", False, 0, 'a "quoted" error'), ("a", True, 5, None), ("c", True, None, None)], "key string, success boolean, saved long, error string")
    write_lines(batch_json(results.repartition(3), "2024-01-01T00:00:00"), path, overwrite=True)
    told = json.loads(open(path).read())
    assert list(told) == ["timestamp", "dry_run", "total_parsers", "ok", "failed", "exhibitions_saved", "results"] and (told["ok"], told["failed"], told["exhibitions_saved"]) == (2, 1, 5)
    assert [r["key"] for r in told["results"]] == ["a", "b", "c"] and told["results"][1] == {"key": "b", "success": False, "saved": 0, "error": 'a "quoted" error'}
    write_lines(batch_json(results.limit(0), "x"), path, overwrite=True)
    assert json.loads(open(path).read())["results"] == []


def test_a_report_of_many_rows_is_json(spark, tmp_path):
    n, path = 60_000, str(tmp_path / "r.json")
    # Sorts of whole rows and of keys alone are cut into other numbers of parts.
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "400k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    kept = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        results = spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 7 != 0).alias("success"), F.lit(1).alias("saved"), F.concat(F.lit("e,"), F.sha2(F.col("id").cast("string"), 256)).alias("error"))
        write_lines(batch_json(results.repartition(8), "x"), path)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert [r["key"] for r in json.loads(open(path).read())["results"]] == list(range(n))
    head, rows = read_json_lines(spark, path, "total_parsers long, ok long", "key long, error string")
    assert [tuple(r) for r in head.collect()] == [(n, n - n // 7 - 1)] and rows.agg(F.sum("key"), F.count_if(F.length("error") == 66)).first()[:] == (n * (n - 1) // 2, n)
    for good, bad in (('"key":5,', '"key":5'), ('}\n  ]', '},\n  ]')):
        other = str(tmp_path / f"{len(bad)}.json")
        open(other, "w").write(open(path).read().replace(good, bad, 1))
        with pytest.raises(Exception):
            read = read_json_lines(spark, other, "total_parsers long", "key long")
            [x.collect() for x in read]
    write_lines(batch_json(results.limit(0), "x"), path, overwrite=True)
    head, rows = read_json_lines(spark, path, "total_parsers long", "key long")
    assert head.first()[0] == 0 == rows.count()


def test_pieces_grow_with_texts_not_with_records(spark, records, tmp_path):
    parents, kids = records
    shifted = parents.withColumn("id", F.col("id") + 1000), kids.withColumn("exhibition_id", F.col("exhibition_id") + 1000)
    one = SearchIndex.build(spark, str(tmp_path / "one"), parents, kids)
    two = SearchIndex.build(spark, str(tmp_path / "two"), parents.union(shifted[0]), kids.union(shifted[1]))
    pairs = lambda index: spark.read.parquet(f"{index.path}/pairs").count()
    assert pairs(one) == pairs(two) > 0
    found = [sorted(r[0] for r in index.search("rose stone").collect()) for index in (one, two)]
    assert found[0] and found[1] == sorted([*found[0], *(x + 1000 for x in found[0])])
