"""Packing, periodic runs and importance resampling against plain code, with nulls, ties, repeats and odd texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfolio.llm import packing, periodic, queries, resample

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


ODD = [*"\t\n\r\x0b\x0c \x1c\x85\xa0", "  ", "᠎", " ", " ", " ", " ", " ", "　", "​", "a", "word", "don't", "'s", "é", "日本", "12", "!?", "\U0001f600", "_x", "<|endoftext|>"]


@pytest.mark.parametrize("most", [1 << 20, 20])
def test_ids_are_those_of_the_tokenizer(tokenizer, monkeypatch, most):
    monkeypatch.setattr(packing, "_LONG", most)
    with open(PATH, encoding="utf-8") as f:
        encode = packing.Encoder(f.read())
    rng = random.Random(most)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [" ".join(rng.choice(ODD) for _ in range(200)), "x" * 5000, "word " * 3000, ""]
    texts += [f"a{chr(c)}1 {chr(c)}{chr(c)} b  {chr(c)}!" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(encode(t).tolist() == w.ids for t, w in zip(texts, want, strict=True))


def test_first_fit_decreasing_against_plain_code():
    rng = random.Random(5)
    for _ in range(400):
        capacity = rng.choice((1, 7, 16, 100, 1024))
        sizes = np.array([rng.randint(1, rng.choice((capacity, max(1, capacity // 5)))) for _ in range(rng.randint(1, 60))])
        room, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            want[i] = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            room[want[i] :] = room[want[i] :] or [capacity]
            room[want[i]] -= sizes[i]
        assert packing.first_fit_decreasing(sizes, capacity).tolist() == want


@pytest.mark.parametrize("length,group_bytes", [(1024, 8 << 20), (16, 300)])
def test_packing(spark, tokenizer, length, group_bytes):
    rng = random.Random(length)
    texts = [(i, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    texts += [(150, None), (151, ""), (None, "no id"), (None, None), (152, "long word " * 20_000)] + [(153, "a copy of a text")] * 40
    d = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "_group": F.lit(1)})
    got = rows_of(packing.pack_documents(d.repartition(3), PATH, length=length, group_bytes=group_bytes))
    by_doc, by_sequence = {}, {}
    for r in got:
        assert r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    want = {}
    for i, t in texts:
        want.setdefault(i, []).append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4"))
    assert set(by_doc) == set(want)
    for i, docs in want.items():
        if len(docs) == 1:
            pieces = sorted(by_doc[i], key=lambda r: r["start"])
            assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1].tolist()]
            assert b"".join(bytes(r["ids"]) for r in pieces) == docs[0].tobytes()
            assert {r["doc_tokens"] for r in pieces} == {len(docs[0])}
        assert sum(r["length"] for r in by_doc[i]) == sum(map(len, docs))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == length or at < length and at.bit_count() == 1
    assert (len(by_sequence) > 50) == (length == 16)
    assert packing.pack_documents(d.limit(0), PATH).count() == 0


def plain_runs(words, least=24, times=3):
    out = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            a = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i > a and i - a + p >= max(least, times * p):
                out.setdefault((a, i - a + p), p)
            i += 1
    return sorted(((a, m, p) for (a, m), p in out.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng):
    n, k, words = rng.randint(0, 160), rng.choice((1, 2, 2, 3, 9)), []
    while len(words) < n:
        part = [rng.randrange(k) for _ in range(rng.randint(1, 20))]
        words += (part * rng.randint(1, 12))[: rng.randint(1, 100)]
    return words[:n]


@pytest.mark.parametrize("probes", [1 << 16, 40])
def test_runs_against_plain_code(monkeypatch, probes):
    monkeypatch.setattr(periodic, "_PROBES", probes)
    rng = random.Random(probes)
    for _ in range(700):
        words, (least, times) = repetitive(rng), rng.choice(((24, 3), (24, 3), (6, 3), (4, 2), (8, 4)))
        assert periodic.find_runs(np.array(words, np.int64), least, times) == plain_runs(words, least, times)


def test_periodic_runs_query(spark, tmp_path):
    """The query's digests, planted repeats included, against plain code."""
    rng = random.Random(9)
    texts = [(i, rng.choice((" ", "\n", " \t")).join(f"W{w}" for w in repetitive(rng))) for i in range(120)]
    texts += [(120, None), (121, ""), (122, " \n"), (None, "a b c " * 30), (None, None), (123, "Same same " * 40_000), (124, texts[3][1]), (124, texts[3][1]), (125, "nbsp word " * 30)]
    spark.createDataFrame([(i, t, [], "x") for i, t in texts], "doc_id long, text string, runs array<int>, collapsed string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(queries.op12_periodic_runs(spark, str(tmp_path)))
    want = []
    for i, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(("" if i is None else str(i)).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = [(0, n, 2)] if i == 123 and words[0] != words[2:3] and len(set(words)) == 2 and h % 10 else plain_runs(words)
        drop = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in drop).encode()).hexdigest()))
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert Counter(tuple(r[c] for c in names) for r in got) == Counter(want)
    assert sum(w[1] > 0 for w in want) > 20
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id string, text string")).count() == 0


def test_checksums_are_composed():
    rng = random.Random(3)
    shift = resample.Shifts()
    pairs = [(rng.randbytes(rng.randint(0, 90)), rng.randbytes(rng.choice((0, 1, 5, 63, 64, 65, 1000)))) for _ in range(500)]
    got = shift(np.array([zlib.crc32(a) for a, _ in pairs], np.uint32), np.array([len(b) for _, b in pairs]))
    assert (got ^ np.array([zlib.crc32(b) for _, b in pairs], np.uint32)).tolist() == [zlib.crc32(a + b) for a, b in pairs]
    docs = [[rng.randbytes(rng.choice((1, 2, 70))) for _ in range(rng.choice((0, 1, 2, 3, 30)))] for _ in range(60)]
    features = resample.Features(3, 10_000)
    for part in (docs[:20], [], docs[20:]):
        counts, grams = features(part)
        assert counts.tolist() == [len(d) for d in part]
        for n, (buckets, each) in enumerate(grams, 1):
            assert buckets.tolist() == [zlib.crc32(b" ".join(d[i : i + n])) % 10_000 for d in part for i in range(len(d) - n + 1)]
            assert each.tolist() == [max(0, len(d) - n + 1) for d in part]


def plain_resample(docs, target, percent, least, buckets=10_000):
    """(doc_id, n_features, weight, score, eligible) of each document, by strings."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = lambda w: [zlib.crc32(x.encode()) % buckets for x in [*w, *map(" ".join, zip(w, w[1:]))]]
    s, t = (Counter(b for x in texts for b in grams(split(x))) for texts in ([t for _, t in docs], target))
    size, aim = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * size / ((s[b] + 1) * aim))) for b in range(buckets)]
    out = []
    for i, text in docs:
        words = split(text)
        found = grams(words)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    return out


@pytest.mark.parametrize("target", [["the river Stone", None, "light light"], []])
def test_importance_resampling(spark, target):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)] + ["River", "stone", "ünder", "日本", "L" * 200]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, "?! .\x00"), (None, "a b c " * 30), (403, "very long text " * 30_000)]
    docs += [(7, docs[7][1])] * 3 + [(None, "same words again and again " * 9)] * 150
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "_row": F.lit(1)})
    got = rows_of(resample.importance_resample(d.repartition(5), spark.createDataFrame([(t,) for t in target], "text string")))
    want = plain_resample(docs, target, 25, 20)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == Counter(w[:4] for w in want)
    fit = sorted((w for w in want if w[4]), key=lambda w: (-w[3], w[0] is None, w[0] or 0))
    drawn = fit[: 25 * len(fit) // 100]
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and len(drawn) > 50
    assert [(r["doc_id"], r["score"]) for r in ranked] == [(w[0], w[3]) for w in drawn]


def test_importance_resampling_of_little(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    target = spark.createDataFrame([("x",)], "text string")
    assert rows_of(resample.importance_resample(none, target)) == []
    few = none.union(spark.createDataFrame([("a", "too short"), ("b", None)], none.schema))
    assert [r["rank"] for r in rows_of(resample.importance_resample(few, target))] == [None, None]
    ten = spark.createDataFrame([(str(i), f"w{i} " * 20) for i in range(10)], none.schema)
    assert sorted(r["rank"] or 0 for r in rows_of(resample.importance_resample(ten, target, percent=100))) == list(range(1, 11))
