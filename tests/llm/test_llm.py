"""Operators on small tables with nulls, empty and long texts, ties, repeats, and against brute force."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkfolio import storage
from sparkfolio.llm import chat, decontam, hostrules, jaccard, licenses, lmbits, lmscore, mixing, quality, shuffle, urls
from sparkfolio.llm import text as llm_text

DOC = "doc_id long, text string, lang string, source string, n_chars long, rid long, size long"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def corpus(seed=3, n=160):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.5:
            words = (rng.choice(docs)[1] or "").split(" ")
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        else:
            words = [rng.choice(vocab) for _ in range(rng.randint(1, 90))]
        docs.append((i, " ".join(words)))
    docs += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "a b c"), (n + 4, "A  b c"), (n + 5, docs[0][1]), (n + 5, docs[0][1]), (None, "x y z q r s")]
    docs.append((n + 6, "long " * 30_000))
    return [(i, t, "en", None if (i or 0) % 7 == 0 else f"s{(i or 0) % 5}", 0, 1, 2) for i, t in docs]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOC).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_chat_round_trip_and_budget(spark):
    rng = random.Random(1)
    rows = []
    for c in range(12):
        n = rng.randint(1, 60)
        for t in range(n):
            role = "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2]
            text = rng.choice([None, "", "</turn>\n<turn:user>", "a\\b \\l > <", "word " * rng.randint(1, 120), "é " * 9])
            rows.append((c, t, role, text, "extra"))
    rows += [(None, None, None, None, ""), (99, 1, "assistant", "tie", ""), (99, 1, "assistant", "tie", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    wins = chat.format_windows(df, budget=200, history=40)
    got = {r["conv_id"]: r for r in rows_of(chat.read_back(wins))}
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    over = 0
    for w in rows_of(wins):
        turns = w["text"].split("</turn>\n")[:-1]
        sizes = [len(x.split(">", 1)[1].encode().split()) + 3 for x in turns]
        assert w["n_tokens"] == sum(sizes)
        if sum(sizes) > 200:  # a system turn and one new turn alone exceed the budget, and nothing else is repeated
            over += 1
            lead = turns[0].startswith("<turn:system>")
            assert len(turns) == 1 + lead and w["n_repeated"] <= lead
    assert over < 12
    assert any(w["n_repeated"] for w in rows_of(wins))
    assert chat.read_back(chat.format_windows(df.limit(0))).count() == 0


@pytest.mark.parametrize("system", [0, 100, 150, 159, 400])
def test_chat_repeats_history_after_a_long_system_turn(spark, system):
    rng = random.Random(system)
    sizes = [rng.choice((1, 2, 9, 30, 90)) for _ in range(60)]
    rows = [(1, 0, "system", "s " * system)] + [(1, 1 + i, "user", f"t{i} " * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wins = sorted(rows_of(chat.format_windows(df, budget=200, history=40)), key=lambda w: w["window"])
    new = told = 0
    for w in wins:
        texts = w["text"].split("</turn>\n")[:-1]
        fresh = len(texts) - w["n_repeated"]
        if w["window"]:
            fits = 0  # turns before this window that fit in the history together
            room = min(40, 200 - (system + 3) - sum(n + 3 for n in sizes[new : new + fresh]))
            while new - 1 - fits >= 0 and sum(n + 3 for n in sizes[new - 1 - fits : new]) <= room:
                fits += 1
            assert w["n_repeated"] == 1 + fits and texts[0].startswith("<turn:system>")
            assert [x.split(">")[1].split(" ")[0] for x in texts[1 : 1 + fits]] == [f"t{i}" for i in range(new - fits, new)]
            assert w["n_tokens"] == system + 3 + sum(n + 3 for n in sizes[new - fits : new + fresh]) and (w["n_tokens"] <= 200 or fresh == 1 and not fits)
            told += fits
            new += fresh
        else:
            new += fresh - 1
    assert new == 60 and (told > 5) == (system < 190)


@pytest.mark.parametrize("budget,history", [(2048, 256), (256, 64)])
def test_chat_windows_over_long_conversations_against_sql(spark, tmp_path, budget, history):
    """The oracle on conversations of many windows, with long system turns."""
    duckdb = pytest.importorskip("duckdb")
    from sparkfolio.llm.oracle import chat_sql

    rng = random.Random(5)
    rows = []
    for c in range(8):
        if c % 2:
            rows.append((c, 0, "system", "s " * ((0, 40, 0, 1700, 0, 2100, 0, 900)[c] * budget // 2048)))
        rows += [(c, 1 + i, ("user", "assistant")[i % 2], f"t{i} <" + "w " * max(1, rng.choice((1, 20, 200, 900, 2500)) * budget // 2048)) for i in range(rng.randint(1, 40))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    probe = spark.createDataFrame([(-7, t, r, r"\### Assistant: </turn> ok") for t, r in enumerate(("user", "assistant"))], df.schema)
    windows = chat.format_windows(df.union(probe), budget, history)
    assert windows.count() > 40 and windows.filter("n_repeated > 1").count() > 10
    got = rows_of(chat.read_back(windows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cur = con.execute(chat_sql(budget, history))
    names = [x[0] for x in cur.description]
    want = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
    by_id = lambda rows: sorted(rows, key=lambda r: r["conv_id"])
    assert by_id(got) == by_id(want)


def test_mix(spark, docs, empty):
    got = rows_of(mixing.mix_sources(docs))
    assert len(got) == docs.count()
    total = sum(r["size"] for r in got)
    targets, taken = {}, Counter()
    for r in got:
        targets[r["source"]] = (r["target"], r["source_size"])
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sum(t for t, _ in targets.values()) == pytest.approx(total)
    for s, (t, size) in targets.items():
        assert t <= 3 * size + 1e-9
        assert abs(taken[s] - t) <= max(20, 0.02 * t)
    again = sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rows_of(mixing.mix_sources(docs)))
    assert again == sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in got)
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.apply_mix(docs).columns == docs.columns


def test_mix_takes_small_sources_whole(spark):
    rows = [(0, "hot " * 700_000, "hot")] + [(100 + i, "tail " * (1 + i), f"t{i:03}") for i in range(70)] + [(900 + i, "none " * 3, None) for i in range(5)]
    got = rows_of(mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)))
    assert len(got) == len(rows)
    assert all(r["target"] == 3 * r["source_size"] and r["taken"] == 3 * r["size"] for r in got if r["doc_id"])
    # More sources than slots of the whole: none is dropped, and each takes its quota to the slot.
    plan = mixing.source_plan(spark.createDataFrame([(f"s{i}", 1 + i % 3) for i in range(3000)], "source string, size long"), 3, 1024, 1 << 20)
    n_slots = plan.agg(F.sum("slots")).first()[0]
    slots = mixing.schedule(plan, 3, n_slots)
    assert slots.select("slot").distinct().count() == slots.count()
    reads = {r["source_id"]: r["count"] for r in rows_of(slots.groupBy("source_id").count())}
    assert all(reads[r["source_id"]] == r["slots"] for r in rows_of(plan))


def test_lm_score(spark, docs, empty):
    got = rows_of(lmscore.score_texts(docs, head_bound=20))
    data = corpus()
    words = {i: ((t or "").encode().lower().split(), i) for i, (_, t, *_rest) in enumerate(data)}
    fold = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10
    counts = Counter()
    for i, (d, *_rest) in enumerate(data):
        if fold(d):
            counts.update(words[i][0])
            counts[lmscore.END] += 1
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, (d, *_rest) in enumerate(data):
        toks = [*words[i][0], lmscore.END]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in toks)
        want[d, len(toks), sum(counts[t] > 0 for t in toks), round(base, 6)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 and r["held_out"] == (fold(r["doc_id"]) == 0) for r in got)
    assert lmscore.score_texts(empty).count() == 0


def test_lm_score_does_not_depend_on_layout_or_head(spark, docs):
    def scores(d, **params):
        return sorted((r["doc_id"] or -1, r["n_tokens"], r["score"], r["bits_per_byte"]) for r in rows_of(lmscore.score_texts(d, **params)))

    want = scores(docs)
    for got in (scores(docs.repartition(1)), scores(docs.repartition(7, "lang", "text")), scores(docs, head_bound=3)):
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert max(abs(x - y) for a, b in zip(got, want, strict=True) for x, y in zip(a[2:], b[2:], strict=True)) < 1e-6


def test_lm_score_tells_copies_and_word_order(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(30, 200)))) for i in range(120)]
    fold = lambda d: zlib.crc32(str(d).encode()) % 10
    twin = next(t for i, t in rows if fold(i) and len(t) > 400)
    words = twin.split()
    rng.shuffle(words)
    held = next(i for i in range(1000, 2000) if not fold(i))
    other = next(i for i in range(held + 1, 2000) if not fold(i))
    trained = next(i for i in range(1000, 2000) if fold(i))
    rows += [(held, twin), (other, " ".join(words))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows_of(lmscore.score_texts(d))}
    assert got[held]["score"] > 0.3 * got[other]["score"]  # its runs are known; those of the shuffled words aren't
    assert got[held]["base_score"] == pytest.approx(got[other]["base_score"])
    once = {r["doc_id"]: r["score"] for r in got.values() if r["n_tokens"] > 40}
    assert got[held]["score"] / got[held]["n_tokens"] > max(s / got[i]["n_tokens"] for i, s in once.items() if i != held)
    # A training text doesn't know itself, only its copy.
    alone = {r["doc_id"]: r["score"] for r in rows_of(lmscore.score_texts(spark.createDataFrame([*rows[:-2], (trained, " ".join(words))], d.schema)))}
    both = {r["doc_id"]: r["score"] for r in rows_of(lmscore.score_texts(spark.createDataFrame([*rows[:-2], (trained, twin)], d.schema)))}
    assert both[trained] > 0.3 * alone[trained]
    bits = got[held]["score"] * -math.log2(10) / (len(twin.encode()) + 1)
    assert got[held]["bits_per_byte"] == pytest.approx(bits)


def test_lm_runs_against_plain_code():
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(9)], k=n)).encode() for n in (0, 1, 2, 3, 4, 60, 300)] * 2 + [None, b"A a\n B"]
    t = lmscore.read_tokens(texts)
    q = lmscore.read_runs(t)
    found = {(int(x), int(p - t.first[x])): (int(a), int(r), int(o), int(n), bool(s)) for p, x, a, r, o, n, s in zip(q.place, q.text, q.anchor, q.run, q.own, q.times, q.alike, strict=True)}
    told = 0
    by_anchor, by_run = {}, {}
    for x, raw in enumerate(texts):
        words = [*(raw or b"").lower().split(), lmscore.END]
        assert t.first[x + 1] - t.first[x] == len(words)
        seen = Counter()
        for i, w in enumerate(words):
            assert t.before[t.first[x] + i] == seen[w]
            seen[w] += 1
        assert [w.as_py() for w in t.words(np.arange(t.first[x], t.first[x + 1]))] == words
        places = sorted(p for y, p in found if y == x)
        assert (places[0] == 3 if len(words) > 3 else not places)
        runs = [(p, tuple(words[p - 3 : p]), tuple(words[p:stop])) for p, stop in zip(places, [*places, len(words)][1:], strict=True)]
        last = {}
        for p, context, run in runs:
            a, r, own, times, alike = found[x, p]
            context = (p == 3, context)
            assert by_anchor.setdefault(a, context) == context and by_run.setdefault(r, run) == run
            want = lmscore.NONE if a not in last else lmscore.OWN_HIT if last[a] == run else lmscore.OWN_MISS
            mine = [z for y, c, z in runs if ((y == 3), c) == context]
            assert (own, times, alike) == (want, len(mine), len(set(mine)) == 1)
            last[a] = run
            told += own != lmscore.NONE
    assert told > 5 and len(by_anchor) == len(set(by_anchor.values()))


def test_lm_online_mixing_against_plain_code():
    rng = np.random.default_rng(3)
    sizes, block, gates = [0, 1, 7, 30, 4], 3, 2
    first = np.concatenate([[0], np.cumsum(sizes)])
    x, bits, gate = rng.normal(0, 2, (first[-1], 3)), rng.integers(0, 2, first[-1]).astype(bool), rng.integers(0, gates, first[-1])
    got = lmbits.mix_online(x, bits, first, gate, gates, block)
    for lo, hi in zip(first, first[1:]):
        w = [[lmbits.START_WEIGHT] * 3 for _ in range(gates)]
        seen = [8.0] * lmbits.BINS
        true = [8 / (1 + math.exp(-((i + 0.5) / lmbits.BINS * 16 - 8))) for i in range(lmbits.BINS)]
        for at in range(lo, hi, block):
            steps = [[0.0] * 3 for _ in range(gates)]
            cells = []
            for i in range(at, min(at + block, hi)):
                t = sum(a * b for a, b in zip(w[gate[i]], x[i], strict=True))
                p = 1 / (1 + math.exp(-t))
                cell = min(max(int((t + 8) / 16 * lmbits.BINS), 0), lmbits.BINS - 1)
                mixed = min(max((p + true[cell] / seen[cell]) / 2, 1e-5), 1 - 1e-5)
                assert got[i] == pytest.approx(math.log10(mixed if bits[i] else 1 - mixed))
                cells.append((cell, bits[i]))
                for k in range(3):
                    steps[gate[i]][k] += lmbits.RATE * (bits[i] - p) * x[i][k]
            w = [[min(max(a + b, -4), 4) for a, b in zip(u, v, strict=True)] for u, v in zip(w, steps, strict=True)]
            for cell, bit in cells:
                seen[cell] += 1
                true[cell] += bit


def test_lm_known_tokens_are_mixed_bits_against_plain_code():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(14)]
    share = np.arange(14, 0, -1) / 105
    texts = [" ".join(rng.choice(words, n, p=share)).encode() for n in (50, 0, 1, 30, 120)]
    t, train = lmscore.read_tokens(texts), np.array([1, 1, 0, 0, 1])
    ids = sorted(set(t.ids.tolist()))
    coded, rest = np.array(ids[::2] + ids[1::4], np.uint64), ids[3::4]
    coded.sort()
    n = np.array([int(rng.integers(300, 9000)) for _ in coded])
    c = lmscore.make_code(coded, n, 9500, np.full(32, 100.0), np.full(32, 9))
    codes = [format(int(c.left[i]), f"0{c.bits}b")[: c.size[i]] for i in range(len(n) + 1)]
    assert not any(a != b and b.startswith(a) for a in codes for b in codes) and len(set(codes)) == len(codes)
    for i, x in enumerate(codes):  # each node counts the tokens below it
        for d in range(len(x)):
            for y in (0, 1):
                below = [m for z, m in zip(codes, [*n, 9500], strict=True) if z.startswith(x[:d] + str(y))]
                assert c.nodes[int("1" + x[:d], 2), y] == sum(below)
    pairs = rng.integers(400, 5000, (lmscore.PAIR_CLASSES << lmscore.PAIR_DEPTH, 2)).astype(np.float32)
    others = np.where(np.isin(t.ids, rest[:1]), 0, 40)
    s = lmscore.read_symbols(t, c)
    got = lmscore.bit_costs(t, s, train, others, c, pairs)
    place = {int(h): i for i, h in enumerate(coded)}
    log = lambda a, b, prior: math.log((b + prior) / (a + prior))
    for lo, hi, mine in zip(t.first, t.first[1:], train, strict=False):
        symbol = [place.get(int(h), len(n)) for h in t.ids[lo:hi]]
        last = [lmscore.PAIR_CLASSES - 1, *(lmscore.PAIR_CLASSES - 2 if k == len(n) else int(c.left[k] << 8 >> c.bits) for k in symbol)]
        every = Counter()
        for k, b in zip(symbol, last, strict=False):
            for d, y in enumerate(codes[k]):
                every[0, codes[k][:d], y] += 1
                every[b, codes[k][:d], y] += d < 8
        x, bits, gate, of, extra, now, seen = [], [], [], [], [], Counter(), set()
        for i, (k, b) in enumerate(zip(symbol, last, strict=False)):
            h = int(t.ids[lo + i])
            old, paths = h in seen, [("", codes[k], 0)]
            add = 0.0
            if k == len(n):
                tail = format(h >> 56, "08b")
                if old:
                    paths.append(("hash", tail, 0))
                    add = math.log10(now["times", h] / now["tail", tail])
                elif others[lo + i]:
                    paths.append(("level", format(6, "05b"), 1))
                    add = -math.log10(10)
            for name, path, levels in paths:
                for d, y in enumerate(path):
                    a = [now[name, path[:d], z] for z in "01"]
                    row = [log(*a, 0.05), 0, 0, 0]
                    if levels:
                        row[1] = log(*c.levels[int("1" + path[:d], 2)], 0.4)
                    elif not name:
                        node = int("1" + path[:d], 2)
                        row[1] = log(*(c.nodes[node, z] - mine * every[0, path[:d], str(z)] for z in (0, 1)), 0.4)
                        if d < 8:
                            row[2] = log(*(now["pair", b, path[:d], z] for z in "01"), 0.4)
                            row[3] = log(*(pairs[b << 8 | node, z] - mine * every[b, path[:d], str(z)] for z in (0, 1)), 0.4)
                    x.append(row)
                    bits.append(y == "1")
                    gate.append(2 * old + (name == "hash" or sum(a) > 0))
                    of.append(i)
            extra.append((add, old or others[lo + i] > 0))
            if k == len(n):
                paths = [*paths[:1], ("hash", tail, 0), *(p for p in paths if p[0] == "level")]
                now["tail", tail] += 1
            now["times", h] += 1
            seen.add(h)
            for name, path, _ in paths:
                for d, y in enumerate(path):
                    now[name, path[:d], y] += 1
                    if not name:
                        now["pair", b, path[:d], y] += 1
        logp = lmbits.mix_online(np.array(x, np.float32), np.array(bits), np.array([0, len(x)]), np.array(gate), 4, 64)
        want = [sum(p for p, j in zip(logp, of, strict=True) if j == i) + add if counted else 0 for i, (add, counted) in enumerate(extra)]
        assert got[lo:hi] == pytest.approx(want, rel=1e-3, abs=1e-4)


def test_lm_matched_tokens_are_counted_but_not_mixed(monkeypatch):
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, n) % 60).encode() for n in (200, 1, 0, 90)]
    t, train = lmscore.read_tokens(texts), np.array([1, 0, 1, 1])
    ids = np.unique(t.ids)[3:]
    c = lmscore.make_code(ids, np.full(len(ids), 300), 400, np.full(32, 100.0), np.full(32, 9))
    pairs = rng.integers(400, 5000, (lmscore.PAIR_CLASSES << lmscore.PAIR_DEPTH, 2)).astype(np.float32)
    s, others = lmscore.read_symbols(t, c), np.full(len(t.ids), 40)
    mixed, mix = [], lmscore.mix_online
    monkeypatch.setattr(lmscore, "mix_online", lambda x, bits, *rest: mixed.append(len(bits)) or mix(x, bits, *rest))
    whole = lmscore.bit_costs(t, s, train, others, c, pairs)
    for hit in (t.at >= 50, rng.random(len(t.ids)) < 0.5, np.ones(len(t.ids), bool)):
        got = lmscore.bit_costs(t, s, train, others, c, pairs, hit)
        bits = s.size + np.where(s.rest, np.where(t.before > 0, lmscore.HASH_BITS, lmscore.LEVEL_BITS), 0)
        assert mixed[-1] == bits[~hit].sum() < mixed[0] == bits.sum()
        assert (got[hit] == 0).all() and (got[~hit] < 0).all()
        early = np.flatnonzero(~hit & (t.at < np.array([np.flatnonzero(hit[a:b]).min(initial=b) for a, b in zip(t.first, t.first[1:])])[t.owner]))
        assert got[early] == pytest.approx(whole[early])  # what a text has later is counted as before


def test_lm_pairs_are_counted_by_path():
    rng = np.random.default_rng(12)
    t, train = lmscore.read_tokens([" ".join(f"w{i}" for i in rng.zipf(1.2, n) % 700).encode() for n in (900, 0, 400)]), np.array([True, True, False])
    ids, n = np.unique(t.ids, return_counts=True)
    c = lmscore.make_code(ids[n > 1], n[n > 1], int(n[n == 1].sum()), np.zeros(32), np.zeros(32, np.int64))
    s = lmscore.read_symbols(t, c)
    want = Counter()
    for i in np.flatnonzero(train[t.owner]):
        path = format(int(s.left[i]), f"0{c.bits}b")[: s.size[i]][: lmscore.PAIR_DEPTH]
        for d, bit in enumerate(path):
            want[int(s.pair[i]) << lmscore.PAIR_DEPTH | int("1" + path[:d], 2), int(bit)] += 1
    zeros, ones = lmscore.pair_bits(lmscore.count_pairs(t, s, train, c.bits))
    assert {(int(k), y): int(x[k]) for y, x in enumerate((zeros, ones)) for k in np.flatnonzero(x)} == want and len(want) > 500


def test_lm_index_finds_hashes():
    rng = np.random.default_rng(13)
    for n in (0, 1, 2, 1000):
        known = np.unique(np.concatenate([rng.integers(0, 1 << 64, n, np.uint64), rng.integers(0, 1 << 64, 1, np.uint64) + np.arange(min(n, 5), dtype=np.uint64)]))[:n]
        asked = np.concatenate([known, known + np.uint64(1), known - np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)])
        place = {int(h): i for i, h in enumerate(known)}
        assert lmscore.Index(known).find(asked).tolist() == [place.get(int(h), len(known)) for h in asked]


def test_lm_asks_for_anchors_that_others_have(spark):
    rng = np.random.default_rng(14)
    known, other = rng.integers(0, 1 << 64, (2, 3000), np.uint64)
    bits = lmscore.usable_bits(spark.createDataFrame([(int(h),) for h in known.view(np.int64)], "a long"))
    assert lmscore.has_bit(bits, known).all() and lmscore.has_bit(bits, other).mean() < 0.07
    none = lmscore.usable_bits(spark.createDataFrame([], "a long"))
    assert not lmscore.has_bit(none, other).any()


def test_lm_runs_predict_token_by_token(spark):
    text = " ".join(f"w{i}" for i in range(40)).encode()
    t = lmscore.read_tokens([text, b"w0 w1 w2"])
    run = lmscore.check_bits(t.ids[3:13]).copy()
    run[6] += 1  # the run fails at its seventh token
    flags, hit = lmscore.match_costs(t, np.array([3]), pa.array([run.tobytes()], pa.binary()), np.array([5]), np.array([6]))
    assert np.flatnonzero(flags).tolist() == list(range(3, 10)) and np.flatnonzero(hit).tolist() == list(range(3, 9))
    # A text that leaves a known one halfway is told by the half that it shares.
    rng = random.Random(8)
    words = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=60))) for i in range(200)]
    fold = lambda d: zlib.crc32(str(d).encode()) % 10
    known = next(x for i, x in rows if fold(i)).split()
    held = [i for i in range(1000, 2000) if not fold(i)][:2]
    stop = 10
    left = known[:stop] + rng.sample(known[stop:], len(known) - stop)
    other = rng.sample(known[:stop], stop) + left[stop:]
    got = {r["doc_id"]: r for r in rows_of(lmscore.score_texts(spark.createDataFrame([*rows, (held[0], " ".join(left)), (held[1], " ".join(other))], "doc_id long, text string")))}
    assert got[held[0]]["score"] > got[held[1]]["score"] + 8


def test_lm_known_bits_are_a_sequential_estimate():
    a, b, p, counts = 1.5, 9.5, 1.0, [0, 0]
    for bit in (0, 1, 1, 0, 0, 1):
        p *= (counts[bit] + (a if bit else b)) / (sum(counts) + a + b)
        counts[bit] += 1
    assert lmscore.kt(3, 3, a, b) == pytest.approx(math.log10(p))


def test_lm_words_are_a_probability():
    rng = np.random.default_rng(0)
    model = lmbits.Speller(
        rng.normal(0, 1, lmbits.N_SLOTS).astype(np.float16), rng.integers(0, 9, lmbits.N_SLOTS).astype(np.uint8),
        np.full((lmbits.N_GATES, lmbits.N_CTX), 0.2), np.full((lmbits.N_GATES, lmbits.APM_BINS), 0.4),
    )
    # All continuations of "a" by one byte, closed or open, share out the mass of the prefix.
    _, _, ctx, position, _ = lmbits.contexts([b"a"], 0)
    total = 0.0
    for byte in range(256):
        p = 1.0
        for b in range(8):
            node, bit = (1 << b) | byte >> (8 - b), byte >> (7 - b) & 1
            x, gate = lmbits.inputs(model, [c[1:] for c in ctx], np.array([node]), position[1:])
            t = np.clip(np.einsum("gk,kg->g", model.weights[gate], x), -12, 12)
            q = (lmbits.squash(t) + lmbits.refine(model.apm, gate, t)[0]) / 2
            p *= float(q[0] if bit else 1 - q[0])
        total += p
    assert total == pytest.approx(1)
    assert model.log10([b"ab", b"c", b"ab"])[0] == pytest.approx(model.log10([b"ab"])[0])


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.example.com/en/71?x=1"), (2, "http://example.com/en/8"), (3, "https://EXAMPLE.net/de/80#t"), (4, "http://x.net/de/1"),
         (5, "http://b.org/es/"), (6, "nothing"), (7, None), (8, "http://notcom/en/1"), (9, "http://com?/en/"), (9, "http://bad.info/spam/1")]
        + [(i, f"http://bad.info/spam/{i}") for i in range(100, 130)] + [(i, f"http://good.info/fine/{i}") for i in range(200, 260)],
        "page_id long, url string",
    ).withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([(i, 0, 0) for i in range(100, 130)] + [(i, 1, 0) for i in range(200, 260)] + [(200, None, None)], "doc_id long, quality int, toxic int")
    got = {(r["page_id"], r["path"]): r for r in rows_of(urls.judge_urls(pages, labels))}
    rule = lambda i: next((r["rule"], r["verdict"]) for (p, _), r in got.items() if p == i)
    assert rule(1) == ("example.com/en/7", "allow") and rule(2) == ("com/en/", "block")
    assert rule(3) == ("example.net/de/8", "block") and rule(4) == ("net/de/", "allow") and rule(5) == ("org/es/", "block")
    assert rule(6) == (None, "allow") and rule(7) == (None, "allow") and rule(8) == (None, "allow")
    assert rule(110) == (None, "block") and rule(210) == (None, "allow") and got[9, "/spam/1"]["verdict"] == "block" and got[9, ""]["host"] == "com"
    mined, items = urls.mine_rules(spark.createDataFrame([("http://b.c/x", True)] * 4 + [("http://b.c/y", False)] * 6, "url string, bad boolean"), 0.3, 0.6)
    assert [r["antecedent"] for r in rows_of(mined)] == [["p:x"]] and {r["token"]: r["item"] for r in rows_of(items)} == {"h:b": "h:b", "h:c": "h:b", "s:http": "h:b", "p:x": "p:x", "p:y": "p:y"}
    assert urls.judge_urls(pages.limit(0), labels.limit(0)).count() == 0


def test_url_rules_against_brute_force(spark):
    """Verdicts and confidences are those of all token sets, mined without joining or leaving out any."""
    from itertools import chain, combinations

    rng = random.Random(9)
    rows = []
    for i in range(300):
        host = rng.choice(("a.com", "b.com", "c.org"))
        rows.append((i, f"http://{host}/" + "/".join(rng.choice(("x", "y", "zz/zzz", "w")) for _ in range(rng.randint(1, 2)))))
    bad = {i: rng.random() < (0.9 if "/x/" in u else 0.7 if "b.com" in u and "w" in u else 0.2) for i, u in rows if i % 3}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    tokens = {r["url"]: frozenset(r["t"]) for r in rows_of(pages.select("url", urls.url_tokens(F.col("url")).alias("t")))}
    labels = spark.createDataFrame([(i, int(not b), 0) for i, b in bad.items()], "doc_id long, quality int, toxic int")
    known = [(tokens[u], bad[i]) for i, u in rows if i in bad]
    sets = {frozenset(c) for t, _ in known for c in chain.from_iterable(combinations(sorted(t), k) for k in range(1, len(t) + 1))}
    mined = {}
    for c in sets:
        n, k = sum(c <= t for t, _ in known), sum(b for t, b in known if c <= t)
        if k / len(known) >= 0.02 and k / n >= 0.6:
            mined[c] = k / n
    got = rows_of(urls.judge_urls(pages, labels, list_rules=(("allow", "nowhere", "/"),), min_support=0.02))
    assert any(r["confidence"] for r in got) and any(r["confidence"] is None for r in got)
    for r in got:
        want = max((v for c, v in mined.items() if c <= tokens[r["url"]]), default=None)
        assert r["confidence"] == (None if want is None else pytest.approx(want)) and r["verdict"] == ("allow" if want is None else "block")


def test_url_tokens_that_stand_together_make_one_item(spark):
    deep = "/".join(f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))
    rows = [(i, f"http://deep.com/{deep}/{'p' if i % 4 else 'q'}") for i in range(80)] + [(100 + i, f"http://plain.com/{'r' if i % 2 else 't'}") for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 100 or i % 4 == 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in rows_of(urls.judge_urls(pages, labels, list_rules=(("allow", "nowhere", "/"),)))}
    assert all(got[i] == ("block" if i < 100 else "allow") for i, _ in rows)  # the deep path itself is bad at 0.75


def brute_hits(doc, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(doc), set(), set()
    for i, t in items:
        x = words(t)
        m = min(10, len(x))
        grams = {tuple(x[k : k + m]) for k in range(len(x) - m + 1)} if x else set()
        for k in range(len(w) - m + 1):
            if tuple(w[k : k + m]) in grams:
                hit.update(range(k, k + m))
                found.add(str(i))
    return len(w), len(hit), sorted(found)


def contaminated(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = decontam.find_contamination(docs, spark.createDataFrame(items, "item_id string, text string"))
    return {r["doc_id"]: (r["n_words"], sum(s["stop"] - s["start"] for s in r["spans"]), r["items"]) for r in rows_of(found)}


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_decontamination_of_repeated_words(spark, seed):
    rng = random.Random(seed)  # few words make many ties of the least hash
    items = [(str(i), " ".join(rng.choices("aab", k=rng.choice((3, 9, 10, 12, 30, 60))))) for i in range(4)]
    docs = [" ".join(rng.choices("aaab", k=rng.randint(0, 90))) for _ in range(80)] + [items[0][1], "b " + items[3][1] + " a a"]
    got = contaminated(spark, docs, items)
    for i, d in enumerate(docs):
        n_words, n_hit, want = brute_hits(d, items)
        assert got[i] == (n_words, n_hit, want)
    n = 40_000
    assert contaminated(spark, ["w " * n], [("x", "w " * 4000)]) == {0: (n, n, ["x"])}


def test_decontamination_by_many_items(spark, monkeypatch):
    """More fingerprints than the filter has bits for, many items of one passage, and a passage that most documents have."""
    monkeypatch.setattr(decontam, "_MOST_BITS", 1 << 15)
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(3000)]
    passage = " ".join(rng.choices(vocab, k=30))
    items = [(f"i{i}", " ".join(rng.choices(vocab, k=rng.choice((4, 9, 40))))) for i in range(1500)] + [(f"p{i}", passage + f" own{i}") for i in range(40)]
    docs = [" ".join([*rng.choices(vocab, k=20), *(passage.split() if i % 3 else rng.choice(items)[1].split()), *rng.choices(vocab, k=9)]) for i in range(150)]
    got = contaminated(spark, docs, items)
    assert all(got[i] == brute_hits(d, items) for i, d in enumerate(docs)) and len(got[1][2]) >= 40


def test_decontamination(spark, docs, empty):
    rng = random.Random(5)
    data = corpus()
    items = [(i, " ".join((rng.choice(data)[1] or "q").split(" ")[:40])) for i in range(25)] + [(90, None), (91, "..."), (92, "A, b"), (92, "zz"), (93, "w1 " * 30)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(decontam.find_contamination(docs, table))
    want = Counter((d, *map(str, brute_hits(t, items))) for d, t, *_rest in data)
    assert Counter((r["doc_id"], str(r["n_words"]), str(sum(s["stop"] - s["start"] for s in r["spans"])), str(r["items"])) for r in got) == want
    assert decontam.find_contamination(empty, table.limit(0)).count() == 0
    assert decontam.find_contamination(docs, table.limit(0)).filter("size(spans) = 0 and size(items) = 0").count() == len(data)
    kept = decontam.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in rows_of(kept)) == Counter((d, t) for d, t, *_rest in data if not brute_hits(t, items)[1])
    odd = docs.withColumnsRenamed({"lang": "_text", "source": "p.q", "rid": "_row"})
    assert decontam.drop_contaminated(odd, table).columns == odd.columns and decontam.drop_contaminated(odd, table).count() == kept.count()


def test_host_rules(spark, docs, empty):
    got = rows_of(hostrules.judge_hosts(hostrules.document_stats(docs)))
    assert len(got) == docs.count() and not any(r["kept"] and r["base_failed"] for r in got)
    for d, t, *_rest in corpus():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover))
        assert want in {(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got if r["doc_id"] == d}
    assert hostrules.judge_hosts(hostrules.document_stats(empty)).count() == 0


def test_host_rates_against_plain_code(spark):
    """Fifty hosts whose documents fail at rates from none to all: shrunk rates and verdicts, and hosts that decide."""
    rng = random.Random(12)
    rows = []
    for h in range(50):
        for i in range(rng.randint(1, 60)):
            fails = rng.random() < h / 49
            rows.append((len(rows), "few words" if fails else " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60)), None if h == 7 else f"h{h}"))
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(hostrules.judge_hosts(hostrules.document_stats(d)))
    n, f = Counter(h for *_, h in rows), Counter(h for _, t, h in rows if t == "few words")
    total, failed, k = len(rows), sum(f.values()), len(n)
    mean = failed / total
    spread = sum(n[h] * (f[h] / n[h] - mean) ** 2 for h in n)
    between = (spread - (k - 1) * mean * (1 - mean)) / (total - sum(x * x for x in n.values()) / total)
    weight = mean * (1 - mean) / between - 1
    assert weight > 0
    rate = {h: (f[h] + mean * weight) / (n[h] + weight) for h in n}
    by_id = {i: h for i, _, h in rows}
    for r in got:
        h = by_id[r["doc_id"]]
        assert r["host_rate"] == pytest.approx(rate[h]) and r["kept"] == (not r["base_failed"] and rate[h] <= 0.5)
    assert len(got) == len(rows) and sum(not r["kept"] and not r["base_failed"] for r in got) > 50


def test_host_rules_each_have_their_rate(spark):
    """Sixty hosts, of which three fail one rule each far more often than the others; a plain fit of each rule's prior."""
    rng = random.Random(7)
    word = lambda n=6: "".join(rng.choices("abcdefghijklmnop", k=n))
    text = lambda: [word() for _ in range(70)]
    faults = {
        "symbols": lambda: " ".join(text() + ["#"] * 12),
        "lines": lambda: "\n".join(["a line that comes again " + word()] + ["same line"] * 5 + [" ".join(text())]),
        "word_length": lambda: " ".join(word(14) for _ in range(70)),
    }
    rows, share = [], {}
    for h in range(60):
        for _ in range(rng.randint(20, 50)):
            rule = list(faults)[h] if h < 3 and rng.random() < 0.6 else rng.choice(list(faults)) if rng.random() < 0.06 else None
            rows.append((len(rows), faults[rule]() if rule else " ".join(text()), None if h == 2 else f"h{h}"))
    got = rows_of(hostrules.judge_hosts(hostrules.document_stats(spark.createDataFrame(rows, "doc_id long, text string, source string"))))
    by_host = {}
    for r in got:
        by_host.setdefault(r["host"], []).append(r)
    fails = {
        "short": lambda r: r["n_words"] < 50, "repeats": lambda r: 100 * r["n_repeat_words"] > 50 * r["n_words"], "symbols": lambda r: 10 * r["n_symbols"] > r["n_words"],
        "lines": lambda r: 10 * r["n_dup_lines"] > 3 * r["n_lines"], "word_length": lambda r: not 3 * r["n_words"] <= r["word_chars"] <= 10 * r["n_words"],
    }
    rates, bad = {}, {}
    n = {h: len(rs) for h, rs in by_host.items()}
    total, k = len(rows), len(n)
    for rule, test in fails.items():
        f = {h: sum(map(test, rs)) for h, rs in by_host.items()}
        mean = sum(f.values()) / total
        between = (sum(n[h] * (f[h] / n[h] - mean) ** 2 for h in n) - (k - 1) * mean * (1 - mean)) / (total - sum(x * x for x in n.values()) / total)
        weight = max(mean * (1 - mean) / between - 1, 0.01) if between > 0 else total / k
        a, b = max(mean * weight, 1e-9), max((1 - mean) * weight, 1e-9)
        limit = max(0.3, a / (a + b) + 3 * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))
        limit = min(0.5, limit) if rule in ("short", "repeats") else limit
        for h in n:
            rates.setdefault(h, []).append((f[h] + a) / (n[h] + a + b))
            if rates[h][-1] > limit:
                bad.setdefault(h, []).append(rule)
    assert bad == {"h0": ["symbols"], "h1": ["lines"], None: ["word_length"]}
    for r in got:
        assert r["host_rate"] == pytest.approx(max(rates[r["host"]])) and r["host_failed"] == bad.get(r["host"], [])
        assert r["kept"] == (not r["base_failed"] and r["host"] not in bad)


def test_host_verdict_drops_a_failing_host(spark):
    good = "a b c d e f g h i j " * 3 + " ".join(f"x{i}" for i in range(60))
    rows = [(i, good, "fine") for i in range(60)] + [(100 + i, "short", "bad") for i in range(59)] + [(200, good, "bad")]
    got = {r["doc_id"]: r["kept"] for r in rows_of(hostrules.judge_hosts(hostrules.document_stats(spark.createDataFrame(rows, "doc_id long, text string, source string"))))}
    assert got[0] and not got[200]


def test_licenses(spark, empty):
    texts = [
        (1, "x\nReleased under the MIT License.\ny"), (2, "the CC-BY thing, gnu general. public license"), (3, None), (4, ""),
        (5, "Licensed under CC BY-SA 4.0"), (6, "mit license mit license"), (7, "nothing here"), (8, "license apache license " * 5000),
    ]
    d = spark.createDataFrame(texts, "doc_id long, text string").withColumn("labels", F.lit("clash"))
    got = {r["doc_id"]: r for r in rows_of(licenses.scan_licenses(d))}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["base_labels"]) == (1, 4, ["mit"])
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"], got[2]["base_labels"]) == (2, 1, 4, ["cc-by", "gpl"])
    assert (got[3]["n_words"], got[3]["first_word"], got[3]["score"]) == (0, None, 0.0)
    assert "cc-by-sa" in got[5]["labels"] and got[6]["last_word"] == 2 and got[8]["n_base"] == 5000
    assert got[7]["score"] == 0 and licenses.scan_licenses(empty).count() == 0
    # The filters lose nothing: every line against every template.
    rng = random.Random(2)
    index = licenses.Templates(licenses.TEMPLATES, {b"license": 9, b"the": 7}, 0.8)
    vocab = sorted({w for s in index.sets for w in s}) + [b"other", b"words"]
    for _ in range(800):
        base = rng.choice(index.sets)
        line = [w for w in base if rng.random() < 0.9] + rng.sample(vocab, 3)
        want = {t for t, s in enumerate(index.sets) if len(set(s) & set(line)) >= index.need[t]}
        assert set(index.match(line)) == want


def test_license_notices_that_look_alike(spark):
    sentence = "This work is licensed under a Creative Commons Attribution-{}4.0 International License."
    texts = [
        ("Released under the BSD license.", ["bsd"], ["bsd"]), ("Released under the MIT license.", ["mit"], []), ("Released under the XYZ license.", [], []),
        ("Licensed under CC BY 4.0", ["cc-by"], []), ("Licensed under CC BY-NC 4.0", ["cc-by", "cc-by-nc"], ["cc-by-nc"]),
        ("Licensed under CC BY-SA 4.0.", ["cc-by", "cc-by-sa"], ["cc-by-sa"]),
        (sentence.format("ShareAlike "), ["cc-by", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "cc-by-sa"], ["cc-by-sa"]),
        (sentence.format("ShareAlike-NonCommercial "), ["cc-by", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "cc-by-sa"], ["cc-by-nc-sa"]),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
         "either version 2.1 of the License, or (at your option) any later version.", ["agpl", "gpl", "lgpl"], ["lgpl"]),
        ("Licensed under the Apache License, Version 2.0.", ["apache"], ["apache"]), ("SPDX-License-Identifier: MIT", ["mit"], ["mit"]),
        ("Permission is hereby granted to the school for any person to copy the terms.", [], []),
        ("the license is under version " + "word " * 40 + " 2 0 apache licensed", [], []),
        (" ".join(w + " and so on and on" for w in "licensed under the apache mit bsd license version 2 0 released".split()), [], []),
    ]
    d = spark.createDataFrame([(i, t) for i, (t, *_rest) in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["best_labels"]) for r in rows_of(licenses.scan_licenses(d))}
    assert [got[i] for i in range(len(texts))] == [(labels, best) for _, labels, best in texts]


def test_every_notice_is_reported_as_it_stands(spark):
    texts = [(i, f"some words before\n{notice}\nand after") for i, (_, notice) in enumerate(licenses.TEMPLATES)]
    got = {r["doc_id"]: r for r in rows_of(licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), phrases={"no such phrase": "none"}))}
    for i, (label, _) in enumerate(licenses.TEMPLATES):
        assert label in got[i]["best_labels"] and got[i]["score"] == 1.0
        assert any(b["label"] == label and b["share"] == 1.0 and b["line"] == 1 and b["best"] for b in got[i]["blocks"])


@pytest.mark.parametrize("columns", [70, 30])
def test_wrapped_license_notices(spark, columns):
    notices = [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ]
    texts = [(i, "int main;\n" * 3 + textwrap.fill(x, columns, initial_indent=" * ", subsequent_indent=" * ") + "\n\nmore words") for i, x in enumerate(notices)]
    far = (" filler" * 20 + "\n").join(notices[0].split(" "))
    d = spark.createDataFrame([*texts, (9, far)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows_of(licenses.scan_licenses(d, phrases={"no such phrase": "none"}))}
    assert [got[i]["best_labels"] for i in (0, 1, 2, 3, 9)] == [["bsd"], ["gpl"], ["apache"], ["mit"], []]
    assert all({*got[i]["best_labels"]} <= {*got[i]["labels"]} for i in range(4)) and got[9]["labels"] == []
    assert all(got[i]["score"] >= 0.8 and {b["line"] for b in got[i]["blocks"]} <= {3, 4, 5} for i in range(4))


def test_license_windows_against_brute_force():
    """Every window of every template, ties included: none that meets the share is left out, none is made up."""
    rng = random.Random(6)
    index = licenses.Templates(licenses.TEMPLATES, {b"license": 9, b"the": 7}, 0.8)
    found = 0
    for _ in range(120):
        words = []
        for t in rng.sample(range(len(index.sets)), rng.randint(1, 3)):
            notice = llm_text.alnum_words(licenses.TEMPLATES[t][1].encode())
            words += [w for w in notice if rng.random() < 0.93] + [b"other"] * rng.choice((0, 1, 9, 60))
        got = index.blocks(b" ".join(words), words)
        for t, template in enumerate(index.sets):
            shares = [len(set(template).intersection(words[i : i + index.reach[t]])) for i in range(len(words))]
            most = max(shares, default=0)
            here = [share for _, u, share, _ in got if u == t]
            assert bool(here) == (most >= index.need[t]) and (not here or max(here) == most / len(template))
            runs = index.windows(words, t)
            for i, n in enumerate(shares):  # each window that meets the share lies in a run
                if n >= index.need[t]:
                    inside = [k for k in range(i, min(i + index.reach[t], len(words))) if words[k] in template]
                    assert any(a <= inside[-1] and inside[0] <= b for a, b, _ in runs)
            found += len(runs)
        assert not got or any(best for *_rest, best in got)
    assert found > 200


def brute_components(data):
    sets = []
    for _, t, *_rest in data:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(data)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, *_rest) in enumerate(data):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i), d) if sets[i] else d) for i, (d, *_rest) in enumerate(data))


def test_shingles_of_words_around_a_block():
    block = len(llm_text._POWER) - 1
    rng = random.Random(4)
    for size in (block - 1, block, block + 1, 2 * block):
        for lead in (0, 1, 5, block - 2):
            text = b"r" * lead + b" " + b"Q" * size + b"\n\x0b tail\x1cend of it here"
            for t in (text, text[:-1] + b" " + b"q" * size):
                starts, _, hashes = llm_text.word_hashes(t.lower())
                words = t.lower().split()
                assert starts.tolist() == [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
                assert len(set(hashes.tolist())) == len(set(words))
                by_word = dict(zip(words, hashes.tolist(), strict=True))
                assert all(by_word[w] == h for w, h in zip(words, hashes.tolist(), strict=True))
    texts = [None, b"", b" "] + [b"".join(rng.choice((b"a", b"B", b"b", b"cc")) + rng.choice((b" ", b"\n", b"\x1c")) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    brute = []
    for t in texts:
        w = (t or b"").lower().split()
        brute.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    got = [set(s.tolist()) for s in jaccard.shingle_sets(texts)]
    assert [len(s) for s in got] == [len(s) for s in brute]
    assert all(len(got[i] & got[j]) == len(brute[i] & brute[j]) for i in range(len(texts)) for j in range(i))


@pytest.mark.parametrize("rows_a_batch", [7, 1000])
def test_pairs_of_a_token_in_short_and_long_runs(rows_a_batch):
    rng = random.Random(rows_a_batch)
    rows = sorted(
        (token, rng.randrange(5), rng.randrange(20, 40), rng.randrange(8), rng.randrange(300), rng.choice((1, 2)) if token % 3 == 0 else 0)
        for token in range(60)
        for _ in range(rng.choice((1, 2, 5, 64, 65, 150)))
    )
    want = {
        (min(x[4], y[4]), max(x[4], y[4]))
        for i, x in enumerate(rows)
        for y in rows[i + 1 :]
        if x[0] == y[0] and x[1] != y[1] and (x[5] == 0 or x[5] != y[5]) and jaccard.fits(x[2], x[3], y[2], y[3])
    }
    columns = ["token", "label", "n", "pos", "cid", "side"]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + rows_a_batch], strict=True)], columns) for i in range(0, len(rows), rows_a_batch)]
    got = [pair for b in jaccard._cross(batches, jaccard.SHARE, most=500) for pair in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert set(got) == want


@pytest.mark.parametrize(("seed", "block"), [(3, 4096), (11, 4096), (5, 20)])
def test_near_duplicates(spark, empty, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PARTNERS", jaccard.PARTNERS if block > 20 else ())
    data = corpus(seed, 250)
    base = " ".join(f"c{i}" for i in range(60)).split(" ")
    rng = random.Random(seed)
    for i in range(120):  # one large group of near copies around the threshold
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"z{rng.randrange(999)}"
        data.append((1000 + i, " ".join(words), "en", "s", 0, 1, 2))
    docs = spark.createDataFrame(data, DOC).repartition(3)
    got = rows_of(jaccard.near_duplicates(docs))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(data)
    kept = rows_of(jaccard.keep_one(docs).select("doc_id"))
    assert len([r for r in kept if (r["doc_id"] or 0) >= 1000]) == len({c for d, _, c in brute_components(data) if d is not None and d >= 1000 and c >= 1000})
    assert jaccard.near_duplicates(empty).count() == 0


def test_scoring_keeps_no_counts(spark):
    data = corpus(2, 60)
    docs = spark.createDataFrame(data, DOC)
    before = len(storage.written)
    found = lmscore.score_texts(docs)
    names = [x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in storage.written[before:]]
    assert {"lm-parts", "lm-runs", "lm-rare"} <= set(names) and "lm-counts" not in names, names
    assert found.count() == found.filter("score < 0").count() == len(data)


def graph(seed):
    """Edges of chains, stars and rings over random ids, some repeated, some loops; and each node's least id."""
    rng = random.Random(seed)
    edges, least = [], {}
    for size in [2, 3, 3, 5, 9, 30, 200] * 3:
        nodes = rng.sample(range(-(10**17), 10**17), size)
        chain = list(zip(nodes, nodes[1:], strict=False))
        edges += rng.choice((chain, chain + [(nodes[-1], nodes[0])], [(nodes[0], x) for x in nodes[1:]]))
        least |= dict.fromkeys(nodes, min(nodes))
    edges += [(b, a) for a, b in edges[::7]] + edges[::5] + [(a, a) for a, _ in edges[::9]]
    rng.shuffle(edges)
    return edges, least


def test_components_settle_in_few_tables(spark):
    edges, least = graph(2)
    before = len(storage.written)
    found = jaccard.components(spark.createDataFrame(edges, "a long, b long").repartition(3))
    assert sorted((r["node"], r["label"]) for r in found.collect()) == sorted(least.items())
    assert len(storage.written) - before <= 3  # rounds of stars alone: 8
    assert jaccard.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_edges_met_together_are_contracted(most):
    edges, least = graph(5)
    batches = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in edges[i : i + 50] if x[0] != x[1]]) for k in (0, 1)], ["u", "v"]) for i in range(0, len(edges), 50)]
    got = [e for b in jaccard._contracted(iter(batches), most) for e in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert all(v < u and least[u] == least[v] for u, v in got)
    links = {}
    for u, v in got:
        links.setdefault(u, set()).add(v)
        links.setdefault(v, set()).add(u)
    for at in least.values():  # who was connected still is
        reached, open_ = {at}, [at]
        while open_:
            open_ = [x for y in open_ for x in links[y] if x not in reached and not reached.add(x)]
        assert reached == {x for x, y in least.items() if y == at}
    if most == 1 << 20:
        assert dict(got) == {x: y for x, y in least.items() if x != y}


def test_keep_one_with_null_and_repeated_ids(spark):
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(40)) for c in "abcd")
    rows = [
        (None, one), (None, one), (None, one + " more"),  # near copies, all without id: one stays
        (None, two), (7, two), (8, two),  # 7 stays, not the null id beside it
        (7, three), (9, three + " more"), (9, three),  # another component's least id is 7, too
        (5, four), (5, four + " more"), (5, four),  # near copies that share an id
        (None, None), (None, ""), (6, " "), (6, " "),
    ]
    got = Counter((r["doc_id"], (r["text"] or "")[:1]) for r in rows_of(jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))))
    assert got == Counter({(None, "a"): 1, (7, "b"): 1, (7, "c"): 1, (5, "d"): 1, (None, ""): 2, (6, " "): 2})


def test_quality(spark, empty):
    rng = random.Random(4)
    good = [" ".join(rng.choice(("the", "of", "river", "stone", "light")) + str(rng.randint(0, 99)) for _ in range(80)) + "." for _ in range(200)]
    bad = [" ".join(rng.choice(("spam***", "buy!!!", "x###")) for _ in range(80)) for _ in range(100)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(300)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    forest = quality.train_quality(docs, labels)
    got = {r["doc_id"]: r["score"] for r in rows_of(quality.score_quality(docs, forest))}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.3) == (i < 200) for i in held) >= 0.95 * len(held)
    assert got[900] == got[901] and all(0 <= s <= 1 for s in got.values())
    x = np.array([quality.features(t.encode()) for t in good[:5] + bad[:5]])
    for row, s in zip(x, forest.score(x), strict=True):  # array traversal against a walk of each tree
        total = forest.start
        for f, c, v in zip(forest.feature, forest.cut, forest.value, strict=True):
            n = 0
            while n < len(f):
                n = 2 * n + 1 + int(row[f[n]] > c[n])
            total += v[n - len(f)]
        assert s == pytest.approx(1 / (1 + math.exp(-total)))
    assert quality.keep_good(empty, labels.limit(0)).count() == 0


def plain_boosting(x, y, trees, depth, bins, rate, ridge):
    """Scores of the training rows by boosting that tries every cut of every feature with plain sums."""
    n = len(y)
    start = math.log((sum(y) + 1) / (n - sum(y) + 1))
    total = [start] * n
    cuts = [sorted(set(np.quantile([r[j] for r in x], np.linspace(0, 1, bins)[1:-1]).tolist())) for j in range(len(x[0]))]

    def grow(rows, left, grad, hess, out):
        part = lambda rows: sum(grad[i] for i in rows) ** 2 / (sum(hess[i] for i in rows) + ridge)
        if not left:
            value = rate * sum(grad[i] for i in rows) / (sum(hess[i] for i in rows) + ridge)
            out.update(dict.fromkeys(rows, value))
            return
        best, pick = 0.0, (0, math.inf)
        for j, places in enumerate(cuts):
            for c in places:
                low, high = [i for i in rows if x[i][j] <= c], [i for i in rows if x[i][j] > c]
                gain = part(low) + part(high) - part(rows)
                if gain > best + 1e-9:
                    best, pick = gain, (j, c)
        j, c = pick
        grow([i for i in rows if x[i][j] <= c], left - 1, grad, hess, out)
        grow([i for i in rows if x[i][j] > c], left - 1, grad, hess, out)

    for _ in range(trees):
        p = [1 / (1 + math.exp(-t)) for t in total]
        out = {}
        grow(list(range(n)), depth, [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p], out)
        total = [t + out[i] for i, t in enumerate(total)]
    return [1 / (1 + math.exp(-t)) for t in total]


@pytest.mark.parametrize("seed,depth,bins", [(1, 3, 9), (2, 2, 64), (3, 4, 5)])
def test_boosting_against_plain_splits(seed, depth, bins):
    rng = random.Random(seed)
    x = [[rng.gauss(0, 1), rng.choice((0.0, 1.0, 1.0, 5.0)), rng.random() ** 4, 7.0] for _ in range(200)]
    y = [float(a + b / 3 + rng.gauss(0, 0.7) > 0.6) for a, b, *_ in x]
    forest = quality.fit_forest(np.array(x), np.array(y), trees=6, depth=depth, bins=bins, rate=0.3, ridge=2.0)
    got, want = forest.score(np.array(x)), plain_boosting(x, y, 6, depth, bins, 0.3, 2.0)
    assert got == pytest.approx(want, abs=1e-9) and max(want) - min(want) > 0.5
    one = quality.fit_forest(np.array(x[:5]), np.ones(5), trees=3)
    assert one.score(np.array(x[:2])) == pytest.approx(plain_boosting(x[:5], [1.0] * 5, 3, 4, 64, 0.15, 4.0)[:2], abs=1e-9)


@pytest.mark.parametrize("bucket_bytes", [1 << 24, 4000])
def test_shuffle(spark, docs, empty, bucket_bytes):
    got = rows_of(shuffle.shuffle_into_shards(docs, n_shards=7, bucket_bytes=bucket_bytes))
    data = corpus()
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r["doc_id"], r["_size"], r["_crc"], r["text"]) for r in got) == Counter((d, size(t), zlib.crc32((t or "").encode()), t) for d, t, *_rest in data)
    shards = {}
    for r in got:
        shards.setdefault(r["_shard"], []).append(r["_slot"])
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in shards.values())
    assert shuffle.shuffle_into_shards(empty).count() == 0
    again = rows_of(shuffle.shuffle_into_shards(docs.repartition(11, "rid"), n_shards=7, bucket_bytes=bucket_bytes))
    place = lambda rows: sorted((r["doc_id"] or -1, r["text"] or "", r["_shard"], r["_slot"]) for r in rows)
    assert place(again) == place(got)  # however the input is split


def test_shuffle_spreads_equal_rows(spark):
    same = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("copy").alias("text"), F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    rest = spark.range(3000).select(F.col("id") + 10, F.lit("other"), F.create_map(F.lit("k"), F.lit(2)))
    d = same.union(rest).coalesce(1).withColumns({"_size": F.lit("clash"), "_bucket": F.lit(5), "c0": F.lit(6)})
    got = rows_of(shuffle.shuffle_into_shards(d, n_shards=10, bucket_bytes=4000))
    assert len(got) == 6000 and set(got[0]) == {"doc_id", "text", "m", "_bucket", "c0", "_size", "_crc", "_shard", "_slot"}
    assert all(r["_size"] == len(r["text"]) + 16 and r["m"] == {"k": 1 if r["doc_id"] == 1 else 2} and r["c0"] == 6 for r in got)
    copies = Counter(r["_shard"] for r in got if r["doc_id"] == 1)
    assert all(230 < copies[i] < 370 for i in range(10))
    is_copy = [r["doc_id"] == 1 for r in sorted(got, key=lambda r: (r["_shard"], r["_slot"]))]
    runs = sum(a != b for a, b in zip(is_copy, is_copy[1:]))
    assert 2700 < runs < 3300  # as in a fair shuffle


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    data = [(i, t, "en", s, 0) for i, (_, t, _, s, *_rest) in enumerate(corpus(7, 80))]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, kind).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 3 > 0), 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    item = next(t for _, t, *_rest in data if len((t or "").split()) > 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert (out.columns == docs.columns) or k == 4
        if k == 0:
            forest = quality.train_quality(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
            want = {r["doc_id"] for r in rows_of(quality.score_quality(docs, forest)) if r["score"] >= 0.3}
            assert {r["doc_id"] for r in rows_of(out)} == want
        if k == 1:
            texts = [(r["doc_id"], r["text"]) for r in rows_of(docs)]
            least = {}
            for (d, _, c), n in brute_components(texts).items():
                least[d] = c
            wordy = {d for d, t in texts if (t or "").split()}
            kept = [r["doc_id"] for r in rows_of(out)]
            assert sorted(kept) == sorted({least[d] for d in wordy} | {d for d, _ in texts if d not in wordy})
            assert len(kept) < len(texts)
        if k == 3:
            mix = {r["doc_id"]: r for r in rows_of(mixing.mix_sources(docs))}
            want = {d: 1 if not r["size"] else int(r["taken"] / r["size"] + 0.5) for d, r in mix.items()}
            assert Counter(r["doc_id"] for r in rows_of(out)) == Counter({d: n for d, n in want.items() if n})
            assert any(n > 1 for n in want.values())
        if k == 4:
            n = docs.count()
            assert Counter(r["doc_id"] for r in rows_of(out)) == Counter(r["doc_id"] for r in rows_of(docs))
            sizes = Counter(r["shard"] for r in rows_of(out))
            assert max(sizes.values()) - min((sizes[i] for i in range(40)), default=0) <= 1 and sum(sizes.values()) == n
        if k == 2:
            assert {r["doc_id"] for r in rows_of(out)} == {r["doc_id"] for r in rows_of(docs) if not brute_hits(r["text"], [(1, item)])[1]}
        docs = spark.createDataFrame(rows_of(out), out.schema) if k < 4 else out
    final = rows_of(corpus_pipeline.run(spark, str(tmp_path)))
    assert final and {"shard", "slot"} <= set(final[0])
    assert sorted(map(str, final)) == sorted(map(str, rows_of(out)))
