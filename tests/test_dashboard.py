"""Ten batches of inserts and deletes: after each, every view equals a count from scratch."""

import random
from collections import Counter

from pyspark.sql import functions as F

from sparkfolio.operators.dashboard import Dashboard

P = "id long, source string, city string, start_date string"
C = "exhibition_id long, artist_name string, medium string"


def views(board):
    rows = lambda df: [tuple(r) for r in df.collect()]
    return rows(board.totals()), rows(board.ranking("source")), rows(board.ranking("city")), rows(board.ranking("artist", 6)), rows(board.ranking("medium", 3)), rows(board.timeline()), rows(board.cooccurrence(1, 1000))


def plain(parents, kids):
    def ranked(values, limit=None):
        out = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
        return out[:limit]

    named = [k for k in kids if (k[1] or "").strip() and "various" not in k[1].lower()]
    top = [n for n, _ in ranked((k[1] for k in named), 4)]
    by = {}
    for e, n, _ in named:
        if n in top and e is not None:
            by.setdefault(e, Counter())[n] += 1
    links = Counter()
    for c in by.values():
        for a in c:
            for b in c:
                if a < b:
                    links[a, b] += c[a] * c[b]
    dated = [(p[1], int(p[3][:4])) for p in parents if p[3]]
    years = sorted({y for _, y in dated if y >= 1920})
    grid = [(y, s, sum(d == (s, y) for d in dated)) for y in years for s in sorted({s for s, _ in dated}, key=lambda s: (s is not None, s or ""))]
    return (
        [(len(parents), len(kids))], ranked(p[1] for p in parents), ranked(p[2] for p in parents if p[2]), ranked((k[1] for k in named), 6),
        ranked((k[2] for k in kids if k[2]), 3), grid, [(a, b, n) for (a, b), n in sorted(links.items(), key=lambda x: (-x[1], x[0]))],
    )


def counted(parents, kids):
    """Stored counts by metric, key and part."""
    rows = [("parents", None, None)] * len(parents) + [("source", p[1], None) for p in parents] + [("city", p[2], None) for p in parents if p[2]]
    rows += [("year", p[1], p[3][:4] if p[3] >= "1900" else None) for p in parents if p[3]]
    rows += [("children", None, None)] * len(kids) + [("medium", k[2], None) for k in kids if k[2]]
    return Counter(rows + [("artist", k[1], None) for k in kids if k[1] and "various" not in k[1].lower()])


def test_ten_batches(spark):
    rng = random.Random(11)
    names = ["Ann", "Bo", "Cy", "Di", "Ed", "Flo", "Various Artists", "", None]
    made = iter(range(10_000))

    def new(favourite):
        i = next(made)
        return (i, rng.choice(("a", "b", None)), rng.choice(("x", "y", "", None)), rng.choice(("2001-01-01", "1999", "1850-01-01", "", None))), [
            (rng.choice((i, i, i, None)), rng.choice([*names, favourite, favourite]), rng.choice(("oil", "ink", "", None))) for _ in range(rng.randint(0, 6))
        ]

    stored = [new("Ann") for _ in range(30)]
    frames = lambda items, sign: [
        df.withColumn("sign", F.lit(sign)) for df in (spark.createDataFrame([p for p, _ in items], P), spark.createDataFrame([k for _, ks in items for k in ks], C))
    ]
    board = Dashboard.build(*(df.drop("sign") for df in frames(stored, 1)), tracked=4)
    heads = set()
    for batch in range(10):
        favourite = ("Bo", "Cy", "Flo", "Ed")[batch % 4]
        gone = rng.sample(stored, min(8, len(stored))) if batch != 6 else list(stored)
        added = [new(favourite) for _ in range(10)] if batch != 7 else []
        stored = [x for x in stored if x not in gone] + added
        (p1, k1), (p2, k2) = frames(added, 1), frames(gone, -1)
        board = board.apply(p1.union(p2), k1.union(k2), spark.createDataFrame([k for _, ks in stored for k in ks], C))
        parents, kids = [p for p, _ in stored], [k for _, ks in stored for k in ks]
        want = plain(parents, kids)
        assert Counter({(r.metric, r.key, r.part): r.n for r in board.counts.collect()}) == counted(parents, kids), batch
        assert [tuple(r) for r in board.cooccurrence(1, 1000).collect()] == want[-1], batch
        if batch in (4, 9):
            assert [list(map(tuple, x)) for x in views(board)] == [list(map(tuple, x)) for x in want], batch
        heads.add(frozenset(r["name"] for r in board.names.collect()))
    assert len(heads) > 3
