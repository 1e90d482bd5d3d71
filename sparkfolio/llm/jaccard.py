"""Exact n-gram Jaccard join of whole documents by grouped prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import WORD, row_slices, word_hashes
from sparkfolio.session import ship_package
from sparkfolio.storage import materialise

SHINGLE = 5
#: A pair links when 100 * intersection >= 75 * union.
SHARE = (75, 100)
_U = np.uint64
_HOT_BUFFER = 1 << 21  # shingles counted together when looking for frequent ones
SHORT = 64  # rows of a token that are compared with each other at once
PARTNERS = (2, 32)  # neighbours tried in longer ones, in rounds, before all are
BLOCK = 4096  # rows of a token that meet in one place; of more, blocks are compared pair by pair of blocks
_BITS = 22  # of the hashed set of documents that candidates name


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word 5-grams; fewer words: of the whole sequence."""
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    starts, _, ids = word_hashes(b" ".join(t or b"" for t in texts).lower())
    cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])).tolist()
    h = np.zeros(max(0, len(ids) - SHINGLE + 1), _U)
    for j in range(SHINGLE):
        h = (h + ids[j : j + len(h)]) * _U(0x9E3779B97F4A7C15)
        h ^= h >> _U(29)
    out = []
    for at, end in zip(cuts, cuts[1:]):
        n = end - at
        if n >= SHINGLE:
            out.append(_distinct(h[at : end - SHINGLE + 1]))
        elif n:
            out.append(np.array([xxhash.xxh64_intdigest(ids[at:end].tobytes(), seed=n)], _U))
        else:
            out.append(h[:0])
    return out


def class_of(shingles: np.ndarray) -> int | None:
    """64-bit id of a set; documents of equal sets are one class. None for the empty set."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.md5(shingles.tobytes()).digest()[:8], "little", signed=True)


def _slices(batches):
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 2 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            yield batch.slice(rows.start, len(rows))


def _classes(batches) -> Iterator[pa.RecordBatch]:
    """A row per document (doc_id, cid, n, sha256 of the text), and rows of shingles frequent among documents met together (hot, seen)."""
    pool, pooled, seen = [], 0, set()
    names = ["doc_id", "cid", "n", "hot", "seen", "sha"]
    kind = None

    def frequent():
        if pool:
            values, counts = np.unique(np.concatenate(pool), return_counts=True)
            keep = counts >= 2
            k = int(keep.sum())
            if k:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(k, kind), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(values[keep].view(np.int64)), pa.array(counts[keep]), pa.nulls(k, pa.binary())],
                    names,
                )

    for part in _slices(batches):
        kind = part.schema.field("doc_id").type
        texts = part.column("text").to_pylist()
        sets = shingle_sets(texts)
        shas = pa.array([hashlib.sha256(t or b"").digest() for t in texts], pa.binary())
        cids = [class_of(s) for s in sets]
        n = len(sets)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(cids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), shas],
            names,
        )
        for c, s in zip(cids, sets, strict=True):
            if c is not None and c not in seen:
                seen.add(c)
                pool.append(s)
                pooled += len(s)
        if pooled > _HOT_BUFFER:
            yield from frequent()
            pool, pooled, seen = [], 0, set()
    yield from frequent()


def _prefixes(batches, hot, share) -> Iterator[pa.RecordBatch]:
    """Index rows (token, gid, n, pos) of each group's prefix, rarest tokens first, and a row per class.

    gid stands for a prefix and a size. Class rows have pos -1, the gid as token, which spreads them, and the cid as gid.
    """
    part_, whole = share
    values, counts = hot.value
    seen, known = set(), set()
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    for part in _slices(batches):
        tok, gid, size, pos, classes = [], [], [], [], []
        for s in shingle_sets(part.column("text").to_pylist()):
            c = class_of(s)
            if c is None or c in seen:
                continue
            seen.add(c)
            n = len(s)
            if len(values):
                near = np.minimum(np.searchsorted(values, s), len(values) - 1)
                common = values[near] == s
                if common.any():
                    rest, by = s[common], counts[near[common]]
                    s = np.concatenate([s[~common], rest[np.lexsort((rest, by))]])
            p = n - -(-part_ * n // whole) + 1
            prefix = s[:p]
            g = int.from_bytes(hashlib.md5(prefix.tobytes() + n.to_bytes(8, "little")).digest()[:8], "little", signed=True)
            classes.append((g, c, n, -1))
            if g not in known:
                known.add(g)
                tok.append(prefix)
                gid.append(np.full(p, g))
                size.append(np.full(p, n))
                pos.append(np.arange(p))
        if len(seen) > 200_000:
            seen.clear()
            known.clear()
        names = ["token", "gid", "n", "pos"]
        if classes:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*classes, strict=True), kinds, strict=True)], names)
        if tok:
            t, g, n, q = (np.concatenate(x) for x in (tok, gid, size, pos))
            yield pa.RecordBatch.from_arrays(
                [pa.array(t.view(np.int64)), pa.array(g), pa.array(n, pa.int32()), pa.array(q, pa.int32())], names
            )


def fits(n1, p1, n2, p2, share=SHARE):
    """Length and positional filters for sets of n1 and n2 with their first common token at p1 and p2 (arrays or ints).

    Every pair that links passes at its first common token, where the tokens
    from there on bound the overlap; at later ones it need not.
    """
    part, whole = share
    small, large = np.minimum(n1, n2), np.maximum(n1, n2)
    most = np.minimum(n1 - p1, n2 - p2)
    return (whole * small >= part * large) & ((part + whole) * most >= part * (n1 + n2))


def _runs(batches, share) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (token, gid): trial pairs of groups, index rows of tokens with two groups or more, class rows.

    A token's first group is tried with all its others, and neighbours with
    each other; rows stream, only the first and the last of a token are held.
    """
    first = last = None
    given = False  # whether the held last row has gone out
    names = ["a", "b", "token", "gid", "cid", "n", "pos"]

    def rows(a=(), b=(), token=(), gid=(), cid=(), n=(), pos=()):
        size = max(map(len, (a, gid)))
        kinds = (pa.int64(),) * 5 + (pa.int32(),) * 2
        columns = (a, b, token, gid, cid, n, pos)
        return pa.RecordBatch.from_arrays([pa.array(x, k) if len(x) else pa.nulls(size, k) for x, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        pos = batch.column("pos").to_numpy()
        own = batch.filter(pa.array(pos < 0))
        if own.num_rows:
            yield rows(gid=own.column("token").to_numpy(), cid=own.column("gid").to_numpy(), n=own.column("n").to_numpy())
        batch = batch.filter(pa.array(pos >= 0)).select(["token", "gid", "n", "pos"])
        t, g, n, p = (x.to_numpy().astype(np.int64) for x in batch.columns)
        if not len(t):
            continue
        fresh = np.ones(len(t), bool)
        fresh[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
        if last is not None:
            fresh[0] = (t[0], g[0]) != last[:2]
        t, g, n, p = (x[fresh] for x in (t, g, n, p))
        if last is not None:
            t, g, n, p = (np.concatenate([[y], x]) for x, y in zip((t, g, n, p), last, strict=True))
        same = t[1:] == t[:-1]
        head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(t)), 0))
        hg, hn, hp = (x[head] for x in (g, n, p))
        if first is not None and first[0] == t[0]:
            hg, hn, hp = (np.where(head == 0, y, x) for x, y in zip((hg, hn, hp), first[1:], strict=True))
        i = np.flatnonzero(same) + 1
        pairs = [np.stack([g[i - 1], g[i]])[:, fits(n[i - 1], p[i - 1], n[i], p[i], share)]]
        pairs.append(np.stack([hg[i], g[i]])[:, fits(hn[i], hp[i], n[i], p[i], share)])
        both = np.concatenate(pairs, axis=1)
        both = np.sort(both[:, both[0] != both[1]], axis=0)
        if both.shape[1]:
            both = np.unique(both, axis=1)
            yield rows(a=both[0], b=both[1])
        # Rows of runs have an equal neighbour.
        member = np.zeros(len(t), bool)
        member[1:] |= same
        member[:-1] |= same
        out = member.copy()
        out[0] &= not given
        if out.any():
            yield rows(token=t[out], gid=g[out], n=n[out], pos=p[out])
        given = bool(member[-1]) or (len(t) == 1 and given)
        last = (t[-1], g[-1], n[-1], p[-1])
        first = (t[-1], hg[-1], hn[-1], hp[-1])


def _long_run(label, n, p, c, side, share) -> Iterator[np.ndarray]:
    """Pairs of one token's rows with different labels, of different sides or none, that pass the filters; rows of equal (side, label, n, pos) taken together."""
    order = np.lexsort((p, n, label, side))
    label, n, p, c, side = (x[order] for x in (label, n, p, c, side))
    new = np.ones(len(c), bool)
    new[1:] = (label[1:] != label[:-1]) | (n[1:] != n[:-1]) | (p[1:] != p[:-1]) | (side[1:] != side[:-1])
    at = np.append(np.flatnonzero(new), len(c))
    label, n, p, side = (x[at[:-1]] for x in (label, n, p, side))
    for i in range(len(label) - 1):
        ok = (label[i + 1 :] != label[i]) & fits(n[i], p[i], n[i + 1 :], p[i + 1 :], share)
        if side[i]:
            ok &= side[i + 1 :] != side[i]
        for j in (np.flatnonzero(ok) + i + 1).tolist():
            mine, other = c[at[i] : at[i + 1]], c[at[j] : at[j + 1]]
            for k in range(0, len(mine), 1000):
                cut = mine[k : k + 1000]
                yield np.stack([np.repeat(cut, len(other)), np.tile(other, len(cut))])


def _partners(t, label, n, p, c, share, partners: int) -> Iterator[np.ndarray]:
    """Pairs of one token's rows that are neighbours up to ``partners`` places apart in an order that differs by token."""
    h = (c.astype(_U) ^ t.astype(_U) * _U(0x9E3779B97F4A7C15)) * _U(0xFF51AFD7ED558CCD)
    order = np.argsort(h ^ h >> _U(32), kind="stable")
    label, n, p, c = (x[order] for x in (label, n, p, c))
    for d in range(1, partners + 1):
        ok = (label[d:] != label[:-d]) & fits(n[:-d], p[:-d], n[d:], p[d:], share)
        yield np.stack([c[:-d][ok], c[d:][ok]])


def _cross(batches, share, partners: int | None = None, most: int = 1 << 20, short: int = SHORT) -> Iterator[pa.RecordBatch]:
    """From rows (token, label, n, pos, cid, side) sorted by token: pairs of different labels that pass the filters.

    Rows of side 1 only pair with those of side 2; side 0 is a token, or a
    block of one, within itself. Tokens with up to ``short`` rows are compared at each distance at once and
    give all pairs; others give all, one by one, or those of a few partners.
    """
    made: list[np.ndarray] = []
    held: list[list[np.ndarray]] = []  # rows of the last token met

    def flush():
        both = np.sort(np.concatenate(made, axis=1), axis=0)
        made.clear()
        both = both[:, np.lexsort(both[::-1])]
        keep = np.ones(both.shape[1], bool)
        keep[1:] = (both[:, 1:] != both[:, :-1]).any(0)
        a, b = both[:, keep]
        for i in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 100_000]), pa.array(b[i : i + 100_000])], ["a", "b"])

    def compare(t, label, n, p, c, side):
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        length = np.diff(np.append(first, len(t)))
        brief = np.repeat(length <= short, length)
        for d in range(1, min(short, int(length.max()))):
            i = np.flatnonzero((t[d:] == t[:-d]) & brief[d:])
            i = i[(label[i] != label[i + d]) & fits(n[i], p[i], n[i + d], p[i + d], share) & ((side[i] == 0) | (side[i] != side[i + d]))]
            if len(i):
                yield np.stack([c[i], c[i + d]])
        for at, m in zip(first[length > short].tolist(), length[length > short].tolist(), strict=True):
            if partners:
                yield from _partners(*(x[at : at + m] for x in (t, label, n, p, c)), share, partners)
            else:
                yield from _long_run(*(x[at : at + m] for x in (label, n, p, c, side)), share)

    def take(pieces):
        total = sum(x.shape[1] for x in made)
        for piece in pieces:
            made.append(piece)
            total += piece.shape[1]
            if total > most:
                yield from flush()
                total = 0

    for batch in batches:
        rows = [x.to_numpy().astype(np.int64) for x in batch.columns]
        if not len(rows[0]):
            continue
        if held and rows[0][-1] == held[0][0][-1]:
            held.append(rows)
            continue
        rows = [np.concatenate(x) for x in zip(*held, rows, strict=True)]
        cut = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1 if rows[0][0] != rows[0][-1] else 0
        if cut:
            yield from take(compare(*(x[:cut] for x in rows)))
        held = [[x[cut:] for x in rows]]
    if held:
        yield from take(compare(*(np.concatenate(x) for x in zip(*held, strict=True))))
    if made:
        yield from flush()


def _wanted_texts(batches, wanted) -> Iterator[pa.RecordBatch]:
    """(doc_id, cid, packed text) of documents whose hashed id is in the bitmap ``wanted``."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for part in _slices(batches):
        part = part.filter(pa.array(wanted.value[part.column("h").to_numpy()]))
        if part.num_rows:
            texts = part.column("text").to_pylist()
            cids = [class_of(s) for s in shingle_sets(texts)]
            packed = pa.array([None if t is None else pack(t) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cids, pa.int64()), packed], ["doc_id", "cid", "text"])


def _verify(batches, share) -> Iterator[pa.RecordBatch]:
    part, whole = share
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        texts = batch.column("ta"), batch.column("tb")
        for rows in row_slices(batch, 1 << 20, lambda i: 64 + sum(x[i].as_buffer().size for x in texts)):  # noqa: B023
            place = {c: (x, i) for i in rows for c, x in ((a[i], texts[0]), (b[i], texts[1]))}
            sets = dict(zip(place, shingle_sets([unpack(x[i].as_py()) for x, i in place.values()]), strict=True))
            keep = []
            for i in rows:
                u, v = sets[a[i]], sets[b[i]]
                both = np.sort(np.concatenate([u, v]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(whole * shared >= part * (len(u) + len(v) - shared))
            yield batch.slice(rows.start, len(rows)).select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def blocked(rows: DataFrame, partners: int | None) -> DataFrame:
    """Rows (token, k, label, n, pos, cid) of tokens with k rows, dealt so that about ``BLOCK`` of a token meet: token, label, n, pos, cid, side.

    Where neighbours are tried, each block stands alone. Where all pairs are,
    each two blocks of a token meet once, as sides 1 and 2, and each block
    meets itself.
    """
    d = rows.withColumn("_b", F.ceil(F.col("k") / BLOCK)).withColumn("_mine", F.pmod(F.xxhash64("cid"), F.col("_b")))
    one = F.col("_b") <= 1
    if partners:
        d = d.withColumn("token", F.when(one, F.col("token")).otherwise(F.xxhash64("token", "_mine"))).withColumn("side", F.lit(0))
    else:
        d = d.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1)))
        low, high = F.least("_mine", "_other"), F.greatest("_mine", "_other")
        d = d.withColumn("side", F.when(low == high, 0).when(F.col("_mine") == low, 1).otherwise(2))
        d = d.withColumn("token", F.when(one, F.col("token")).otherwise(F.xxhash64("token", low, high)))
    return d.select("token", "label", "n", "pos", "cid", "side")


def links_among(docs: DataFrame, classes: DataFrame, pairs: DataFrame, share=SHARE) -> DataFrame:
    """Those of the class pairs (a, b) whose sets reach the similarity, by comparing the whole sets.

    Texts move, packed, rather than their sets, which take several times the space.
    """
    spark = docs.sparkSession
    named = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "cid")
    named = materialise(named.join(classes, "cid").select("cid", "rep"), "nj-named")
    bits = np.zeros(1 << _BITS, bool)
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << _BITS)).cast("int")
    bits[named.select(slot("rep").alias("h")).distinct().toArrow().column("h").to_numpy()] = True
    wanted = spark.sparkContext.broadcast(bits)
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", slot("doc_id").alias("h"), F.col("text").cast("binary").alias("text"))
    texts = texts.mapInArrow(lambda b: _wanted_texts(b, wanted), f"doc_id {kind}, cid long, text binary")
    texts = texts.join(named, "cid").filter(F.col("doc_id").eqNullSafe(F.col("rep"))).select("cid", "text")
    one = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(lambda b: _verify(b, share), "a long, b long").distinct()


def _contracted(batches, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) as edges from each node to the least one that it reaches over edges met together (about ``most`` at once)."""
    held: list[np.ndarray] = []

    def contract():
        nodes, number = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        u, v = number.reshape(2, -1)
        root = np.arange(len(nodes))
        while (apart := root[u] != root[v]).any():
            u, v = u[apart], v[apart]
            np.minimum.at(root, np.maximum(root[u], root[v]), np.minimum(root[u], root[v]))
            while (root[root] != root).any():
                root = root[root]
        own = np.flatnonzero(root != np.arange(len(nodes)))
        held[:] = [np.stack([nodes[own], nodes[root[own]]])]

    def give():
        for i in range(0, held[0].shape[1], 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000]) for x in held[0]], ["u", "v"])
        held.clear()

    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([x.to_numpy() for x in batch.columns]))
        if sum(x.shape[1] for x in held) > most:
            contract()
            if held[0].shape[1] > most // 2:
                yield from give()
    if held:
        contract()
        yield from give()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): the least node of each connected component of edges (a, b), for nodes with an edge.

    Each task first contracts the edges that it reads; rounds of a large star
    and a small star follow until all that is left are stars. Minima are
    combined before each shuffle and joined back, so a node with very many
    edges splits.
    """
    contracted = lambda x: materialise(x.mapInArrow(_contracted, "u long, v long"), "cc")
    e = contracted(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    for _ in range(most_rounds):
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(e.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up + down > 1 and up > 0").isEmpty():
            break
        sym = e.union(e.select("v", "u"))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = sym.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u")
        small = small.select("v", "m").filter("v <> m").union(low.select("u", "m")).distinct()
        e = contracted(small.toDF("u", "v"))
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """Components of documents linked by the Jaccard similarity of their 5-word shingles.

    Words are lower-cased runs of non-blanks. Documents of equal sets form a
    class (sets compare by 64-bit shingle hashes). Classes with the same
    prefix and size form a group; an inverted index of prefix tokens,
    frequent ones last, gives groups that share a token. First, each token's
    groups are tried along a star and a chain, and members with their group's
    least, and classes with a few neighbours of each frequent token; then every
    pair that shares a token, passes the length and positional filters and is
    not yet in one component is compared. So no pair is lost, and a large
    group of copies needs few comparisons.

    Returns doc_id, n_shingles, class_id, component_id, a row per input row;
    class_id is null for the empty set. Null or wordless text: no shingles,
    linked with nothing, component_id is the row's doc_id. Equal texts
    share the least doc_id that is not null. Empty input: no rows. Extra
    columns are ignored.
    """
    return _labelled(docs, share).select("doc_id", "n_shingles", "class_id", "component_id")


def _labelled(docs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``near_duplicates`` with sha, the sha256 of the text, and label, a number of the component (null for the empty set)."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    d = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    told = materialise(d.mapInArrow(_classes, f"doc_id {kind}, cid long, n long, hot long, seen long, sha binary"), "nj-classes")
    rows = told.filter("n is not null").select("doc_id", "cid", "n", "sha")
    classes = materialise(rows.filter("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("rep")), "nj-reps")

    hot = told.filter("hot is not null").groupBy("hot").agg(F.sum("seen").alias("seen"))
    total = told.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    top = hot.filter(F.col("seen") >= max(8, total >> 20)).toArrow()  # at most 2**20 rows
    values, counts = top.column("hot").to_numpy().view(_U), top.column("seen").to_numpy()
    order = np.argsort(values)
    frequent = spark.sparkContext.broadcast((values[order], counts[order]))
    index = d.mapInArrow(lambda b: _prefixes(b, frequent, share), "token long, gid long, n int, pos int")
    ran = index.repartition("token").sortWithinPartitions("token", "gid")
    ran = ran.mapInArrow(lambda b: _runs(b, share), "a long, b long, token long, gid long, cid long, n int, pos int")
    ran = materialise(ran, "nj-runs")
    members = ran.filter("cid is not null").select("gid", "cid", "n").distinct()
    lead = materialise(members.groupBy("gid").agg(F.min("cid").alias("lead"), F.count("*").alias("k")), "nj-lead")
    inside = members.join(lead.filter("k > 1"), "gid").filter("cid <> lead").select("lead", "cid")
    pairs = ran.filter("a is not null").select("a", "b").distinct()
    for c in ("a", "b"):
        pairs = pairs.join(lead.select(F.col("gid").alias(c), F.col("lead").alias(f"lead_{c}")), c)
    trial = pairs.select("lead_a", "lead_b").union(inside).toDF("a", "b").filter("a <> b")
    trial = materialise(trial.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "nj-trial")
    label = materialise(components(links_among(docs, classes, trial, share)), "nj-label")

    # Tokens and groups that still see more than one component. The long ones first try a few partners, since
    # most of their classes then meet in one component, and are compared whole only where they do not.
    tried, index_rows, told_by = trial, ran.filter("token is not null").select("token", "gid", "n", "pos"), None
    for i, partners in enumerate((*PARTNERS, None)):
        if label is not told_by:
            told_by, known = label, members.join(label, members["cid"] == label["node"], "left")
            known = materialise(known.select("gid", "cid", "n", F.coalesce("label", "cid").alias("label")), "nj-known")
            span = known.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("k"))
        mixed = index_rows.join(span, "gid").groupBy("token")
        mixed = mixed.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("k").alias("k")).filter("lo <> hi")
        mixed = materialise(mixed.select("token", "k"), "nj-mixed")
        own = span.filter((F.col("lo") != F.col("hi")) & (F.lit(i == 0) | (F.col("k") > SHORT)))
        own = known.join(own.select("gid", "k"), "gid")
        own = own.select(F.col("gid").alias("token"), "k", "label", "n", F.lit(0).alias("pos"), "cid")
        open_rows = index_rows.join(mixed, "token").join(known.drop("n"), "gid")
        rest = blocked(open_rows.select("token", "k", "label", "n", "pos", "cid").union(own), partners)
        rest = rest.repartition("token").sortWithinPartitions("token")
        rest = rest.mapInArrow(lambda b, partners=partners: _cross(b, share, partners), "a long, b long").distinct()
        rest = materialise(rest.join(tried, ["a", "b"], "left_anti"), "nj-rest")
        if not rest.isEmpty():
            more = materialise(links_among(docs, classes, rest, share), "nj-more")
            if not more.isEmpty():
                label = materialise(components(label.toDF("a", "b").union(more)), "nj-label")
        tried = tried.union(rest)
        if mixed.filter(F.col("k") > SHORT).isEmpty() and span.filter(F.col("k") > SHORT).isEmpty():
            break
        if partners:  # written, so that later rounds move the rows of long tokens only
            index_rows = materialise(index_rows.join(mixed.filter(F.col("k") > SHORT).select("token"), "token", "left_semi"), "nj-long")

    whole = classes.join(label, classes["cid"] == label["node"], "left").select("cid", "rep", F.coalesce("label", "cid").alias("label"))
    least = whole.groupBy("label").agg(F.min("rep").alias("component_id"))
    whole = whole.join(least, "label").select(F.col("cid").alias("_cid"), "component_id", "label")
    out = rows.join(whole, rows["cid"] == F.col("_cid"), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("cid").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"),
        "sha", "label",
    )


def keep_one(docs: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, null last, then of the least sha256; columns unchanged.

    Rows are told apart by doc_id and text, so null and repeated ids count row
    by row; of rows equal in both, one stays. Rows without a word are linked
    with nothing and all stay.
    """
    found = _labelled(docs, share).filter("label is not null")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")
    stay = found.groupBy("label").agg(F.min(row).alias("row"))
    stay = materialise(stay.select(F.col("row.doc_id").alias("_stay"), F.col("row.sha").alias("_sha")), "nj-stay")
    wordy = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    mine = F.unhex(F.sha2(docs["text"].cast("binary"), 256))
    out = docs.filter(wordy).join(stay, docs["doc_id"].eqNullSafe(stay["_stay"]) & (mine == stay["_sha"]), "left_semi")
    if out.count() > stay.count():
        out = out.dropDuplicates(["doc_id", "text"])
    return out.union(docs.filter(~wordy))
