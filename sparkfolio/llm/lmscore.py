"""Language-model scoring by online logistic mixing of bit predictors in hashed contexts.

A text is coded as its tokens (lower-cased words, then one end) by binary
decisions. All but two kinds are predicted by a mixture of several predictors
whose weights and refinement learn along each text (``lmbits.mix_online``):

* Match. Some places are anchors: where the hash of the three tokens before
  them is 0 in its last four bits, and behind a text's third token. The tokens
  from an anchor to the next are its run. Where the anchor came in other texts
  of the corpus, the run most frequent there predicts token by token until it
  first fails; else the token behind the last place in this text with the same
  three tokens before it does. One bit a token tells whether the token is the
  predicted one. If so, it is coded.
* Another bit tells whether the token came before in this text.
* The token itself is coded by the bits of its Shannon code: frequent tokens
  have one each, all others share one (``Code``). The bits are predicted from
  what this text (so far) and the other texts have at the code's node, alone and
  after the last token. Of the tokens without a code of their own, an old one is
  told by bits of its hash, a new one that other texts know by the bits of its
  level (the logarithm of its count); no context tells those of a level apart.
* Not mixed here: the bit that tells new tokens that no other text knows is a
  Krichevsky-Trofimov count. Such a token is spelled, byte by byte and bit by
  bit, by a mixture fitted to all words that one training text alone has.

What the corpus supplies - a count of every token, every run after every
anchor - is gathered in shuffled tables and grows with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.lmbits import END, fit_speller, mix_online
from sparkfolio.llm.text import fold_of, row_slices, word_hashes
from sparkfolio.session import ship_package
from sparkfolio.storage import drop, materialise, written

_U = np.uint64
_END_HASH = _U(0x5851F42D4C957F2D)
ORDER = 3  # tokens before an anchor
EVERY = _U(16)  # places to an anchor, on average
SLICE = 2 << 20  # bytes of texts read at once
CODE_SLICE = 1 << 20  # bytes of texts coded at once
KEPT = 1_500_000  # distinct tokens and runs kept in a task before they are given out
VOCAB, ANCHOR, OLD = 0, 1, 2  # kinds of counted rows
_BUCKET = 1 << 15  # bits in one of Spark's bitmaps
N_OLD = 1024 + 4096 + 128 + 512
#: States of a run: no prediction, missed or hit by the text's own.
NONE, OWN_MISS, OWN_HIT = range(3)
CODED = 1 << 20  # tokens with a code of their own make up at least 1 / CODED of all tokens, or of 2 tokens
LEVEL_BITS, HASH_BITS = 5, 8
PAIR_DEPTH = 8  # bits of a token's code that are predicted after the last token, and of that token's code that tell it
PAIR_CLASSES = (1 << PAIR_DEPTH) + 2  # the last token: by the first bits of its code, without a code, none


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> _U(32)) * _U(0xD6E8FEB86659FD93)
    return h ^ h >> _U(29)


@dataclass
class Tokens:
    """Token hashes of some texts, end tokens included, and where each token came before in its text."""

    ids: np.ndarray
    first: np.ndarray  # first token of each text, and the end of the last
    owner: np.ndarray
    at: np.ndarray  # place in the text
    before: np.ndarray  # times the token came before in the text
    head: np.ndarray  # first place of each (text, token)
    count: np.ndarray  # times of each (text, token)
    blob: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    entry: np.ndarray  # number of each token's (text, token) in head and count

    def words(self, places: np.ndarray) -> pa.Array:
        """The bytes of the tokens at ``places``."""
        n = len(self.lengths)
        offsets = np.append(np.stack([self.starts, self.starts + self.lengths], axis=1), len(self.blob))
        words = pa.Array.from_buffers(pa.large_binary(), 2 * n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.blob)])
        is_end = self.ids[places] == _END_HASH
        # Words and the blanks behind them take turns; the words' own come first.
        words = pa.chunked_array([words.take(pa.array(2 * (places - self.owner[places])[~is_end])), pa.array([END], pa.large_binary())]).combine_chunks()
        at = np.where(is_end, len(words) - 1, np.cumsum(~is_end) - 1)
        return words.take(pa.array(at)).cast(pa.binary())


def grouped(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that bring equal rows of ``columns`` together, in order, and where each group begins; ``key`` is a hash of rows."""
    n = len(key)
    if n <= 1 << 20:
        low = _U((1 << 20) - 1)
        order = np.sort((key & ~low) | np.arange(n, dtype=_U))
        fresh = np.concatenate([[True], order[1:] >> _U(20) != order[:-1] >> _U(20)])[:n]
        order = (order & low).astype(np.int64)
        next_, last = order[1:][~fresh[1:]], order[:-1][~fresh[1:]]
        if all((x[next_] == x[last]).all() for x in columns):
            return order, np.flatnonzero(fresh)
    order = np.lexsort(columns)
    fresh = np.ones(n, bool)
    fresh[1:] = np.any([x[order[1:]] != x[order[:-1]] for x in columns], axis=0)
    return order, np.flatnonzero(fresh)


class Index:
    """Finds hashes among sorted ones, from a table of where those with the same first bits begin."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = max(len(hashes), 1).bit_length()
        self.shift = _U(64 - bits)
        self.begin = np.searchsorted(hashes, np.arange(1 << bits, dtype=_U) << self.shift).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each of ``h``; how many there are for those that aren't among them."""
        n = len(self.hashes)
        out = self.begin.take(h >> self.shift).astype(np.int64)
        open_ = np.arange(len(h))
        while True:
            at = out.take(open_)
            open_ = open_[at < n]
            at = at[at < n]
            found = self.hashes.take(at)
            out[open_[found > h[open_]]] = n
            open_ = open_[found < h[open_]]
            if not len(open_):
                return out
            out[open_] += 1


def read_tokens(texts: list[bytes | None]) -> Tokens:
    sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    blob = b" ".join(t or b"" for t in texts).lower()
    starts, lengths, h = word_hashes(blob)
    cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    cuts[-1] = len(h)
    first = cuts + np.arange(len(cuts))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    ids = np.empty(len(owner), _U)
    ends = first[1:] - 1
    rest = np.ones(len(ids), bool)
    rest[ends] = False
    ids[rest], ids[ends] = h, _END_HASH
    n = len(ids)
    # Sorted by a hash of (text, token), then by place.
    order, begin = grouped(_mix(ids + (owner.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)), ids, owner)
    count = np.diff(np.append(begin, n))
    before = np.empty(n, np.int64)
    before[order] = np.arange(n) - np.repeat(begin, count)
    entry = np.empty(n, np.int64)
    entry[order] = np.repeat(np.arange(len(begin)), count)
    return Tokens(ids, first, owner, np.arange(n) - first[owner], before, order[begin], count, np.frombuffer(blob, np.uint8), starts, lengths, entry)


@dataclass
class Runs:
    """Anchors of some texts with the runs that follow them."""

    place: np.ndarray
    text: np.ndarray
    anchor: np.ndarray
    run: np.ndarray
    own: np.ndarray  # NONE, OWN_MISS or OWN_HIT
    times: np.ndarray  # of the anchor in its text
    alike: np.ndarray  # whether all its runs there are equal
    of_token: np.ndarray  # run number of each token, 0 for those before the text's first anchor


def last_tokens(t: Tokens) -> np.ndarray:
    """Hash of the ``ORDER`` tokens before each place; of no use at a text's first ones."""
    n = len(t.ids)
    c = np.zeros(n, _U)
    for j in range(1, ORDER + 1):
        c[ORDER:] = _mix(c[ORDER:] * _U(0x9E3779B97F4A7C15) + t.ids[ORDER - j : n - j])
    return c


def check_bits(ids: np.ndarray) -> np.ndarray:
    """What a run keeps of its tokens."""
    return (ids >> _U(40)).astype(np.uint16)


def run_tokens(t: Tokens, q: Runs) -> pa.Array:
    """The tokens of each run, two bytes each."""
    inside = np.flatnonzero(q.of_token)
    offsets = np.append(np.searchsorted(inside, q.place), len(inside)) * 2
    data = np.ascontiguousarray(check_bits(t.ids[inside]))
    return pa.Array.from_buffers(pa.binary(), len(q.place), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def read_runs(t: Tokens) -> Runs:
    n = len(t.ids)
    c = last_tokens(t)
    opening = t.at == ORDER
    is_anchor = opening | ((t.at > ORDER) & (c % EVERY == 0))
    place = np.flatnonzero(is_anchor)
    text = t.owner[place]
    anchor = c[place] ^ np.where(opening[place], _U(0xA5A5A5A5A5A5A5A5), _U(0))
    number = np.cumsum(is_anchor)
    before_text = np.concatenate([[0], number])[t.first[:-1]]
    of_token = number - before_text[t.owner]
    if len(place):
        offset = np.arange(n) - place[np.maximum(number - 1, 0)]
        term = np.where(t.at >= ORDER, _mix(t.ids + offset.astype(_U) * _U(0x8CB92BA72F3D8DD7)), _U(0))
        run = _mix(np.add.reduceat(term, place))
    else:
        run = np.zeros(0, _U)
    order = np.lexsort((place, anchor, text))
    a, x, r = anchor[order], text[order], run[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (x[1:] != x[:-1])
    begin = np.flatnonzero(fresh)
    times = np.diff(np.append(begin, len(order)))
    same = np.ones(len(order), bool)
    same[1:] = fresh[1:] | (r[1:] == r[:-1])
    own, all_times, alike = np.zeros(len(order), np.int8), np.zeros(len(order), np.int64), np.zeros(len(order), bool)
    own[order] = np.where(fresh, NONE, np.where(same, OWN_HIT, OWN_MISS))
    all_times[order] = np.repeat(times, times)
    alike[order] = np.repeat(np.logical_and.reduceat(same, begin), times) if len(begin) else same
    return Runs(place, text, anchor, run, own, all_times, alike, of_token)


def old_slots(t: Tokens) -> np.ndarray:
    """Slots (tokens, predictors) that predict whether a token came before in its text, from the tokens before it."""
    n = len(t.ids)
    old = (t.before > 0).astype(np.int64)
    far = np.frexp((np.minimum(t.at, 1 << 15) + 1).astype(np.float32))[1] - np.int64(1)
    far = np.minimum(far, 15)
    history, was, at = np.zeros(n, np.uint8), old.astype(np.uint8), np.minimum(t.at, 7).astype(np.uint8)
    for j in range(1, 7):
        history[j:] |= (at[j:] >= j) * was[:-j] << (j - 1)
    last_id, last_before = np.zeros(n, _U), np.zeros(n, np.int64)
    inside = t.at > 0
    last_id[1:] = np.where(inside[1:], t.ids[:-1], _U(0))
    last_before[1:] = np.where(inside[1:], np.minimum(t.before[:-1], 7), 0)
    fresh = np.cumsum(1 - old)
    distinct = fresh - (1 - old) - (fresh - (1 - old))[t.first[:-1]][t.owner]
    ratio = distinct * 31 // np.maximum(t.at, 1)
    return np.stack([far * 64 + history, 1024 + (last_id >> _U(52)).astype(np.int64), 5120 + far * 8 + last_before, 5248 + far * 32 + ratio], axis=1)


def _text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = batch.column("text")
    for rows in row_slices(batch, SLICE, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):
        yield batch.slice(rows.start, len(rows))


def _gather(batches) -> Iterator[pa.RecordBatch]:
    """Partial counts (kind, k, r, n, held, df, token) of tokens, of runs after anchors, and of bits in slots.

    n counts training texts, held the others; df training texts with the token. A run's token is what it keeps of its tokens.
    """
    names = ["kind", "k", "r", "n", "held", "df", "token"]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    vocab: list[tuple] = []
    runs: list[np.ndarray] = []
    contents: list[pa.Array] = []
    kept = 0
    bits = np.zeros((2, N_OLD), np.int64)

    def merge(h, *counts):
        order, begin = grouped(h, h)
        first = order[begin]
        return first, (h[first], *(np.add.reduceat(x[order], begin) if len(h) else x for x in counts))

    def rows(kind, k, r, n, held, df, token):
        for i in range(0, len(k), 100_000):
            cut = slice(i, i + 100_000)
            m = len(k[cut])
            columns = (np.full(m, kind), k[cut].view(np.int64), r[cut].view(np.int64), n[cut], held[cut], df[cut])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, y) for x, y in zip(columns, kinds, strict=False)), token[i : i + 100_000] if token is not None else pa.nulls(m, pa.binary())], names
            )

    def flush():
        if vocab:
            parts = list(zip(*vocab, strict=True))
            first, (h, n, held, df) = merge(*(np.concatenate(x) for x in parts[:4]))
            yield from rows(VOCAB, h, np.zeros(len(h), _U), n, held, df, pa.concat_arrays(parts[4]).take(pa.array(first)))
        if runs:
            a, r, n, held = np.concatenate(runs, axis=1)
            order = np.lexsort((r, a))
            content = pa.concat_arrays(contents)
            a, r, n, held = (x[order] for x in (a, r, n, held))
            at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (r[1:] != r[:-1])])[: len(a)])
            if len(at):
                n, held = (np.add.reduceat(x, at).astype(np.int64) for x in (n, held))
                yield from rows(ANCHOR, a[at], r[at], n, held, np.zeros(len(at), np.int64), content.take(pa.array(order[at])))
        vocab.clear()
        runs.clear()
        contents.clear()

    for batch in batches:
        for part in _text_slices(batch):
            t = read_tokens(part.column("text").to_pylist())
            train = part.column("fold").to_numpy() != 0
            mine = train[t.owner[t.head]]
            first, counts = merge(t.ids[t.head], t.count * mine, t.count * ~mine, mine.astype(np.int64))
            vocab.append((*counts, pc.if_else(pa.array(counts[3] < 2), t.words(t.head[first]), pa.scalar(None, pa.binary()))))
            q = read_runs(t)
            mine = train[q.text]
            one = np.ones(len(mine), _U)
            runs.append(np.stack([q.anchor, np.where(mine, q.run, _U(0)), one * mine, one * ~mine]))
            contents.append(pc.if_else(pa.array(mine), run_tokens(t, q), pa.scalar(b"", pa.binary())))
            mine = train[t.owner]
            slots = old_slots(t)[mine] * 2 + (t.before > 0)[mine, None]
            bits += np.bincount(slots.ravel(), minlength=2 * N_OLD).reshape(N_OLD, 2).T
            kept += len(vocab[-1][0]) + len(q.place)
            if kept > KEPT:
                yield from flush()
                kept = 0
    yield from flush()
    used = np.flatnonzero(bits.any(0))
    yield from rows(OLD, used, np.zeros(len(used), _U), bits[0, used], bits[1, used], np.zeros(len(used), np.int64), None)


def _reduce(batches) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (k, kind, r): sums of each (kind, k), and of an anchor's runs the two most frequent.

    Anchors that no other training text can use are left out. Rows stream: of
    the last k met, an anchor keeps its two best runs and the last one.
    """
    columns = ["kind", "k", "r", "n", "held", "df"]
    out_kinds = (pa.int32(), *(pa.int64(),) * 4, pa.binary(), *(pa.int64(),) * 4, pa.binary())
    names = ["kind", "k", "n", "held", "df", "token", "r1", "n1", "r2", "n2", "token2"]
    held_rows: list[np.ndarray] | None = None
    held_token = None

    def best_first(kind, k, r, n, held, df):
        order = np.lexsort((r, -n, k, kind))
        return [x[order] for x in (kind, k, r, n, held, df)], order

    def give(rows, token):
        rows, order = best_first(*rows)
        kind, k, r, n, held, df = rows
        at = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (k[1:] != k[:-1])])[: len(k)])
        if not len(at):
            return
        size = np.diff(np.append(at, len(k)))
        sums = [np.add.reduceat(x, at) for x in (n, held, df)]
        anchor = kind[at] == ANCHOR
        sums[0] = sums[0] + np.where(anchor, sums[2], 0)  # df holds the counts of runs let go
        two = np.minimum(at + 1, len(k) - 1)
        second = anchor & (size > 1)
        r1, n1, r2, n2 = r[at], n[at], np.where(second, r[two], 0), np.where(second, n[two], 0)
        ok = ~anchor | (sums[0] > 1) | ((sums[1] > 0) & (sums[0] > 0))
        token2 = token.take(pa.array(order[two], mask=~second))
        values = (kind[at], k[at], *sums, token.take(pa.array(order[at])), r1, n1, r2, n2, token2)
        keep = np.flatnonzero(ok)
        for i in range(0, len(keep), 100_000):
            cut = keep[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [x.take(pa.array(cut)) if isinstance(x, pa.Array) else pa.array(x[cut], y) for x, y in zip(values, out_kinds, strict=True)], names
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy().astype(np.int64) for c in columns]
        token = batch.column("token")
        if held_rows is not None:
            rows = [np.concatenate(x) for x in zip(held_rows, rows, strict=True)]
            token = pa.concat_arrays([held_token, token])
        kind, k, r = rows[:3]
        at = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (k[1:] != k[:-1]) | (r[1:] != r[:-1])]))
        rows = [*(x[at] for x in rows[:3]), *(np.add.reduceat(x, at) for x in rows[3:])]
        token = token.take(pa.array(at))
        new = (rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])
        cut = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
        yield from give([x[:cut] for x in rows], token[:cut])
        tail, held_token = [x[cut:] for x in rows], token[cut:]
        if len(tail[0]) > 64 and tail[0][0] == ANCHOR:
            body, order = best_first(*(x[:-1] for x in tail))
            body[5][0] += body[3][2:].sum() + body[5][1:].sum()
            body[4][0] += body[4][1:].sum()
            tail = [np.append(x[:2], y[-1:]) for x, y in zip(body, tail, strict=True)]
            tail[4][1], tail[5][1] = 0, 0
            held_token = held_token.take(pa.array([*order[:2], len(held_token) - 1]))
        held_rows = tail
    if held_rows is not None:
        yield from give(held_rows, held_token)


@dataclass
class Code:
    """A prefix code of tokens: Shannon's lengths by training counts, or one bit less. Tokens without a code of their own share one."""

    h: np.ndarray  # hashes of coded tokens, sorted
    n: np.ndarray  # their training counts
    left: np.ndarray  # their codes, filled up to ``bits`` bits; the last is the shared one
    size: np.ndarray  # lengths of the codes
    bits: int
    nodes: np.ndarray  # (zeros, ones) at each node of the code's tree in training texts
    levels: np.ndarray  # the same of the levels' tree
    level_tokens: np.ndarray  # tokens of each level

    @cached_property
    def index(self) -> Index:
        return Index(self.h)


def level_of(n: np.ndarray) -> np.ndarray:
    """Binary digits of counts."""
    return np.minimum(np.frexp(n.astype(np.float64))[1], (1 << LEVEL_BITS) - 1).astype(np.int64)


def _tree(left: np.ndarray, size: np.ndarray, bits: int, n: np.ndarray) -> np.ndarray:
    nodes = np.zeros((2, 1 << bits))
    for d in range(bits):
        on = size > d
        at, bit = left[on] >> (bits - d), left[on] >> (bits - 1 - d) & 1
        for y in (0, 1):
            nodes[y, 1 << d : 2 << d] = np.bincount(at[bit == y], n[on][bit == y], 1 << d)
    return np.ascontiguousarray(nodes.T.astype(np.float32))


def make_code(h: np.ndarray, n: np.ndarray, rest: int, level_n: np.ndarray, level_tokens: np.ndarray) -> Code:
    """From sorted hashes of tokens to code, their counts, the count of all others, and counts and tokens of their levels."""
    n = n.astype(np.int64)
    counts = np.append(n, max(rest, int(n.min(initial=1 << 62)) if len(n) else 1))
    total = int(counts.sum())
    size = np.maximum(np.ceil(np.log2(total / counts)), 0).astype(np.int64)
    size += counts * 2.0**size < total
    # What room the codes leave makes those shorter that gain most of it.
    gain = np.argsort(-counts * 2.0**size, kind="stable")
    gain = gain[size[gain] > 0]
    cost = 0.5 ** size[gain]
    size[gain] -= np.cumsum(cost) <= 1 - (0.5**size).sum()
    bits = int(size.max())
    order = np.argsort(-counts, kind="stable")
    order = order[np.argsort(size[order], kind="stable")]
    step = np.int64(1) << (bits - size[order])
    left = np.empty(len(counts), np.int64)
    left[order] = np.cumsum(step) - step
    each = np.arange(1 << LEVEL_BITS)
    return Code(h, n, left, size, bits, _tree(left, size, bits, counts), _tree(each, np.full(len(each), LEVEL_BITS), LEVEL_BITS, level_n), level_tokens)


@dataclass
class Symbols:
    """Codes of the tokens of some texts."""

    left: np.ndarray
    size: np.ndarray
    rest: np.ndarray  # whether the token has no code of its own
    pair: np.ndarray  # class of the token before


def read_symbols(t: Tokens, c: Code) -> Symbols:
    h = t.ids[t.head]
    near = c.index.find(h)
    coded = near < len(c.h)
    shift = c.bits - PAIR_DEPTH
    klass = np.where(coded, c.left[near] >> shift if shift > 0 else c.left[near] << -shift, PAIR_CLASSES - 2)[t.entry]
    pair = np.full(len(klass), PAIR_CLASSES - 1)
    pair[1:] = np.where(t.at[1:] > 0, klass[:-1], PAIR_CLASSES - 1)
    return Symbols(c.left[near][t.entry], c.size[near][t.entry], ~coded[t.entry], pair)


def count_pairs(t: Tokens, s: Symbols, train: np.ndarray, bits: int) -> np.ndarray:
    """How often training texts have each path (the first bits of a token's code, behind a one) after each class of token."""
    on = train[t.owner]
    size, left = np.minimum(s.size[on], PAIR_DEPTH), s.left[on]
    path = np.left_shift(1, size) | left >> (bits - size)
    return np.bincount(s.pair[on] << PAIR_DEPTH + 1 | path, minlength=PAIR_CLASSES << PAIR_DEPTH + 1)


def pair_bits(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at each slot (the class of the token before, the node), from counts of paths."""
    ends = paths.reshape(PAIR_CLASSES, 2 << PAIR_DEPTH).copy()
    for d in range(PAIR_DEPTH, 0, -1):  # who passes a node ends below it
        ends[:, 1 << d - 1 : 1 << d] += ends[:, 1 << d : 2 << d].reshape(PAIR_CLASSES, -1, 2).sum(2)
    below = ends.reshape(-1, 2)  # nodes 2k and 2k + 1 are those below k
    return below[:, 0] * _INNER, below[:, 1] * _INNER


_INNER = np.tile(np.arange(1 << PAIR_DEPTH) > 0, PAIR_CLASSES)


@dataclass
class Corpus:
    """What scoring needs of the whole corpus; sizes are bounded."""

    head: np.ndarray  # hashes of frequent tokens, sorted
    head_n: np.ndarray  # their training counts
    n_train: int
    n_vocab: int
    n_new: int  # first places of tokens in training texts
    n_single: int  # tokens that one training text alone has
    old: np.ndarray  # stretched predictions by slot
    code: Code

    @cached_property
    def index(self) -> Index:
        return Index(self.head)

    @property
    def scale(self) -> float:
        return float(np.log10(self.n_train + 0.1 * (self.n_vocab + 1)))

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Training counts of frequent tokens, 0 for others."""
        return np.append(self.head_n, 0).take(self.index.find(h))


def stretch_of(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + 0.4) / (n0 + 0.4))


def _two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), 2), np.float32)
    out[:, 0], out[:, 1] = a, b
    return out.view(np.complex64)[:, 0]


def _apart(table: np.ndarray, at: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Stretched predictions of counts in a table (slots, 2), a text's own taken out."""
    n = table.take(at, axis=0)
    return stretch_of(n[:, 0] - n0, n[:, 1] - n1)


def _lists(sizes: np.ndarray, kind: pa.StructType, *values: np.ndarray) -> pa.Array:
    rows = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(values, kind, strict=True)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), rows)


_PARTS = (
    "train boolean, text binary, anchors array<struct<a: bigint, r: bigint, times: int, place: int>>, "
    "rare array<struct<k: bigint, place: int>>, pairs array<struct<k: int, n: bigint, held: bigint>>"
)
_NAMES = ["rid", "doc_id", "train", "text", "anchors", "rare", "pairs"]
_ANCHOR = pa.struct([("a", pa.int64()), ("r", pa.int64()), ("times", pa.int32()), ("place", pa.int32())])
_RARE = pa.struct([("k", pa.int64()), ("place", pa.int32())])
_PAIR = pa.struct([("k", pa.int32()), ("n", pa.int64()), ("held", pa.int64())])


def usable_bits(anchors: DataFrame) -> np.ndarray:
    """A bitmap with a bit set for each anchor ``a``: at least 16 bits for each, but 32 MB at most."""
    size = min(1 << 28, max(_BUCKET, 1 << (16 * anchors.count()).bit_length()))
    at = F.pmod("a", F.lit(size)) + 1  # Spark's bitmaps count from 1
    maps = anchors.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for bucket, bits in maps.collect():  # at most 8192 of 4 KB
        out[(bucket - 1) * _BUCKET // 8 : bucket * _BUCKET // 8] = np.frombuffer(bits, np.uint8)
    return out


def has_bit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & _U(8 * len(bits) - 1)
    return (bits.take(at >> _U(3)) >> (at & _U(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def _ask(batches, head, usable) -> Iterator[pa.RecordBatch]:
    """A row per text: the text, anchors to look up, tokens to look up; and one (rid -1) that counts pairs."""
    from pyspark import TaskContext

    c: Corpus = head.value
    rid = TaskContext.get().partitionId() << 40
    paths, kind = np.zeros(PAIR_CLASSES << PAIR_DEPTH + 1, np.int64), None
    for batch in batches:
        kind = batch.column("doc_id").type
        for part in _text_slices(batch):
            t = read_tokens(part.column("text").to_pylist())
            q = read_runs(t)
            train = part.column("fold").to_numpy() != 0
            paths += count_pairs(t, read_symbols(t, c.code), train, c.code.bits)
            m = part.num_rows
            ask = np.flatnonzero((q.own == NONE) & q.alike & has_bit(usable.value, q.anchor))
            h, of = t.ids[t.head], t.owner[t.head]
            rare = np.flatnonzero(c.counts(h) <= t.count * train[of])
            rare = rare[np.argsort(of[rare], kind="stable")]
            anchors, tokens = np.bincount(q.text[ask], minlength=m), np.bincount(of[rare], minlength=m)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(rid, rid + m)), part.column("doc_id"), pa.array(train), part.column("text"),
                    _lists(anchors, _ANCHOR, q.anchor[ask].view(np.int64), q.run[ask].view(np.int64), q.times[ask], t.at[q.place[ask]]),
                    _lists(tokens, _RARE, h[rare].view(np.int64), t.at[t.head[rare]]), pa.nulls(m, pa.list_(_PAIR)),
                ],
                _NAMES,
            )
            rid += m
    if kind is not None:
        zeros, ones = pair_bits(paths)
        used = np.flatnonzero(zeros + ones)
        counts = _lists([len(used)], _PAIR, used, zeros[used], ones[used])
        columns = [pa.array([-1]), pa.nulls(1, kind), pa.array([False]), pa.nulls(1, pa.binary()), *(pa.nulls(1, pa.list_(x)) for x in (_ANCHOR, _RARE)), counts]
        yield pa.RecordBatch.from_arrays(columns, _NAMES)


def past(key: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Zeros and ones that came before each decision at its key (a hash), and that come there in all: four columns."""
    n = len(key)
    if not n:
        return np.zeros((0, 4), np.float32)
    shift = _U(max(1, n.bit_length()))
    low = (_U(1) << shift) - _U(1)
    order = np.sort((key & ~low) | np.arange(n, dtype=_U))
    group = order >> shift
    order = (order & low).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(begin, append=n)
    ones = np.concatenate([[0], np.cumsum(bit[order])])
    total = ones[begin + size] - ones[begin]
    rows = np.empty((n, 4), np.float32)
    rows[:, 1] = ones[:-1] - np.repeat(ones[begin], size)
    rows[:, 0] = np.arange(n) - np.repeat(begin, size) - rows[:, 1]
    rows[:, 2], rows[:, 3] = np.repeat(size - total, size), np.repeat(total, size)
    out = np.empty((n, 4), np.float32)
    out[order] = rows
    return out


def _key(owner: np.ndarray, what: np.ndarray) -> np.ndarray:
    return _mix((owner.astype(_U) << _U(32) | what.astype(_U)) * _U(0x9E3779B97F4A7C15))


def _by(key: np.ndarray) -> np.ndarray:
    """Stable order of keys (not negative)."""
    n = len(key)
    shift = n.bit_length()
    if n and int(key.max()) >> (63 - shift):
        return np.argsort(key, kind="stable")
    return np.sort(key << shift | np.arange(n)) & ((1 << shift) - 1)


def walk(group: np.ndarray, left: np.ndarray, size: np.ndarray, bits: int, coded: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
    """For the bits of places' codes: (places, depths, nodes, bits, zeros and ones of the place's group at its node, before
    it and in all), all but the first three as floats where they are counts.

    Groups have numbers, and the places of each are in order; ``left`` and ``size`` are codes of at most ``bits`` bits.
    Places of a group at a node stay together in order: each depth deals them to the two nodes below, until all of them
    have the same code; what is left of such codes is told at once, for ``coded`` places only. Totals count 0 where
    ``own`` is 0.
    """
    n = len(group)
    if not n or not bits:
        return
    # Places of the same code in a group; the depth from which they are alone at their node; their rank and number.
    order = _by(group << bits | left)
    key = (group << bits | left)[order]
    begin = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(begin, append=n)
    shared = bits - np.frexp((key[begin[1:]] ^ key[begin[:-1]]).astype(np.float64))[1].astype(np.int64)
    alone = np.maximum(np.maximum(np.append(-1, shared), np.append(shared, -1)) + 1, 0)
    end, rank, total = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    end[order], rank[order], total[order] = np.repeat(alone, times), np.arange(n) - np.repeat(begin, times), np.repeat(times, times)

    # A place's code, the depth where it is alone and its number in one value.
    places = _by(group)
    low, sizes = (1 << 32) - 1, np.bincount(group)
    packed, sizes = left[places] << 37 | end[places] << 32 | places, sizes[sizes > 0]
    for d in range(bits):
        begin = np.cumsum(sizes) - sizes
        head = packed.take(begin)
        more = (head >> 32 & 31) > d
        if not more.all():
            packed, sizes, head = packed[np.repeat(more, sizes)], sizes[more], head[more]
            begin = np.cumsum(sizes) - sizes
        if not len(packed):
            break
        bit = packed >> (36 + bits - d) & 1
        ones = np.zeros(len(bit) + 1, np.int64)
        np.cumsum(bit, out=ones[1:])
        base = ones.take(begin)
        all1 = ones.take(begin + sizes) - base
        all0 = sizes - all1
        start = np.repeat(begin, sizes)
        before1 = ones[:-1] - np.repeat(base, sizes)
        before0 = np.arange(len(packed)) - start
        before0 -= before1
        mine = own.take(head & low)
        node = packed >> (37 + bits - d)
        node |= 1 << d
        yield packed & low, d, node, bit, before0, before1, *(np.repeat((x * mine).astype(np.float32), sizes) for x in (all0, all1))
        start += np.where(bit, np.repeat(all0, sizes) + before1, before0)
        dealt = np.empty_like(packed)
        dealt[start] = packed
        packed = dealt
        sizes = np.stack([all0, all1], axis=1).reshape(-1)
        sizes = sizes[sizes > 0]

    left_over = np.maximum(size - end, 0) * coded
    at = np.repeat(np.arange(n), left_over)
    if not len(at):
        return
    depth = np.arange(len(at)) - np.repeat(np.cumsum(left_over) - left_over - end, left_over)
    node = left.take(at) >> (bits - 1 - depth)
    bit = node & 1
    node >>= 1
    node |= np.left_shift(1, depth)
    b, a = rank.take(at), (total * own).astype(np.float32).take(at)
    b1, a1 = b * bit, a * bit.astype(np.float32)
    yield at, depth, node, bit, b - b1, b1, a - a1, a1


def bit_costs(t: Tokens, s: Symbols, train: np.ndarray, others: np.ndarray, c: Code, pairs: np.ndarray, hit: np.ndarray | None = None) -> np.ndarray:
    """log10 probability of each token's identity, given whether it is old and whether others know it.

    ``others`` counts the token in other texts. Each bit mixes four
    predictors: counts at its node in this text so far and in other texts,
    alone and after the last token. A new token that others don't know learns, but costs nothing here. Tokens that the
    match has told (``hit``) are counted, but have no bits and cost nothing.
    """
    old = t.before > 0
    coded = np.ones(len(old), bool) if hit is None else ~hit
    hashed, levelled = s.rest & old, s.rest & ~old & (others > 0)
    sizes = np.where(coded, s.size + HASH_BITS * hashed + LEVEL_BITS * levelled, 0)
    start = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    first = np.append(start, n)[t.first]
    # Bits of tokens that are not coded fall behind the others. info: the bit, and 2 if the text has been at the node.
    room = max(c.bits + HASH_BITS + LEVEL_BITS, 64, int(np.diff(first).max(initial=0)) // 32)
    x, info = np.zeros((n + room, 4), np.float32), np.zeros(n + room, np.int8)
    start[~coded] = n
    two = x.view(np.complex64)  # pairs of predictors, which numpy deals faster than rows
    own = train[t.owner].astype(np.float64)
    most = int(np.diff(t.first).max(initial=0)) + 1
    log_few, log_some = (np.log(np.arange(most, dtype=np.float32) + np.float32(prior)) for prior in (0.05, 0.4))

    for on, d, node, bit, b0, b1, a0, a1 in walk(t.owner, s.left, s.size, c.bits, coded, own):
        to = start.take(on) + d
        two[to, 0] = _two(log_few.take(b1) - log_few.take(b0), _apart(c.nodes, node, a0, a1))
        info[to] = bit + 2 * (b0 + b1 > 0)
    depth = min(PAIR_DEPTH, c.bits)
    for on, d, node, bit, b0, b1, a0, a1 in walk(t.owner * PAIR_CLASSES + s.pair, s.left >> (c.bits - depth), np.minimum(s.size, depth), depth, coded, own):
        slot = s.pair.take(on) << PAIR_DEPTH
        slot |= node
        two[start.take(on) + d, 1] = _two(log_some.take(b1) - log_some.take(b0), _apart(pairs, slot, a0, a1))
    new = np.flatnonzero(levelled)
    level = level_of(others[new])
    for on, d, node, bit, b0, b1, _, _ in walk(t.owner[new], level, np.full(len(new), LEVEL_BITS), LEVEL_BITS, coded[new], own[new]):
        to = start[new[on]] + np.where(coded[new[on]], s.size[new[on]], 0) + d
        info[to] = bit + 2 * (b0 + b1 > 0)
        two[to, 0] = _two(log_few.take(b1) - log_few.take(b0), _apart(c.levels, node, 0, 0))
    rest = np.flatnonzero(s.rest)
    last = (t.ids[rest] >> _U(64 - HASH_BITS)).astype(np.int64)
    again = hashed[rest] & coded[rest]
    for on, d, _, bit, b0, b1, _, _ in walk(t.owner[rest], last, np.full(len(rest), HASH_BITS), HASH_BITS, again, own[rest]):
        at = again[on]
        to = (start[rest[on]] + s.size[rest[on]] + d)[at]
        info[to], x[to, 0] = bit[at] + 2, (log_few.take(b1) - log_few.take(b0))[at]
    info = info[:n]
    gate = (info >> 1) + 2 * np.repeat(old.view(np.int8), sizes)
    logp = np.concatenate([[0], np.cumsum(mix_online(x, info & 1 == 1, first, gate, 4, 64))])
    start = np.cumsum(sizes) - sizes
    cost = logp[start + sizes] - logp[start]
    # Tokens that share all bits: of old ones by counts, of new ones evenly.
    alike = past(_key(t.owner[rest], last), np.zeros(len(rest), np.int64))[:, 0]
    cost[rest[again]] += np.log10(t.before[rest[again]] / alike[again])
    cost[new] -= np.log10(c.level_tokens[level] + 1)
    return np.where(coded & (old | (others > 0)), cost, 0)


def match_costs(t: Tokens, at: np.ndarray, contents: pa.Array, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 probability of the bit that tells whether the predicted token came, 0 where none is predicted; whether it came).

    ``contents`` are the runs that other texts have behind the anchors ``at``, n times of ``total``.
    """
    size = len(t.ids)
    told, length, stat = np.zeros(size, np.int8), np.zeros(size, np.int64), np.zeros(size)
    # The text's own: what came behind the last place with the same tokens before it.
    inside = np.flatnonzero(t.at >= ORDER)
    key = _mix(last_tokens(t)[inside] ^ _key(t.owner[inside], np.zeros(len(inside))))
    order, begin = grouped(key, key)
    same = np.ones(len(order), bool)
    same[begin] = False
    same = np.flatnonzero(same)
    now, then = inside[order[same]], inside[order[same - 1]]
    told[now] = 1 + (t.ids[now] == t.ids[then])
    place = np.arange(size)
    length = place - np.maximum(np.maximum.accumulate(np.where(told == 2, -1, place)), t.first[t.owner] - 1)
    length[1:], length[:1] = length[:-1].copy(), 0
    kind = np.zeros(size, np.int64)
    # The corpus's: each run until it fails.
    sizes = pc.binary_length(contents).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    words = np.frombuffer(b"".join(contents.to_pylist()), np.uint16)
    start = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(sizes)), sizes)
    behind = np.arange(len(words)) - start[of]
    there = at[of] + behind
    ok = there < t.first[t.owner[at] + 1][of]
    miss = check_bits(t.ids[np.where(ok, there, 0)]) != words
    failed = np.cumsum(miss) - miss
    ok &= failed == failed[start[sizes > 0]][np.cumsum(sizes > 0)[of] - 1] if len(words) else ok
    told[there[ok]], kind[there[ok]] = 1 + ~miss[ok], 1
    length[there[ok]], stat[there[ok]] = behind[ok], stretch_of(total - n, n)[of[ok]]
    place = np.flatnonzero(told)
    hit, kind, length = told[place] == 2, kind[place], length[place]
    long = np.minimum(np.log2(length + 1), 7)
    x = np.zeros((len(place), 4), np.float32)
    for k, key in enumerate((kind, 2 + kind + 2 * long.astype(np.int64))):
        b0, b1, _, _ = past(_key(t.owner[place], key), hit).T
        x[:, k] = stretch_of(b0, b1)
    x[:, 2], x[:, 3] = stat[place], long
    cost = np.zeros(size)
    cost[place] = mix_online(x, hit, np.searchsorted(place, t.first), kind, 2, 4)
    return cost, told == 2


def _settle(batches, corpus, pairs) -> Iterator[pa.RecordBatch]:
    """From rows sorted by rid, a text's own first, then its answers: the scores of the texts."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not now.num_rows:
            continue
        rid = now.column("rid").to_numpy()
        start = np.searchsorted(rid, rid[-1])
        held = now.slice(start).combine_chunks().to_batches()[0]
        if start:
            yield from _settled(now.slice(0, start).combine_chunks().to_batches()[0], corpus.value, pairs.value)
    if held is not None:
        yield from _settled(held, corpus.value, pairs.value)


def _settled(rows: pa.RecordBatch, c: Corpus, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    own = np.flatnonzero(rows.column("key").to_numpy() < 0)
    docs = rows.take(pa.array(own))
    size = pc.fill_null(pc.binary_length(docs.column("text")), 0).to_numpy()
    own = np.append(own, rows.num_rows)
    for part in row_slices(docs, CODE_SLICE, lambda i: 64 + int(size[i])):
        answers = rows.slice(own[part.start], own[part.stop] - own[part.start])
        yield _scored(docs.slice(part.start, len(part)), answers, c, pairs)


def _scored(docs: pa.RecordBatch, rows: pa.RecordBatch, c: Corpus, pairs: np.ndarray) -> pa.RecordBatch:
    m = docs.num_rows
    t = read_tokens(docs.column("text").to_pylist())
    train = docs.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
    key = rows.column("key").to_numpy()
    of = np.cumsum(key < 0) - 1
    is_run, is_rare = (key >= 0) & (key & 1 == 1), (key >= 0) & (key & 1 == 0)
    at = t.first[of] + (key >> 1)
    flat = lambda name, which: rows.column(name).filter(pa.array(which)).to_numpy(zero_copy_only=False)
    # Counts of each (text, token).
    h, of_entry = t.ids[t.head], t.owner[t.head]
    n, spelled = c.counts(h), np.zeros(len(h))
    entry = t.entry[at[is_rare]]
    n[entry], spelled[entry] = flat("n", is_rare), np.nan_to_num(flat("spelled", is_rare).astype(np.float64))
    others = n - t.count * train[of_entry]
    known = np.bincount(of_entry, t.count * (n > 0), m).astype(np.int64)
    base = np.bincount(of_entry, t.count * (np.log10(n + 0.1) - c.scale), m)
    old = t.before > 0
    flags, hit = match_costs(t, at[is_run], rows.column("content").filter(pa.array(is_run)), flat("n", is_run), flat("total", is_run))
    cost = bit_costs(t, read_symbols(t, c.code), train, others[t.entry], c.code, pairs, hit)
    left = np.flatnonzero(~hit)  # what the match has told needs no other bit
    far = np.minimum(np.log2(t.at[left] // 32 + 1), 3).astype(np.int64)
    cost[left] += mix_online(c.old.take(old_slots(t)[left]), old[left], np.searchsorted(left, t.first), far, 4, 32)
    strange = others <= 0
    cost[t.head[strange]] += spelled[strange]
    score = np.bincount(t.owner, np.where(hit, 0, cost) + flags, m)
    # Krichevsky-Trofimov estimate of the bits that tell unknown tokens, started at the corpus's share.
    a = 0.5 + 10 * c.n_single / max(c.n_new, 1)
    b = 10.5 - 10 * c.n_single / max(c.n_new, 1)
    bare = ~hit[t.head]
    unknown, fresh = np.bincount(of_entry, strange & bare, m), np.bincount(of_entry, ~strange & bare, m)
    score += [kt(int(u), int(k), a, b) for u, k in zip(unknown, fresh, strict=True)]
    size = pc.fill_null(pc.binary_length(docs.column("text")), 0).to_numpy() + 1
    columns = {"doc_id": docs.column("doc_id"), "train": docs.column("train"), "n_tokens": pa.array(np.diff(t.first))}
    columns |= {"n_bytes": pa.array(size, pa.int64()), "n_known": pa.array(known), "base": pa.array(base.astype(np.float64)), "score": pa.array(score)}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def kt(u: int, k: int, a: float, b: float) -> float:
    """log10 probability of u ones and k zeros in any order, each predicted by (count + a or b) / (total + a + b)."""
    return (lgamma(u + a) + lgamma(k + b) - lgamma(u + k + a + b) - lgamma(a) - lgamma(b) + lgamma(a + b)) / np.log(10)


def _slot_counts(rows: DataFrame, size: int) -> np.ndarray:
    found = rows.groupBy("k").agg(F.sum("n").alias("n0"), F.sum("held").alias("n1")).toArrow()
    n = np.zeros((2, size))
    n[:, found.column("k").to_numpy()] = found.column("n0").to_numpy(), found.column("n1").to_numpy()
    return n


def score_texts(docs: DataFrame, head_bound: int = 1 << 22) -> DataFrame:
    """Score every whole text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Learns from rows whose crc32(doc_id as text) mod 10 is not 0. ``base_score``
    is the smoothed unigram log10 probability; ``score`` the model's, where a
    training text is coded by what the other texts tell: its own tokens and
    runs are taken out of the counts, so it compares with held-out ones and a
    text that occurs twice is told from one that occurs once. ``n_bytes``
    counts the text and one byte for its end, ``bits_per_byte`` the total bits
    of the code by them.

    Tokens that make up at least 1 / head_bound of all tokens (hence at most
    ``head_bound``, 16 bytes each) are scored from a broadcast table, all
    others and the anchors by joins; both give the same. Tokens, anchors and
    runs go by 64-bit hashes. Results don't depend on how rows are split or
    ordered, but for rounding.

    Null text: empty (one end token). Null doc_id: remainder 0, held out.
    Repeated rows each give a row, and each is a text of its own. Without
    training rows every count is 0 and all is spelled by an untrained model.
    Empty input: no rows. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    d = docs.select("doc_id", fold_of(F.col("doc_id"), 10).alias("fold"), F.col("text").cast("binary").alias("text"))
    counted = d.select("fold", "text").mapInArrow(_gather, "kind int, k long, r long, n long, held long, df int, token binary")
    # By k first: Spark compares the first column's values before whole rows, and few rows share a k.
    counted = counted.repartition("kind", "k").sortWithinPartitions("k", "kind", "r")
    counted = counted.mapInArrow(_reduce, "kind int, k long, n long, held long, df long, token binary, r1 long, n1 long, r2 long, n2 long, token2 binary")
    counted = materialise(counted, "lm-counts")
    counts_path = written[-1]
    vocab = counted.filter(F.col("kind") == VOCAB).select("k", "n", "held", "df", "token")
    anchors = counted.filter(F.col("kind") == ANCHOR).select(F.col("k").alias("a"), F.col("n").alias("total"), "r1", "n1", "r2", "n2", "token", "token2")
    n_train, n_vocab, n_all, n_new, n_single = vocab.agg(
        *(F.coalesce(x, F.lit(0)) for x in (F.sum("n"), F.count_if(F.col("n") > 0), F.sum(F.col("n") + F.col("held")), F.sum("df"), F.count_if(F.col("df") == 1)))
    ).first()
    least = max(2, -(-n_all // head_bound))
    top = vocab.filter(F.col("n") + F.col("held") >= least).select("k", "n").toArrow()
    hashes = top.column("k").to_numpy().view(_U)
    order = np.argsort(hashes)
    old = stretch_of(*_slot_counts(counted.filter(F.col("kind") == OLD), N_OLD)).astype(np.float32)
    # Tokens with a code of their own, whatever the head, and levels of the others. Those that one text alone has get
    # none, so a code never tells a training text of its own tokens.
    own_code = (F.col("n") >= max(2, -(-n_train // CODED))) & (F.col("df") > 1)
    coded = vocab.filter(own_code).select("k", "n").toArrow()
    code_h, code_n = coded.column("k").to_numpy().view(_U), coded.column("n").to_numpy()
    by_hash = np.argsort(code_h)
    levels = vocab.filter(~own_code & (F.col("n") > 0)).groupBy(F.least(F.length(F.bin("n")), F.lit((1 << LEVEL_BITS) - 1)).alias("level"))
    level_n, level_tokens = np.zeros(1 << LEVEL_BITS), np.zeros(1 << LEVEL_BITS, np.int64)
    for row in levels.agg(F.sum("n").alias("n"), F.count("*").alias("tokens")).collect():
        level_n[row["level"]], level_tokens[row["level"]] = row["n"], row["tokens"]
    code = make_code(code_h[by_hash], code_n[by_hash], n_train - int(code_n.sum()), level_n, level_tokens)
    known = Corpus(hashes[order], top.column("n").to_numpy()[order], n_train, n_vocab, n_new, n_single, old, code)
    corpus = spark.sparkContext.broadcast(known)

    speller = spark.sparkContext.broadcast(fit_speller(vocab.filter("df = 1").select(F.col("k").alias("h"), "token")))

    def spell(batches):
        for batch in batches:
            logp = speller.value.log10(batch.column("token").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), pa.array(logp)], ["k", "n", "spelled"])

    alone = vocab.filter("df <= 1").select("k", "n", "token").mapInArrow(spell, "k long, n long, spelled double")
    words = alone.union(vocab.filter("df > 1").select("k", "n", F.lit(None).cast("double")))

    # Row numbers inside a task tie a text's rows together; they are written once and only then read.
    usable = spark.sparkContext.broadcast(usable_bits(anchors.select("a")))  # most anchors are in no other text
    parts = materialise(d.mapInArrow(lambda b: _ask(b, corpus, usable), f"rid long, doc_id {kind}, {_PARTS}"), "lm-parts", "zstd")
    pairs = _slot_counts(parts.filter("rid < 0").select(F.inline("pairs")), PAIR_CLASSES << PAIR_DEPTH)
    pairs = np.ascontiguousarray(pairs.T.astype(np.float32))
    pairs = spark.sparkContext.broadcast(pairs)
    parts = parts.filter("rid >= 0").drop("pairs")
    asked = parts.select("rid", "train", F.inline("anchors"))
    asked = asked.select("rid", "a", "r", F.when(F.col("train"), F.col("times")).otherwise(0).alias("own"), "place")
    asked = asked.join(anchors, "a")
    one = F.col("n1") - F.when(F.col("r1") == F.col("r"), F.col("own")).otherwise(0)
    two = F.col("n2") - F.when(F.col("r2") == F.col("r"), F.col("own")).otherwise(0)
    best = F.greatest(one, two)
    asked = asked.filter(best > 0).select(
        "rid", (F.col("place") * 2 + 1).cast("long").alias("key"), best.alias("n"), (F.col("total") - F.col("own")).alias("total"),
        F.when(one >= two, F.col("token")).otherwise(F.col("token2")).alias("content"),
    )
    rare = parts.select("rid", F.inline("rare")).join(words, "k")
    rare = rare.select("rid", (F.col("place") * 2).cast("long").alias("key"), "n", "spelled")
    # Answers are written before texts move, so that what was shuffled to find them, and the counts, don't lie beside the texts.
    asked, rare = materialise(asked, "lm-runs", "zstd"), materialise(rare, "lm-rare", "zstd")
    drop(spark, counts_path)
    own = parts.select("rid", F.lit(-1).cast("long").alias("key"), "doc_id", "train", "text")
    rows = own.unionByName(asked.unionByName(rare, allowMissingColumns=True), allowMissingColumns=True)
    rows = rows.repartition("rid").sortWithinPartitions(F.col("rid") * 2 + (F.col("key") >= 0).cast("long"))  # one number sorts fastest
    out = rows.mapInArrow(
        lambda b: _settle(b, corpus, pairs),
        f"doc_id {kind}, train boolean, n_tokens long, n_bytes long, n_known long, base double, score double",
    )
    return out.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        "n_bytes",
        (F.col("score") * F.lit(-np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
