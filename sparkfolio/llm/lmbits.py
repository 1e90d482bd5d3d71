"""Bit predictors in hashed contexts and their logistic mixing.

``Speller`` codes the bytes of one word: its tables, gated weights and
refinement map are fitted to the words of the corpus. ``mix_online`` codes a
sequence of binary decisions of each text: its tables are fitted to the
corpus, while weights and refinement start afresh in every text and learn
along it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = b"\n"
#: Contexts of a byte: its place in the word; the last byte; the last 2, 3 and 4 bytes of the word.
SLOT_BITS = (12, 16, 18, 19, 19)
N_CTX = len(SLOT_BITS)
OFFSETS = np.cumsum([0, *(1 << b for b in SLOT_BITS)])
N_SLOTS = int(OFFSETS[-1])
SURE_LEVELS = np.array([1, 3, 6, 9])  # log2 of how often the last 3 bytes were seen
N_GATES = 4 * (len(SURE_LEVELS) + 1)
APM_BINS = 33
FLOOR = 0.01  # of a prediction's variance in the curvature, against overshooting
CHUNK = 1 << 16  # slots in a gathered piece of the tables
_U = np.uint64


@dataclass
class Speller:
    """Stretched prediction of each slot, gated mixer weights, and the refinement map."""

    stretch: np.ndarray
    sure: np.ndarray
    weights: np.ndarray
    apm: np.ndarray

    def at(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(stretched prediction, 0 where never seen; log2 of how often seen) of slots."""
        sure = self.sure[slot]
        return np.where(sure == 0, np.float32(0), self.stretch[slot].astype(np.float32)), sure

    def log10(self, tokens: list[bytes]) -> np.ndarray:
        """log10 probability of each word's bytes and its end; over all words the probabilities sum to one."""
        out = np.zeros(len(tokens))
        for owner, flat, ctx, position, prefix in _events(tokens):
            flat, ctx, position, number = _distinct(prefix, flat, ctx, position)
            total = np.zeros(len(flat))
            for node, bit in _bits(flat):
                x, gate = inputs(self, ctx, node, position)
                t = np.clip(np.einsum("gk,kg->g", self.weights[gate], x), -12, 12)
                refined, _, _ = refine(self.apm, gate, t)
                p = np.clip((squash(t) + refined) / 2, 1e-6, 1 - 1e-6)
                total += np.log10(np.where(bit == 1, p, 1 - p))
            out += np.bincount(owner, total[number], len(tokens))
        return out


def _events(tokens: list[bytes], block: int = 1 << 18) -> Iterator[tuple]:
    """Per run of words: (word number of each byte, byte values, context hashes, places in the word, prefix hashes)."""
    start, total = 0, 0
    for i, t in enumerate(tokens):
        total += len(t) + 1
        if total >= block or i + 1 == len(tokens):
            yield contexts(tokens[start : i + 1], start)
            start, total = i + 1, 0


def contexts(tokens: list[bytes], base: int) -> tuple:
    coded = [t if t == END else t + b" " for t in tokens]
    lens = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.frombuffer(b"".join(coded), np.uint8)
    first = np.cumsum(lens) - lens
    owner = np.repeat(np.arange(len(tokens)), lens)
    at = np.arange(len(flat)) - first[owner]
    prev = np.zeros((5, len(flat)), _U)
    for k in range(1, 5):
        prev[k, k:] = flat[:-k]
        prev[k][at < k] = 0
    # A polynomial of the bytes up to and with this one, from the word's start.
    power = np.cumprod(np.full(int(lens.max()), 0x9E3779B97F4A7C15, _U))
    term = (flat.astype(_U) + _U(1)) * power[at]
    rolled = np.cumsum(term)
    prefix = rolled - (rolled[first] - term[first])[owner]
    o2 = prev[1] | prev[2] << _U(8)
    o3 = o2 | prev[3] << _U(16)
    return owner + base, flat, [np.minimum(at, 15).astype(_U), prev[1], o2, o3, o3 | prev[4] << _U(24)], np.minimum(at, 3), prefix


def _distinct(prefix: np.ndarray, flat: np.ndarray, ctx: list[np.ndarray], position: np.ndarray):
    """All contexts depend on the word so far alone, so bytes with the same prefix are worked out once.

    Returns the distinct bytes, their contexts and positions, and the number of each byte among them.
    """
    _, first, number = np.unique(prefix, return_index=True, return_inverse=True)
    return flat[first], [c[first] for c in ctx], position[first], number


def slot(k: int, ctx: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Slot of context k at a node of the byte's bit tree."""
    h = (ctx + _U(k + 1)) * _U(0xFF51AFD7ED558CCD) ^ node.astype(_U) * _U(0xD6E8FEB86659FD93)
    h = (h ^ h >> _U(29)) * _U(0xC4CEB9FE1A85EC53)
    return (h >> _U(64 - SLOT_BITS[k])).astype(np.int64) + OFFSETS[k]


def _bits(flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node, bit) for each of the eight bits of the bytes, highest first."""
    value = flat.astype(np.int64)
    for b in range(8):
        yield (1 << b) | value >> (8 - b), value >> (7 - b) & 1


def squash(t):
    return 1 / (1 + np.exp(-np.clip(t, -30, 30)))


def inputs(model: Speller, ctx, node, position):
    found = [model.at(slot(k, ctx[k], node)) for k in range(N_CTX)]
    gate = position * (len(SURE_LEVELS) + 1) + np.searchsorted(SURE_LEVELS, found[3][1], side="right")
    return np.stack([x for x, _ in found]), gate


def refine(apm: np.ndarray, gate: np.ndarray, t: np.ndarray):
    """The map's value at each stretched prediction, its bin below, and the share of the bin above."""
    at = np.clip((t + 12) / 24 * (APM_BINS - 1), 0, APM_BINS - 1.001)
    low = at.astype(np.int64)
    up = at - low
    return apm[gate, low] * (1 - up) + apm[gate, low + 1] * up, low, up


def _gather_tables(batches) -> Iterator[pa.RecordBatch]:
    """Counts of zero and one bits by slot, for the words outside and inside the tuning part (token, tune)."""
    counts = np.zeros((4, N_SLOTS), np.float64)  # exact up to 2^53
    main, tuning = counts[:2].reshape(-1), counts[2:].reshape(-1)  # views
    for batch in batches:
        tune = batch.column("tune").to_numpy(zero_copy_only=False)
        for owner, flat, ctx, position, prefix in _events(batch.column("token").to_pylist()):
            flat, ctx, _, number = _distinct(prefix, flat, ctx, position)
            parts = []
            for to, weight in ((main, ~tune[owner]), (tuning, tune[owner])):
                n = np.bincount(number, weight, len(flat))
                parts.append((to, on := np.flatnonzero(n), n[on]))
            for node, bit in _bits(flat):
                for k in range(N_CTX):
                    at = slot(k, ctx[k], node) + bit * N_SLOTS
                    for to, on, n in parts:
                        np.add.at(to, at[on], n)
    for piece in range(0, N_SLOTS, CHUNK):
        part = np.ascontiguousarray(counts[:, piece : piece + CHUNK])
        if part.any():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece // CHUNK], pa.int32()), "data": [part.tobytes()]})


def _sum_pieces(batches) -> Iterator[pa.RecordBatch]:
    """Add up the pieces that meet in this task; give out predictors without the tuning part, then with it."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, data in zip(batch.column("piece").to_pylist(), batch.column("data").to_pylist(), strict=True):
            part = np.frombuffer(data, np.float64)
            sums[piece] = sums[piece] + part if piece in sums else part
    for piece, part in sums.items():
        n = part.reshape(4, -1)
        parts = [x.tobytes() for x in (*_predictors(n[0], n[1]), *_predictors(n[0] + n[2], n[1] + n[3]))]
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([parts], pa.list_(pa.binary()))], ["piece", "data"])


def _predictors(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    stretch = np.clip(np.log((n1 + 0.1) / (n0 + 0.1)), -12, 12).astype(np.float16)
    return stretch, np.minimum(np.log2(1 + n0 + n1), 15).astype(np.uint8)


def _newton_sums(batches, model: Speller) -> Iterator[pa.RecordBatch]:
    """Gradient and curvature of the coding cost at the model's weights, and the refinement map's counts.

    All are plain sums over words, so tasks and row order don't matter.
    """
    curve = np.zeros((N_GATES, N_CTX, N_CTX))
    slope = np.zeros((N_GATES, N_CTX))
    hits = np.zeros((2, N_GATES, APM_BINS))
    for batch in batches:
        for _, flat, ctx, position, prefix in _events(batch.column("token").to_pylist(), 1 << 16):
            flat, ctx, position, number = _distinct(prefix, flat, ctx, position)
            weight = np.bincount(number, minlength=len(flat)).astype(np.float64)
            for node, bit in _bits(flat):
                x, gate = inputs(model, ctx, node, position)
                x = x.astype(np.float64)
                t = np.clip(np.einsum("gk,kg->g", model.weights[gate], x), -12, 12)
                p = np.clip(squash(t), 1e-5, 1 - 1e-5)
                order = np.argsort(gate.astype(np.int8), kind="stable")
                by_gate, steep, miss = x[:, order], (weight * np.maximum(p * (1 - p), FLOOR))[order], (weight * (bit - p))[order]
                ends = np.cumsum(np.bincount(gate, minlength=N_GATES))
                for g, (lo, hi) in enumerate(zip(np.append(0, ends), ends, strict=False)):
                    if lo < hi:
                        curve[g] += (by_gate[:, lo:hi] * steep[lo:hi]) @ by_gate[:, lo:hi].T
                        slope[g] += by_gate[:, lo:hi] @ miss[lo:hi]
                _, low, up = refine(model.apm, gate, t)
                for y in (0, 1):
                    m = weight * (bit == y)
                    np.add.at(hits[y], (gate, low), m * (1 - up))
                    np.add.at(hits[y], (gate, low + 1), m * up)
    if curve.any():
        yield pa.RecordBatch.from_pydict({"data": [np.concatenate([curve.ravel(), slope.ravel(), hits.ravel()]).tobytes()]})


def fit_speller(words: DataFrame, rounds: int = 3, tasks: int = 512) -> Speller:
    """Fit to the words of (h, token): tables from all of them; weights and map by full Newton rounds over an
    eighth (by hash), against tables of the others.

    What a task gives is of a fixed size; words meet in at most ``tasks`` tasks, so that what is added up is bounded.
    """
    spark = words.sparkSession
    rows = words.select("token", (F.pmod("h", F.lit(8)) == 0).alias("tune")).coalesce(tasks)
    pieces = rows.mapInArrow(_gather_tables, "piece int, data binary")
    pieces = pieces.repartition("piece").mapInArrow(_sum_pieces, "piece int, data array<binary>")
    kinds = (np.float16, np.uint8) * 2
    parts = [np.zeros(N_SLOTS, kind) for kind in kinds]
    for batch in pieces.toArrow().to_batches():
        for piece, data in zip(batch.column("piece").to_pylist(), batch.column("data"), strict=True):
            for to, kind, x in zip(parts, kinds, data.as_py(), strict=True):
                x = np.frombuffer(x, kind)
                to[piece * CHUNK : piece * CHUNK + len(x)] = x
    apm = np.tile(squash(np.linspace(-12, 12, APM_BINS)), (N_GATES, 1))
    model = Speller(parts[0], parts[1], np.full((N_GATES, N_CTX), 1 / N_CTX), apm)
    for _ in range(rounds if parts[1].any() else 0):
        now = spark.sparkContext.broadcast(model)
        sums = rows.filter("tune").select("token").mapInArrow(lambda b, now=now: _newton_sums(b, now.value), "data binary").toArrow()
        if not sums.num_rows:
            break
        total = sum(np.frombuffer(x, np.float64) for x in sums.column("data").to_pylist())
        curve, slope, hits = np.split(total, np.cumsum([N_GATES * N_CTX * N_CTX, N_GATES * N_CTX]))
        curve = curve.reshape(N_GATES, N_CTX, N_CTX) + 4 * np.eye(N_CTX)
        step = np.linalg.solve(curve, slope.reshape(N_GATES, N_CTX, 1))[..., 0]
        hits = hits.reshape(2, N_GATES, APM_BINS)
        model = Speller(parts[0], parts[1], model.weights + np.clip(step, -0.5, 0.5), (hits[1] + 20 * apm) / (hits[0] + hits[1] + 20))
    return Speller(parts[2], parts[3], model.weights, model.apm)


BINS = 16  # of a text's refinement map
START_WEIGHT, RATE = 0.3, 0.02


def mix_online(x: np.ndarray, bits: np.ndarray, first: np.ndarray, gate: np.ndarray, n_gates: int, block: int) -> np.ndarray:
    """log10 probability of each binary decision, coded text by text.

    ``x`` (decisions, predictors) are stretched predictions; ``first`` are the
    texts' first decisions and the end of the last. In a text, weights of
    each gate start at ``START_WEIGHT`` and move down the coding cost's slope;
    a map from the mixed prediction to what came true starts at the identity
    and counts. Both learn after every ``block`` decisions and are used from
    then on, so a decision is predicted from those before its block only. Far
    into a text blocks are longer, a 32nd of what came before, and move the
    weights as far as ``block`` decisions would. Texts run side by side and
    don't touch each other.
    """
    kind = x.dtype.type
    sizes = np.diff(first)
    # A block at a text's end reads on in the next one, masked, and writes to room of its own.
    room = np.maximum(sizes // 32, block)
    gap = np.cumsum(room) - room
    told = np.empty(len(bits) + int(room.sum()), kind)  # probability of what came
    code = np.zeros(len(bits) + int(room.max(initial=0)), np.int8)
    np.add(gate * 2, bits, out=code[: len(bits)], casting="unsafe")
    if len(x) < len(code):
        x = np.concatenate([x, np.zeros((len(code) - len(x), x.shape[1]), kind)])
    order = np.argsort(-sizes, kind="stable")
    begin, to, sizes = first[:-1][order], (first[:-1] + gap)[order], sizes[order]
    w = np.full((len(order), x.shape[1], n_gates), START_WEIGHT, kind)
    middle = squash((np.arange(BINS) + 0.5) / BINS * 16 - 8)
    seen = np.full((len(order), BINS), 8.0)
    true = np.tile(8.0 * middle, (len(order), 1))
    b = 0
    while b < sizes.max(initial=0):
        step = max(block, b // 32)
        n = int(np.searchsorted(-sizes, -b, side="left"))  # texts that reach here
        full = int(np.searchsorted(-sizes, -(b + step), side="right"))  # texts that reach the block's end
        at = begin[:n] + b
        xs = _windows(x, step)[at].reshape(n, step, -1)
        c = _windows(code, step)[at]
        y = (c & 1).astype(kind)
        side = np.arange(0, n * step * n_gates, n_gates).reshape(n, step)
        side += c >> 1
        t = (xs @ w[:n]).reshape(-1).take(side)
        p = np.clip(t, -80, 80)
        np.exp(np.negative(p, out=p), out=p)
        p += 1
        np.reciprocal(p, out=p)
        t += 8
        t *= kind(BINS / 16)
        cell = np.clip(t, 0, BINS - 1, out=t).astype(np.int64)
        cell += np.arange(0, n * BINS, BINS)[:, None]
        q = (true[:n] / seen[:n]).astype(kind).take(cell)
        q += p
        q *= kind(0.5)
        q += y
        q -= 1
        _windows(told, step)[to[:n] + b] = np.abs(q, out=q)
        np.subtract(y, p, out=p)
        cell *= 2
        cell += c & 1
        if full < n:
            over = np.arange(b, b + step) >= sizes[full:n, None]
            p[full:][over] = 0
            cell[full:][over] = 2 * n * BINS
        miss = np.zeros(n * step * n_gates, kind)
        miss[side] = p
        w[:n] += kind(RATE * block / step) * (xs.transpose(0, 2, 1) @ miss.reshape(n, step, n_gates))
        np.clip(w[:n], -4, 4, out=w[:n])
        counts = np.bincount(cell.reshape(-1), minlength=2 * n * BINS)[: 2 * n * BINS].reshape(n, BINS, 2)
        true[:n] += counts[:, :, 1]
        seen[:n] += counts.sum(2)
        b += step
    told = told.take(np.arange(len(bits)) + np.repeat(gap, np.diff(first)))
    return np.log(np.clip(told, 1e-5, 1 - 1e-5)) / np.log(10)


def _windows(z: np.ndarray, step: int) -> np.ndarray:
    """All runs of ``step`` rows of ``z``, as a view with a row for each."""
    width = z[:1].size
    return np.ndarray((max(len(z) - step + 1, 0), step * width), z.dtype, z, strides=(z.itemsize * width, z.itemsize))
