"""Packing of tokenised documents into sequences of a fixed length: first-fit decreasing in random groups."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import row_slices
from sparkfolio.session import ship_package

_MAX_TASKS = 1 << 16  # several groups share a task beyond
_PIECES = 4096  # in a batch
_LONG = 1 << 20  # characters of a text that are tokenised at once, about

# How byte-level BPE splits texts, and the bytes that stand for themselves in its vocabulary.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN_BYTES = (*range(33, 127), *range(161, 173), *range(174, 256))
#: A blank between ASCII words, before which a text can be cut: no token crosses it.
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")


class Encoder:
    """The ids that the ``tokenizers`` library gives for a byte-level BPE file, by its merge ranks; several times faster."""

    def __init__(self, content: str):
        file = json.loads(content)
        split, model = file["pre_tokenizer"] or {}, file["model"]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if not plain or file["normalizer"] or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE that leaves texts as they are")
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        if any(t[k] for t in file["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that take blanks with them")
        others = (b for b in range(256) if b not in _PLAIN_BYTES)
        byte_of = {chr(b): b for b in _PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}
        # A token's id is its merge's rank.
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in model["vocab"].items() if t not in self.added}
        if [ranks[bytes(byte_of[c] for t in (m.split(" ") if isinstance(m, str) else m) for c in t)] for m in model["merges"]] != list(range(256, 256 + len(model["merges"]))):
            raise ValueError("ids that don't follow the merges")
        self.bpe = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split

    def _parts(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut between words."""
        at = 0
        while len(text) - at > _LONG:
            cut = _CUT.search(text, at + _LONG)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def __call__(self, text: str) -> np.ndarray:
        """Ids of a text; strings of added tokens get their ids."""
        found = self.split_added(text) if any(t in text for t in self.added) else [text]
        out = []
        for segment in found:
            if segment in self.added:
                out.append(np.array([self.added[segment]], np.uint32))
            elif segment:
                out += [np.array(self.bpe.encode_ordinary(part), np.uint32) for part in self._parts(segment)]
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


_encoders: dict[str, Encoder] = {}


def _spread(first: int, count: int, salt: int) -> np.ndarray:
    """Hashes of the numbers ``first``, ``first`` + 1, ..., mixed with a salt."""
    h = np.arange(first, first + count, dtype=np.uint64) + np.uint64(salt % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor)
    return h


def _tokenise(batches: Iterator[pa.RecordBatch], content: str, end: int, length: int, n_groups: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``length`` ids of each row, each in a random group."""
    if content not in _encoders:
        _encoders.clear()
        _encoders[content] = Encoder(content)
    encode, made = _encoders[content], 0
    salt = (seed << 20) + TaskContext.get().partitionId() * 0x9E3779B97F4A7C15
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 2 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            docs = [encode(texts[i].as_py() or "") for i in rows]
            sizes = np.array([len(d) + 1 for d in docs], np.int64)
            flat = np.full(int(sizes.sum()), end, "<u4")
            stops = np.cumsum(sizes)
            for d, stop in zip(docs, stops.tolist(), strict=True):
                flat[stop - 1 - len(d) : stop - 1] = d
            pieces = -(-sizes // length)
            row = np.repeat(np.arange(len(rows)), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            size = np.minimum(length, sizes[row] - start)
            edges = np.append(0, np.cumsum(size))  # pieces follow each other in flat
            key = _spread(made, len(row), salt)
            made += len(row)
            for lo in range(0, len(row), _PIECES):
                hi = min(lo + _PIECES, len(row))
                offsets = ((edges[lo : hi + 1] - edges[lo]) * 4).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(flat[edges[lo] : edges[hi]])])
                of = row[lo:hi]
                group, order = key[lo:hi] % np.uint64(n_groups), key[lo:hi] >> np.uint64(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(of + rows.start)), pa.array(start[lo:hi]), pa.array(sizes[of]), ids, *(pa.array(x.astype(np.int64)) for x in (group, order))],
                    ["doc_id", "start", "doc_tokens", "ids", "_group", "_order"],
                )


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: larger items first (ties in their order), each into the first bin with room for it.

    A tournament tree over the bins' free room finds that bin in as many steps
    as the tree is deep. Items of one size go to it together, as many as fit.
    """
    order = np.argsort(-sizes, kind="stable")
    bins = np.zeros(len(sizes), np.int64)
    whole = int((sizes == capacity).sum())  # a bin each
    bins[order[:whole]] = np.arange(whole)
    rest = order[whole:]
    # All bins but one are over half full, so this many suffice.
    leaves = 1 << (2 * int(-(-sizes[rest].sum() // capacity)) + 1).bit_length()
    room = [capacity] * (2 * leaves)
    kinds, first, counts = np.unique(-sizes[rest], return_index=True, return_counts=True)
    for size, at, left in zip((-kinds).tolist(), first.tolist(), counts.tolist(), strict=True):
        while left:
            node = 1
            while node < leaves:
                node = 2 * node if room[2 * node] >= size else 2 * node + 1
            n = min(left, room[node] // size)
            bins[rest[at : at + n]] = whole + node - leaves
            at, left = at + n, left - n
            room[node] -= n * size
            while node > 1:
                node //= 2
                most = max(room[2 * node], room[2 * node + 1])
                if room[node] == most:
                    break
                room[node] = most
    return bins


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Where the ids of pieces go: arrays of piece, start in it, length, sequence, offset there; by sequence and offset.

    First-fit decreasing fills bins; then the emptiest bins are poured into
    the gaps of the others, which alone cuts pieces. What is left, less than
    a sequence, fills sequences of 512, 256, ... ids (powers of two), so that
    nothing has to be padded.
    """
    bins = first_fit_decreasing(sizes, capacity)
    fill = np.bincount(bins, sizes).astype(np.int64)
    by_fill = np.argsort(-fill, kind="stable")
    place = np.empty(len(by_fill), np.int64)
    place[by_fill] = np.arange(len(by_fill))
    total = int(sizes.sum())
    full = total // capacity
    order = np.lexsort((np.arange(len(sizes)), -sizes, place[bins]))
    sequence, size = place[bins[order]], sizes[order]
    stay = sequence < full
    before = np.cumsum(size) - size
    offset = before - before[np.searchsorted(sequence, sequence)]
    out = [order[stay], np.zeros(int(stay.sum()), np.int64), size[stay], sequence[stay], offset[stay]]
    gaps = [(s, capacity - f, f) for s, f in enumerate(fill[by_fill[:full]].tolist()) if f < capacity]
    rest = total % capacity
    tail = [b for b in range(rest.bit_length())[::-1] if rest >> b & 1]
    gaps += [(full + i, 1 << b, 0) for i, b in enumerate(tail)]
    poured, gap = [], iter(gaps)
    target, free, at = next(gap, (0, 0, 0))
    for piece, length in zip(order[~stay].tolist(), size[~stay].tolist(), strict=True):
        start = 0
        while start < length:
            if not free:
                target, free, at = next(gap)
            n = min(free, length - start)
            poured.append((piece, start, n, target, at))
            start, free, at = start + n, free - n, at + n
    out = [np.append(a, b) for a, b in zip(out, np.array(poured, np.int64).reshape(-1, 5).T, strict=True)]
    order = np.lexsort((out[4], out[3]))
    return tuple(a[order] for a in out)


def _pack_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Pack each group; rows arrive by group."""
    held: list[pa.RecordBatch] = []
    now = None

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        ids = [np.frombuffer(x.as_buffer(), "<u4") for c in table.column("ids").chunks for x in c]
        sizes = np.array([len(x) for x in ids], np.int64)
        first, doc_tokens = table.column("start").to_numpy(), table.column("doc_tokens").to_numpy()
        piece, start, size, sequence, offset = pack(sizes, length)
        for lo in range(0, len(piece), _PIECES):
            cut = slice(lo, lo + _PIECES)
            of = piece[cut]
            parts = [ids[p][a : a + n].tobytes() for p, a, n in zip(of.tolist(), start[cut].tolist(), size[cut].tolist(), strict=True)]
            doc_id = table.column("doc_id").take(pa.array(of)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(first[of] + start[cut]), pa.array(size[cut]), pa.array(doc_tokens[of]), pa.array(sequence[cut] + (now << 32)), pa.array(offset[cut]), pa.array(parts, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    for batch in batches:
        groups = batch.column("_group").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if lo == hi:
                continue
            if now is not None and groups[lo] != now:
                yield from out()
                held = []
            now = int(groups[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield from out()


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 1024, end: int = 0, group_bytes: int = 8 << 20, seed: int = 11) -> DataFrame:
    """All token ids of ``docs``, cut into pieces and packed into sequences of ``length`` ids.

    A document is its ids by the byte-level BPE of a ``tokenizers`` file at
    ``tokenizer_path`` (read on the driver), without special tokens added, and
    the id ``end``. Those
    longer than a sequence are cut into whole sequences and a rest. Each piece
    goes to a random group, by a hash of its task's and its own number, so no
    document, id or group of copies is hot; groups hold ``group_bytes`` bytes
    of text on average, and as each id stands for a byte at least, so many ids
    at most. In each group, first-fit decreasing packs pieces, the emptiest
    sequences are cut up to fill the others' gaps, and the group's last ids
    fill sequences of smaller powers of two; no sequence has any padding. The
    packing depends on how the input is split into tasks.

    Returns a row per piece: doc_id, start (ids of the document before it),
    length, doc_tokens, sequence_id, offset (in the sequence, gapless from 0)
    and ids (little-endian unsigned 32-bit numbers). Null text: empty, so the
    id ``end`` alone. Repeated rows and ids are packed like any other. Empty
    input: no rows. Other columns are ignored. One text's ids are in memory
    at once.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    kind = dict(docs.dtypes)["doc_id"]
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    n_groups = max(1, -(-total // group_bytes))
    tasks = min(n_groups, _MAX_TASKS)
    pieces = docs.select("doc_id", "text").mapInArrow(
        lambda b: _tokenise(b, content, end, length, n_groups, seed),
        f"doc_id {kind}, start long, doc_tokens long, ids binary, _group long, _order long",
    )
    pieces = pieces.repartitionById(tasks, (F.col("_group") % tasks).cast("int")).sortWithinPartitions("_group", "_order")
    return pieces.mapInArrow(
        lambda b: _pack_groups(b, length),
        f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )

