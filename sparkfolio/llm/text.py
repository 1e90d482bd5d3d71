"""Word classes and small expression helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of anything but space and the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"
#: An alphanumeric word: ASCII digits, letters after lower-casing, and all non-ASCII.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_table = bytearray(range(256))
for _b in chain(range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80)):
    _table[_b] = 0x20
for _u, _l in zip(_UPPER.encode(), _LOWER.encode(), strict=True):
    _table[_u] = _l
_ALNUM_TABLE = bytes(_table)


def space_words(text: bytes | None) -> list[bytes]:
    """``WORD`` runs of the text with A-Z lower-cased (bytes.split cuts at exactly those six bytes)."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """``ALNUM_WORD`` runs of the text with A-Z lower-cased."""
    return text.translate(_ALNUM_TABLE).split() if text else []


def lower_ascii(col: Column) -> Column:
    return F.translate(col, _UPPER, _LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, bound as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def fold_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; a null id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def row_slices(batch, most_bytes: int, size_of: Callable[[int], int]) -> Iterator[range]:
    """Ranges of row numbers of a batch whose summed sizes stay near ``most_bytes``."""
    start, total = 0, 0
    for i in range(batch.num_rows):
        total += size_of(i)
        if total >= most_bytes:
            yield range(start, i + 1)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield range(start, batch.num_rows)


_U = np.uint64
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE_CODE = np.random.default_rng(5).integers(0, 1 << 64, 256, _U)
_POWER = np.cumprod(np.full((1 << 16) + 1, 0xD1342543DE82EF95, _U))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and 64-bit hash of each word of a lower-cased text: a polynomial of its bytes, mixed with its length.

    Works in blocks that end after a blank, so memory beyond the text is bounded but for longer words.
    """
    data = np.frombuffer(text, np.uint8)
    block = len(_POWER) - 1
    starts, lengths, hashes, at = [], [], [], 0
    while at < len(data):
        stop = min(at + block, len(data))
        if stop < len(data) or stop - at == block:
            gaps = np.flatnonzero(SPACE[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # a word as long as a block or longer stands alone
                more = re.compile(rb"[\x20\x09-\x0D]").search(text, stop)
                stop = more.start() if more else len(data)
                word = text[at:stop]
                starts.append(np.array([at]))
                lengths.append(np.array([stop - at]))
                hashes.append(np.array([xxhash.xxh64_intdigest(word)], _U))
                at = stop
                continue
        part = data[at:stop]
        blank = (part == 0x20) | (part - np.uint8(9) < 5)
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        edge = np.concatenate([np.zeros(int(not blank[0]), np.int64), edge, np.full(int(not blank[-1]), len(part))])
        first, last = edge[::2], edge[1::2]
        if len(first):
            sums = np.zeros(len(part) + 1, _U)
            code = _BYTE_CODE.take(part)
            code *= _POWER[: len(part)]
            np.cumsum(code, out=sums[1:])
            # The power that all words share makes the sum independent of the word's place.
            h = (sums.take(last) - sums.take(first)) * _POWER.take(block - first) + (last - first).astype(_U)
            h = (h ^ h >> _U(32)) * _U(0xD6E8FEB86659FD93)
            starts.append(first + at)
            lengths.append(last - first)
            hashes.append(h ^ h >> _U(32))
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(hashes)
