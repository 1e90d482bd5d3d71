"""Periodic runs of words, found by probing a harmonic grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import row_slices
from sparkfolio.session import ship_package

#: Probes looked at together; one period may have more.
_PROBES = 1 << 16
_FIRST_STEP, _LONGEST_STEP = 64, 1 << 16
RUN = "struct<start:long,length:long,period:long>"


def _equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading places of ``a`` and ``b`` are equal, compared in growing chunks."""
    n, at, step = min(len(a), len(b)), 0, _FIRST_STEP
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, min(2 * step, _LONGEST_STEP)
    return n


def _grid(low: int, high: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Left places jp and periods p of all probes (jp, (j+1)p) with p in [low, high)."""
    periods = np.arange(low, high)
    counts = (n - 1) // periods
    p = np.repeat(periods, counts)
    j = np.arange(len(p)) - np.repeat(np.cumsum(counts) - counts, counts)
    return j * p, p


def find_runs(words: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; ``words`` are numbers that are equal where words are.

    A run of period p holds ``times`` places in a row of the grid 0, p, 2p,
    ..., so equality of words at jp and (j+1)p, for ``times`` - 1 values of j
    in a row (two at most are asked), finds it in n/p probes. Of what
    survives, words in between are compared, then the stretch is extended to
    both sides. A probe within a run found before whose period divides p is
    skipped: it can only show that run again. Periods go up, so a stretch that
    is found again has its smallest period already.
    """
    if times < 2:
        raise ValueError("a run needs two periods at least")
    n, out = len(words), {}
    owner = np.full(n, -1, np.int64)  # a found run that holds the place
    period_of = np.zeros(0, np.int64)
    low, last = 1, n // times if n >= least else 0
    while low <= last:
        high, total = low, 0
        while high <= last and (high == low or total + (n - 1) // high <= _PROBES):
            total += (n - 1) // high
            high += 1
        left, p = _grid(low, high, n)
        ok = words[left] == words[left + p]
        if times > 2:  # the next probe of the same period holds too
            ok[:-1] &= ok[1:] & (p[1:] == p[:-1])
            ok[-1:] = False
        left, p = left[ok], p[ok]
        for part in (2, 4, 3) if times > 2 else ():  # a run goes on from one probe to the next
            between = left + p // part
            ok = words[between] == words[between + p]
            left, p = left[ok], p[ok]
        if len(period_of):
            held = owner[left]
            skip = (held >= 0) & (held == owner[left + p]) & (p % period_of[held] == 0)
            left, p = left[~skip], p[~skip]
        seen_period, seen_stop = 0, 0
        for i, q in zip(left.tolist(), p.tolist(), strict=True):
            if q == seen_period and i < seen_stop:
                continue
            run = int(owner[i])
            if run >= 0 and run == owner[i + q] and q % period_of[run] == 0:
                continue
            back = _equal_ahead(words[:i][::-1], words[q : i + q][::-1])
            ahead = _equal_ahead(words[i:], words[i + q :])
            seen_period, seen_stop = q, i + ahead
            start, length = i - back, back + ahead + q
            if length >= max(least, times * q) and (start, length) not in out:
                out[start, length] = q
                owner[start : start + length] = len(period_of)
                period_of = np.append(period_of, q)
        low = high
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def _scan(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 4 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            counts, found, collapsed = [], [], []
            for i in rows:
                text = texts[i].as_py() or b""
                words = text.split()  # cuts at exactly the six blanks
                numbers: dict[bytes, int] = {}
                runs = find_runs(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), least, times)
                if runs:
                    drop = np.zeros(len(words), bool)
                    for start, length, period in runs:
                        drop[start + period : start + length] = True
                    words = [words[k] for k in np.flatnonzero(~drop).tolist()]
                counts.append(len(drop) if runs else len(words))
                found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
                collapsed.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(rows.start, len(rows)), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(collapsed, pa.binary())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """Every run of repeated words in each whole text, and the text with each run cut to its first period.

    Words are what stands between ASCII blanks, compared as they are. A run is
    a stretch with smallest period q (words q apart are equal) of at least
    ``least`` words and ``times`` periods that can't be made longer. Runs may
    overlap. A word is dropped if any run holds it after that run's first q
    words; kept words are joined by one blank.

    Returns doc_id, n_words, runs (start, length, period; by start and
    period), collapsed; a row per input row, in one pass without a shuffle.
    Null and blank texts: no words, no runs, empty collapsed text. Repeated
    rows: a row each. Empty input: no rows. Other columns are ignored.
    Memory: about 100 bytes a word of the longest text.
    """
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    out = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda b: _scan(b, least, times), f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed binary"
    )
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
