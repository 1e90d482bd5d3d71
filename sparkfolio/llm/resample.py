"""Importance resampling towards a target text distribution, over hashed n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.llm.text import alnum_words, row_slices
from sparkfolio.session import ship_package
from sparkfolio.storage import materialise

_U4 = np.uint32
_POLYNOMIAL = 0xEDB88320  # of CRC-32, reflected
_NEAR = 64  # lengths with a table of their own
_MOST_KNOWN = 1 << 18  # words whose checksum a task keeps


def _times(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Product of a GF(2) matrix (32 columns as numbers) and vectors (numbers)."""
    out = np.zeros_like(vectors)
    for bit in range(32):
        out ^= np.where(vectors >> _U4(bit) & _U4(1), matrix[bit], _U4(0))
    return out


def _byte_tables(matrix: np.ndarray) -> np.ndarray:
    """The matrix' products with each value of each of the four bytes."""
    values = np.arange(256, dtype=_U4)
    return np.stack([_times(matrix, values << _U4(8 * k)) for k in range(4)])


class Shifts:
    """What becomes of a CRC-32 when zero bytes follow: shift(crc(a), len(b)) ^ crc(b) is crc(a + b)."""

    def __init__(self):
        m = np.array([_POLYNOMIAL, *(1 << i for i in range(31))], _U4)  # one zero bit
        for _ in range(3):
            m = _times(m, m)
        self.doubles = []  # of 1, 2, 4, ... zero bytes
        for _ in range(31):
            self.doubles.append(m)
            m = _times(m, m)
        near, m = [], (_U4(1) << np.arange(32, dtype=_U4))
        for _ in range(_NEAR):
            near.append(_byte_tables(m))
            m = _times(self.doubles[0], m)
        self.near = np.concatenate([t.ravel() for t in near])

    def __call__(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each checksum after as many zero bytes as its length says."""
        base = np.where(lengths < _NEAR, lengths, 0) << 10
        out = self.near[base + (crcs & _U4(255))]
        for k in (1, 2, 3):
            out ^= self.near[base + 256 * k + (crcs >> _U4(8 * k) & _U4(255))]
        far = np.flatnonzero(lengths >= _NEAR)
        if len(far):
            c, n = crcs[far], lengths[far]
            for k in range(int(n.max()).bit_length()):
                c = np.where(n >> k & 1, _times(self.doubles[k], c), c)
            out[far] = c
        return out


class Features:
    """Buckets of the n-grams of texts; the checksum of a word is taken once, those of n-grams are composed."""

    def __init__(self, most: int, buckets: int):
        self.most, self.buckets, self.shift = most, buckets, Shifts()
        self.blank = _U4(zlib.crc32(b" "))
        self.numbers: dict[bytes, int] = {}
        self.crcs, self.lengths = np.zeros(0, _U4), np.zeros(0, np.int64)

    def __call__(self, docs: list[list[bytes]]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Number of words of each text; for n = 1, 2, ...: buckets of all n-grams in order, and how many each text has."""
        if len(self.numbers) > _MOST_KNOWN:
            self.numbers, self.crcs, self.lengths = {}, self.crcs[:0], self.lengths[:0]
        known, numbers = len(self.numbers), self.numbers
        counts = np.array([len(d) for d in docs], np.int64)
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for d in docs for w in d), np.int64, int(counts.sum()))
        if len(numbers) > known:
            new = list(numbers)[known:]
            self.crcs = np.append(self.crcs, np.array([zlib.crc32(w) for w in new], _U4))
            self.lengths = np.append(self.lengths, np.array([len(w) for w in new], np.int64))
        crcs, lengths = self.crcs[ids], self.lengths[ids]
        # A word behind a blank.
        behind = self.shift(np.full(len(ids), self.blank, _U4), lengths) ^ crcs
        place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        out, grams = [], crcs
        for n in range(1, self.most + 1):
            if n > 1:  # grams[i] ends at word i + n - 2; one more word follows
                grams = self.shift(grams[:-1], lengths[n - 1 :] + 1) ^ behind[n - 1 :]
            inside = place[n - 1 :] >= n - 1
            out.append(((grams[inside] % _U4(self.buckets)).astype(np.int64), np.maximum(counts - n + 1, 0)))
        return counts, out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 4 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            yield batch.slice(rows.start, len(rows)), [alnum_words(texts[i].as_py()) for i in rows]


def _count(batches, most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    features, total = Features(most, buckets), np.zeros(buckets, np.int64)
    for _, docs in _slices(batches):
        for found, _ in features(docs)[1]:
            total += np.bincount(found, minlength=buckets)
    used = np.flatnonzero(total)
    if len(used):
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(total[used])})


def bucket_counts(docs: DataFrame, most: int = 2, buckets: int = 10_000) -> np.ndarray:
    """How often the n-grams of all texts fall in each bucket; counts combine in tasks, the driver gets one row a bucket."""
    text = docs.select(F.col("text").cast("binary").alias("text"))
    rows = text.mapInArrow(lambda b: _count(b, most, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares in target and source, one added to each count; rounded down."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    ratio = [(b + 1.0) * (s + n) / ((a + 1.0) * (t + n)) for a, b in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weigh(batches, most: int, gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    features = Features(most, len(gains))
    for batch, docs in _slices(batches):
        counts, found = features(docs)
        total, number = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        for buckets, each in found:
            sums = np.concatenate([[0], np.cumsum(gains[buckets])])
            stop = np.cumsum(each)
            total += sums[stop] - sums[stop - each]
            number += each
        weight = np.where(number > 0, total // np.maximum(number, 1), 0)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (counts, number, weight))], ["doc_id", "n_words", "n_features", "weight"])


def importance_resample(
    docs: DataFrame, target: DataFrame, most: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7
) -> DataFrame:
    """A draw without replacement of ``percent`` of the documents, likelier where their n-grams look like the target's.

    Features are runs of 1 to ``most`` words, by the CRC-32 of the words
    joined by blanks modulo ``buckets``. One pass counts buckets over all
    documents, one over the target; a second pass gives each document the
    mean gain of its features as weight. Weight and Gumbel noise from a hash
    of the id and the seed make the score; of the documents with at least
    ``least_words`` words, the share with the highest scores is drawn (ties:
    smaller id, null last; equal ids: any order), which is a draw in
    proportion to the exponential of the weight.

    A histogram of scores, whole numbers whose range the logs of counts bound
    (some ten thousand rows), tells the score from which documents can be
    drawn; those alone are sorted, by ranges of score, id and a number of the
    row, so that equal rows or ids spread. Texts aren't moved.

    Returns doc_id, n_words, n_features, weight, score and rank (1, 2, ...;
    null if not drawn), a row per input row. Null and blank texts: no words
    and features, weight 0, never drawn unless ``least_words`` is 0. A null id
    is hashed as empty text. An empty target counts as no features. Empty
    input: no rows. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    gains = bucket_gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets))
    table = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda b: _weigh(b, most, gains), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    table = materialise(table.withColumn("score", F.col("weight") + noise), "resample-weights")
    fit = F.col("n_words") >= least_words
    found = table.filter(fit).groupBy("score").agg(F.count("*").alias("n")).toArrow()
    scores, counts = found.column("score").to_numpy(), found.column("n").to_numpy()
    drawn = percent * int(counts.sum()) // 100
    no_rank = F.lit(None).cast("long")
    if not drawn:
        return table.withColumn("rank", no_rank)
    order = np.argsort(-scores)
    cut = int(scores[order][np.searchsorted(np.cumsum(counts[order]), drawn)])
    high = fit & (F.col("score") >= cut)
    by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    best = table.filter(high).withColumn("_row", F.monotonically_increasing_id())
    best = best.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()).drop("_row")
    best = materialise(best, "resample-best").withColumns({"_part": F.expr("_at >> 33"), "_at": F.expr("_at & 8589934591")})
    parts = best.groupBy("_part").agg(F.count("*").alias("_n"))
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the sort
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_ahead"))
    rank = F.col("_ahead") + F.col("_at") + 1
    ranked = best.join(F.broadcast(parts), "_part").withColumn("rank", F.when(rank <= drawn, rank))
    return ranked.select(*table.columns, "rank").unionByName(table.filter(~high).withColumn("rank", no_rank))
