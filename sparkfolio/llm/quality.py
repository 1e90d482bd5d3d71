"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import fold_of, row_slices
from sparkfolio.session import ship_package

FEATURES = (
    "log_bytes log_words mean_word words_per_line upper_share digit_share symbol_share punct_share bang_share pipe_share "
    "other_share end_punct_share distinct_share top_word_share repeat_run_share dup_line_share long_word_share "
    "short_line_share symbol_word_share letter_entropy"
).split()
_KINDS = np.zeros(256, np.uint8)
for _k, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>@^~=+_/\\{}[]", ".,;:'\"()-?", "!", "|"), 1):
    _KINDS[list(_chars.encode())] = _k
_KINDS[128:] = 7
_MARK = frozenset(b"#*$%&|<>!")


def features(text: bytes | None) -> list[float]:
    """Statistics of a whole text; all are defined for the empty one."""
    text = text or b""
    n = len(text)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=8) / max(1, n)
    tally = Counter(words)
    w = max(1, len(words))
    counts = np.fromiter(tally.values(), np.float64, len(tally))
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    share = counts / w
    return [
        np.log1p(n),
        np.log1p(len(words)),
        n / w,
        len(words) / max(1, len(lines)),
        *kinds[1:8],
        sum(x[-1:] in b".!?" for x in lines) / max(1, len(lines)),
        len(tally) / w,
        float(share.max()) if len(share) else 0.0,
        runs / w,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(len(x) > 20 for x in words) / w,
        sum(len(x) < 20 for x in lines) / max(1, len(lines)),
        sum(x[-1] in _MARK for x in words) / w,
        float(-(share * np.log(share)).sum() / np.log(w + 1)) if len(share) else 0.0,
    ]


@dataclass
class Forest:
    """Complete trees of one depth as flat arrays: node i has children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while node[0] < inner if len(node) else False:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 4.0) -> Forest:
    """Gradient boosting of logistic loss on quantile-binned features."""
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    inner, leaves = 2**depth - 1, 2**depth
    n_features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    total = np.full(len(y), start)
    out = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best, pick = np.zeros(width), [(0, bins)] * width
            for j in range(n_features):
                key = local * bins + binned[j]
                g = np.bincount(key, grad, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(key, hess, width * bins).reshape(width, bins).cumsum(1)
                gr, hr = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + ridge) + gr**2 / (hr + ridge) - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                at = gain.argmax(1)
                for k in np.flatnonzero(gain[np.arange(width), at] > best + 1e-9):
                    best[k], pick[k] = gain[k, at[k]], (j, int(at[k]))
            for k, (j, b) in enumerate(pick):
                feature[first + k] = j
                cut[first + k] = cuts[j][b] if b < len(cuts[j]) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + ridge)
        total += value[leaf]
        for to, part in zip(out, (feature, cut, value), strict=True):
            to.append(part)
    return Forest(*(np.array(part) for part in out), start)


def _feature_rows(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 4 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            part = batch.slice(rows.start, len(rows))
            x = [features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])


def train_quality(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000) -> Forest:
    """Fit on labelled documents outside the held-out fold: at most ``most_rows`` labels, those of least hash.

    Labels whose quality is null are left out; of several labels of an id,
    one row each is used. Without any row the forest scores 0.5.
    """
    ship_package(docs.sparkSession)
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), 5) != 0))
    marks = marks.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("y"))
    marks = marks.orderBy(F.xxhash64("_id", F.lit(7)), "_id", "y").limit(most_rows)
    d = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = d.join(F.broadcast(marks), d["doc_id"] == F.col("_id")).select("y", "text")
    table = rows.mapInArrow(_feature_rows, "y double, x array<double>").toArrow()
    if not table.num_rows:
        return Forest(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
    x = np.array(table.column("x").to_pylist())
    y = table.column("y").to_numpy()
    order = np.lexsort((*x.T, y))  # arrival order must not matter
    return fit_forest(x[order], y[order])


def _score_rows(batches, forest: Forest) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for rows in row_slices(batch, 4 << 20, lambda i: 64 + (texts[i].as_buffer().size if texts[i].is_valid else 0)):  # noqa: B023
            part = batch.slice(rows.start, len(rows))
            x = np.array([features(t) for t in part.column("text").to_pylist()])
            keep = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*part.select(keep).columns, pa.array(forest.score(x))], [*keep, "_score"])


def score_quality(docs: DataFrame, forest: Forest, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and score (0 to 1) of every row.

    Only the text is an input of the score. Null text scores as empty text,
    which has defined statistics. Repeated rows each get a row, equal texts
    equal scores. Empty input: no rows. Extra columns are ignored.
    """
    ship_package(docs.sparkSession)
    kinds = dict(docs.dtypes)
    d = docs.select(*(F.col(c).alias(f"_keep_{c}") for c in keep), F.col("text").cast("binary").alias("text"))
    d = d.mapInArrow(lambda b: _score_rows(b, forest), ", ".join(f"`_keep_{c}` {kinds[c]}" for c in keep) + ", _score double")
    return d.select(*(F.col(f"_keep_{c}").alias(c) for c in keep), F.col("_score").alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **params) -> DataFrame:
    """``docs`` without the rows whose score is under ``threshold``; columns unchanged."""
    scored = score_quality(docs, train_quality(docs, labels, **params), keep=tuple(docs.columns))
    return scored.filter(F.col("score") >= threshold).select(*docs.columns)
