"""Quality rules judged by host (DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.text import WORD, let
from sparkfolio.storage import materialise


def document_stats(docs: DataFrame, key: str = "source") -> DataFrame:
    """Base counts of each document (doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    Lines with a word count, cut at newlines; one that equals an earlier line
    is a duplicate. Null text: all counts 0.
    """
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    d = docs.select("doc_id", F.col(key).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("doc_id", "host", "text", words.alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    repeats = F.expr(_REPEATS)
    return d.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("_lines"),
        repeats.cast("long").alias("n_repeat_words"),
    ).select("doc_id", "host", "n_words", "word_chars", "n_symbols", "_lines.n_lines", "_lines.n_dup_lines", "n_repeat_words")


#: Words inside a 3-word window that occurs twice or more: of each window its 64-bit hash with its place; sorted by
#: hash, repeats are neighbours; the places of repeats, sorted, count as a union of runs of three words.
_REPEATS = """
transform(array(words), w ->
  if(size(w) < 4, 0,
    transform(array(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))), g ->
      if(size(array_distinct(g)) = size(g), 0,
        transform(array(sort_array(transform(g, (h, i) -> named_struct('h', h, 'i', i)))), p ->
          transform(array(array_sort(transform(
            filter(transform(p, (x, k) -> named_struct('i', x.i, 'twice',
                (k > 0 and p[greatest(k - 1, 0)].h = x.h) or (k < size(p) - 1 and p[least(k + 1, size(p) - 1)].h = x.h))),
              x -> x.twice), x -> x.i))), s ->
            3 + aggregate(transform(slice(s, 2, size(s)), (x, k) -> least(3, x - s[k])), 0, (a, b) -> a + b)
          )[0]
        )[0]
      )
    )[0]
  )
)[0]
"""


BASE = ("short", "repeats")
_LEAST_WEIGHT = 0.01  # of a prior, in documents: hosts that fail wholly or not at all


def rules(min_words: int = 50) -> dict[str, Column]:
    """What a document can fail."""
    words = F.col("n_words")
    return {
        "short": words < min_words,
        "repeats": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * words) | (F.col("word_chars") > 10 * words),
    }


def judge_hosts(stats: DataFrame, most_failed: float = 0.5, least_failed: float = 0.3, deviations: float = 3.0, min_words: int = 50) -> DataFrame:
    """Add base_failed, host_rate, host_failed and kept to the counts of ``document_stats``.

    A document fails the base rules with fewer than ``min_words`` words or
    over half of its words repeated; others look at symbols, duplicate lines
    and word lengths. For each rule, a beta prior is fitted to all hosts'
    failures by moments, and a host's rate is the mean of its posterior. A
    host fails a rule if its rate is over ``deviations`` standard deviations
    of the prior above the prior's mean; that limit is ``least_failed`` at
    least and, for base rules, ``most_failed`` at most (what all hosts fail by
    another rule tells none of them). Documents of hosts that fail a rule
    (host_failed: their names, sorted) go as well; host_rate is the greatest
    of the host's rates.

    A null host is a host of its own. With one host, or none varying, the
    prior weighs as many documents as the mean host has. Empty input: no
    rows. Stats are written once; hosts are pre-aggregated before the shuffle
    and joined back adaptively (a large host splits).
    """
    names = list(rules())
    failed = {f"_{r}": when for r, when in rules(min_words).items()}
    s = materialise(stats.withColumns(failed), "host-stats")
    hosts = s.groupBy("host").agg(F.count("*").alias("n"), *(F.count_if(f"_{r}").alias(r) for r in names))
    priors = beta_priors(hosts, names)
    rate = {r: (F.col(r) + a) / (F.col("n") + a + b) for r, (a, b) in priors.items()}
    limit = {}
    for r, (a, b) in priors.items():
        deviation = math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
        limit[r] = max(least_failed, a / (a + b) + deviations * deviation)
        if r in BASE:
            limit[r] = min(most_failed, limit[r])
    over = F.array_sort(F.array_compact(F.array(*(F.when(rate[r] > limit[r], F.lit(r)) for r in names))))
    hosts = hosts.select(F.col("host").alias("_host"), F.greatest(*rate.values()).alias("host_rate"), over.alias("host_failed"))
    out = s.withColumn("base_failed", F.col("_short") | F.col("_repeats")).drop(*failed)
    out = out.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("host_failed") == 0)).drop("_host")


def beta_priors(hosts: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Moments fit of a beta prior to hosts' failures of each rule: the between-host variance beyond binomial noise sets its weight."""
    n = F.col("n")
    sums = [x for r in names for x in (F.sum(r).alias(f"f_{r}"), F.sum(F.col(r) * F.col(r) / n).alias(f"q_{r}"))]
    m = hosts.agg(F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n * n).alias("nn"), *sums).first()
    return {r: _beta(m.n, m.k, m.nn, m[f"f_{r}"], m[f"q_{r}"]) if m.n else (1.0, 1.0) for r in names}


def _beta(n: int, k: int, nn: int, f: int, q: float) -> tuple[float, float]:
    mean = f / n
    noise = mean * (1 - mean)
    spread = q - n * mean * mean  # sum of n (rate - mean)^2
    scale = n - nn / n
    between = (spread - (k - 1) * noise) / scale if scale > 0 else 0.0
    weight = max(noise / between - 1, _LEAST_WEIGHT) if between > 0 else n / k
    return max(mean * weight, 1e-9), max((1 - mean) * weight, 1e-9)
