"""Quality rules: per-document rules, then host-level verdicts from rates shrunk by an empirical beta prior.

Everything here is DataFrame expressions. Word windows are hashed and compared inside each row, so the
only shuffles carry counts: one row per document and a partial sum per host and task. The counts are
written once to the shared folder, so that texts are read and cut into words a single time.

The prior is fitted by moments to the rates of all hosts. Their variance holds the hosts' own spread and
the chance of drawing few rows from each; the second is taken off, so that a corpus of many small and
equal hosts gets a tight prior, which small hosts can hardly leave.

Defined results: a null or empty text has zero in every count and fails the base rules (too few
words). A null host gets no host verdict: its rows are judged by the base rules alone. Repeated rows,
also of one id, are judged row by row. A host at the limit stays. An empty table gives an empty result.
Input columns beyond ``doc_id``, ``text`` and the host column pass through the operator under any name
but those that it adds, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.common import BROADCAST_BYTES, broadcast_if, free_name, materialize

BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


def words_of(text: Column) -> Column:
    """The words of a text, as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK, -1), lambda w: w != "")


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once a row: lambdas read it from an array of one element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _places_of_repeats(sorted_windows: Column) -> Column:
    """Of (hash, place) pairs in order, the sorted places of those whose hash has an equal neighbour."""

    def same(k: Column, step: int) -> Column:
        return F.coalesce(F.get(sorted_windows, k)["h"] == F.get(sorted_windows, k + step)["h"], F.lit(False))

    every = F.sequence(F.lit(0), F.size(sorted_windows) - 1)
    repeated = F.filter(every, lambda k: same(k, -1) | same(k, 1))
    return F.array_sort(F.transform(repeated, lambda k: F.get(sorted_windows, k)["i"]))


def _covered(places: Column, width: int) -> Column:
    """The number of words in windows that start at sorted ``places``: each counts up to the next one at most."""

    def add(n: Column, k: Column) -> Column:
        gap = F.get(places, k + 1) - F.get(places, k)
        return n + F.least(F.lit(width), F.coalesce(gap, F.lit(width)))

    return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), F.lit(0), add)


def repeat_words(windows: Column, width: int) -> Column:
    """From an array of one hash per window, the number of words in windows that occur at least twice.

    Most texts repeat no window, which one hash set tells. For the rest, windows are sorted by hash with
    their positions, those with an equal neighbour are kept, and a window counts the words up to the
    next kept window at most.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    slow = _once(_once(pairs, _places_of_repeats), lambda places: _covered(places, width))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(slow).cast("long")


def document_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    own_words, own_lines, hashes = (free_name(x, keep) for x in ("__words", "__lines", "__windows"))
    text, words = F.coalesce(F.col("text"), F.lit("")), F.col(own_words)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(NOT_BLANK))
    symbols = F.regexp_count(text, F.lit(SYMBOLS)).cast("long")
    rows = docs.select(*keep, words_of(F.col("text")).alias(own_words), lines.alias(own_lines), symbols.alias("n_symbols"))
    n_windows = F.size(words) - WINDOW + 1
    starts = F.sequence(F.lit(1), F.greatest(n_windows, F.lit(1)))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    rows = rows.select(
        *keep, "n_symbols",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.size(own_lines) - F.size(F.array_distinct(own_lines))).cast("long").alias("n_dup_lines"),
        F.when(n_windows > 0, windows).otherwise(F.array().cast("array<bigint>")).alias(hashes),
    )
    return rows.withColumn("n_repeat_words", repeat_words(F.col(hashes), WINDOW)).drop(hashes)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def beta_prior(mean: float | None, variance: float | None, sampling: float | None) -> tuple[float, float]:
    """Beta parameters by the method of moments over host rates; their sum is held between 2 and 1000.

    ``sampling`` is the mean of one over a host's rows. A host of n rows whose rates spread by v about m shows a
    variance of v + (m (1 - m) - v) / n, which is solved for v.
    """
    if mean is None:
        return 1.0, 1.0
    if not 0 < mean < 1:
        return max(mean, 1e-3) * 2, max(1 - mean, 1e-3) * 2
    chance = mean * (1 - mean)
    spread = (variance - chance * sampling) / (1 - sampling) if sampling < 1 else 0.0
    total = 1000.0 if spread <= 0 else min(1000.0, max(2.0, chance / spread - 1))
    return mean * total, (1 - mean) * total


def apply_host_rules(
    spark: SparkSession, docs: DataFrame, host: str = "source", max_rate: float = 0.5, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per input row: its other columns (but not the text), the counts, base_failed, host_rate and kept.

    A host fails when its failure rate, shrunk by the prior, exceeds ``max_rate``; all its rows are then
    dropped. The prior is fitted to the rates of all hosts.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "kept")
    keep = [c for c in docs.columns if c not in added and c != "text"]
    counts = document_counts(docs, keep)
    counts = materialize(spark, counts.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "host-rules")

    name = free_name("__host", counts.columns)
    hosts = counts.where(F.col(host).isNotNull()).groupBy(F.col(host).alias(name)).agg(F.count("*").alias("n"), F.count_if("base_failed").alias("failed"))
    rate, size = F.col("failed") / F.col("n"), F.octet_length(F.col(name).cast("string")) + 64
    n_bytes, mean, variance, sampling = hosts.agg(F.coalesce(F.sum(size), F.lit(0)), F.avg(rate), F.var_pop(rate), F.avg(1 / F.col("n"))).first()
    a, b = beta_prior(mean, variance, sampling)
    rates = hosts.select(name, ((F.col("failed") + a) / (F.col("n") + a + b)).alias("host_rate"))
    judged = counts.join(broadcast_if(rates, n_bytes, broadcast_bytes), F.col(host) == F.col(name), "left").drop(name)
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_rate") <= max_rate, F.lit(True)))
