"""Page and document quality: suspect pages, coverage, leaks, split lines, latency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import patterns as P
from pagewright.functions import text as X


def page_sizes(pages: DataFrame) -> DataFrame:
    """doc_id, page_idx, visible_chars; a row without page_idx is a document without pages."""
    return pages.select("doc_id", "page_idx", X.visible_length(F.coalesce("text", F.lit(""))).alias("visible_chars"))


def suspect_pages(pages: DataFrame, min_chars: int = 64) -> DataFrame:
    """doc_id, page_idx, visible_chars of pages with fewer than ``min_chars`` characters that are not white space."""
    return page_sizes(pages).where(F.col("page_idx").isNotNull() & (F.col("visible_chars") < min_chars))


def suspect_summary(pages: DataFrame, min_chars: int = 64, sample: int | None = None, run_pages: DataFrame | None = None) -> DataFrame:
    """doc_id, page_count, suspect_pages (array, in order), ocr_run_pages, coverage_pages.

    ``sample`` keeps the first suspects only; ``run_pages`` (doc_id, page_idx) tells which were recognised.
    """
    suspect = F.col("visible_chars") < min_chars
    rows = page_sizes(pages).groupBy("doc_id").agg(
        F.count("page_idx").cast("int").alias("page_count"), F.array_sort(F.collect_list(F.when(suspect, F.col("page_idx")))).alias("suspect_pages")
    )
    if sample:
        rows = rows.withColumn("suspect_pages", F.slice("suspect_pages", 1, sample))
    if run_pages is None:
        rows = rows.withColumn("ocr_run_pages", F.array().cast("array<int>"))
    else:
        ran = run_pages.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.col("page_idx").cast("int"))).alias("ocr_run_pages"))
        rows = rows.join(ran, "doc_id", "left").withColumn("ocr_run_pages", F.coalesce("ocr_run_pages", F.array().cast("array<int>")))
    missed = F.greatest(F.size("suspect_pages") - F.size("ocr_run_pages"), F.lit(0))
    share = F.when(F.col("page_count") > 0, 1.0 - missed / F.col("page_count")).otherwise(0.0)
    return rows.select("doc_id", "page_count", "suspect_pages", "ocr_run_pages", share.cast("double").alias("coverage_pages"))


def leak_counts(lines: DataFrame, name: str) -> DataFrame:
    """doc_id and the number of gazette headers and numbered footers among the lines."""
    line = F.col("line")
    leak = P.matches(line, P.GAZETTE, True) | P.matches(line, P.DASHED_NUMBER) | P.matches(line, P.PAGE_WORD, True)
    return lines.groupBy("doc_id").agg(F.count_if(leak).alias(name))


def coverage(raw: DataFrame, markdown: DataFrame) -> DataFrame:
    """doc_id, character_coverage of Markdown (doc_id, text) against the raw text: 1 at most, 0 if that is blank."""
    rows = raw.select("doc_id", X.visible_length(F.col("text")).alias("r")).join(markdown.select("doc_id", X.visible_length(F.col("text")).alias("m")), "doc_id")
    return rows.select("doc_id", F.when(F.col("r") > 0, F.least(F.lit(1.0), F.col("m") / F.col("r"))).otherwise(0.0).alias("character_coverage"))


def leak_rate(raw: DataFrame, markdown: DataFrame) -> DataFrame:
    """doc_id, leak_rate: the Markdown's share of headers and footers in both texts together; 0 if there are none.

    With nothing removed it is one half.
    """
    count = lambda df, name: df.select("doc_id").join(leak_counts(X.explode_lines(df, "text", ["doc_id"]), name), "doc_id", "left").na.fill(0, [name])
    rows = count(raw, "r").join(count(markdown, "m"), "doc_id")
    return rows.select("doc_id", F.when(F.col("r") + F.col("m") > 0, F.col("m") / (F.col("r") + F.col("m"))).otherwise(0.0).alias("leak_rate"))


def split_violations(markdown: DataFrame) -> DataFrame:
    """doc_id, split_violations: parentheses cut from their number, and lines that are a lone ``a.`` or ``1.``."""
    line = F.col("line")
    lone = X.explode_lines(markdown, "text", ["doc_id"]).groupBy("doc_id").agg(F.count_if(P.matches(line, P.LONE_LETTER) | P.matches(line, P.ANY_LONE_NUMBER)).alias("__lone"))
    rows = markdown.join(lone, "doc_id", "left")
    cut = F.regexp_count("text", F.lit(P.java(P.SPLIT_PAREN)))
    return rows.select("doc_id", (cut + F.coalesce("__lone", F.lit(0))).cast("bigint").alias("split_violations"))


def metrics(raw: DataFrame, markdown: DataFrame) -> DataFrame:
    return coverage(raw, markdown).join(leak_rate(raw, markdown), "doc_id").join(split_violations(markdown), "doc_id")


def latency(timings: DataFrame, key: str = "doc_id", ms: str = "ms") -> DataFrame:
    """key, n_pages, mean_ms (whole milliseconds a page, the number reported as p95) and true_p95_ms."""
    total, n = F.sum(F.col(ms).cast("bigint")), F.count("*")
    return timings.groupBy(key).agg(n.alias("n_pages"), F.when(n > 0, F.expr(f"sum(CAST({ms} AS BIGINT)) div count(*)")).otherwise(0).alias("mean_ms"), F.percentile(F.col(ms).cast("double"), F.lit(0.95)).alias("true_p95_ms"), total.alias("total_ms"))
