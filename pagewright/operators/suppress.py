"""Suppression of lines that recur at the top or bottom of a document's pages.

Pages are (doc_id, page_idx, text); a row without page_idx is a document without pages. Lines become rows; frequencies are a partial and a final hash
aggregation by document and line, or a window where the lines themselves are wanted; a running count over
a page's drops caps what a page may lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import patterns as P
from pagewright.functions import text as X
from pagewright.schema import SuppressorConfig
from pagewright.sources.shared import partitions_for


def page_lines(pages: DataFrame) -> DataFrame:
    return X.explode_lines(pages, "text", ["doc_id", "page_idx"])


def line_frequencies(pages: DataFrame, rules: P.RuleSet = P.DEFAULT_RULES) -> DataFrame:
    """doc_id, norm, c (occurrences), t (as a page's first line), b (as its last): of lines that are neither blank nor headings."""
    rows = page_lines(pages).withColumn("__trim", X.trim(F.col("line"))).where(F.col("__trim") != "")
    rows = rows.where(~rules.heading(F.col("__trim"))).withColumn("norm", X.collapse(F.col("__trim")))
    return rows.groupBy("doc_id", "norm").agg(
        F.count("*").alias("c"), F.count_if(F.col("line_idx") == 0).alias("t"), F.count_if(F.col("line_idx") == F.col("n_lines") - 1).alias("b")
    )


def least_count(cfg: SuppressorConfig, n_pages: Column) -> Column:
    """The number of occurrences that make a line repeated: the ratio of the pages, rounded up, one at least."""
    num, den = cfg.ratio.numerator, cfg.ratio.denominator
    return F.greatest(F.lit(1), F.floor((F.lit(num) * F.greatest(F.lit(1), n_pages) + F.lit(den - 1)) / F.lit(den)))


def candidates(pages: DataFrame, cfg: SuppressorConfig = SuppressorConfig(), rules: P.RuleSet = P.DEFAULT_RULES) -> DataFrame:
    """doc_id, norm of the lines that recur often enough, at an edge of the page at least every other time."""
    counts = pages.groupBy("doc_id").agg(F.count("page_idx").alias("__pages"))
    least = least_count(cfg, F.col("__pages"))
    rows = line_frequencies(pages, rules).join(counts, "doc_id")
    size = F.octet_length("norm")
    often = (F.col("c") >= least) & size.between(cfg.min_bytes, cfg.max_bytes)
    return rows.where(often & ((2 * F.col("t") >= F.col("c")) | (2 * F.col("b") >= F.col("c"))) & ~rules.heading(F.col("norm"))).select("doc_id", "norm")


def classified_lines(pages: DataFrame, cfg: SuppressorConfig = SuppressorConfig(), rules: P.RuleSet = P.DEFAULT_RULES, keep_empty: bool = False) -> DataFrame:
    """Lines with their class (header, footer, number, repeated or text), drop, and drop_rank within the page.

    ``drop`` is the decision after rescue by ``keep_lines``; the first ``most_per_page`` drops of a page
    take effect. Lines are right-trimmed. With ``keep_empty`` a page without lines is one row of class
    text without a line.

    Pages are dealt by document once, before they become lines; counting a line within its document and
    ranking drops within their page are windows on that partitioning. (``candidates`` gives the repeated
    lines by themselves, as an aggregation.)
    """
    in_document = Window.partitionBy("doc_id")
    # A number keeps adaptive execution from joining partitions that are small in bytes but long to work on; it grows with the input.
    rows = pages.select("doc_id", "page_idx", "text")
    rows = rows.repartition(partitions_for(rows), "doc_id").withColumn("__pages", F.count("page_idx").over(in_document))
    rows = X.explode_lines(rows, "text", ["doc_id", "page_idx", "__pages"], keep_empty).withColumn("line", X.trim_end(F.col("line")))
    # Blank lines and headings are never repeated lines; they have no norm to be counted by.
    norm = X.normal(F.col("line"))
    rows = rows.withColumn("__norm", norm).withColumn("__norm", F.when((F.col("__norm") != "") & ~rules.heading(F.col("__norm")), F.col("__norm")))
    same = Window.partitionBy("doc_id", "__norm")
    c, t, b = F.count("*").over(same), F.count_if(F.col("line_idx") == 0).over(same), F.count_if(F.col("line_idx") == F.col("n_lines") - 1).over(same)
    rows = rows.withColumns({"__c": c, "__t": t, "__b": b})
    often = (F.col("__c") >= least_count(cfg, F.col("__pages"))) & F.octet_length("__norm").between(cfg.min_bytes, cfg.max_bytes)
    repeated = F.coalesce(often & ((2 * F.col("__t") >= F.col("__c")) | (2 * F.col("__b") >= F.col("__c"))), F.lit(False))
    rows = rows.withColumn("__repeated", repeated)
    line = F.col("line")
    kind = (
        F.when(rules.header(line), "header")
        .when(rules.footer(line), "footer")
        .when(P.matches(line, P.BARE_NUMBER_4), F.when(F.col("__repeated"), "number").otherwise("text"))
        .when(F.col("__repeated"), "repeated")
        .otherwise("text")
    )
    rows = rows.withColumn("class", kind)
    drop = F.col("class") != "text"
    if cfg.keep_lines is not None:
        drop = drop & ~line.rlike(P.java(cfg.keep_lines))
    rows = rows.withColumn("drop", F.coalesce(drop, F.lit(False)))
    order = Window.partitionBy("doc_id", "page_idx").orderBy("line_idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("drop_rank", F.sum(F.col("drop").cast("int")).over(order).cast("bigint"))
    kept = ~F.col("drop") | (F.col("drop_rank") > cfg.most_per_page)
    return rows.select("doc_id", "page_idx", "line_idx", "line", "class", "drop", "drop_rank", kept.alias("kept"))


def suppressed_pages(pages: DataFrame, classified: DataFrame) -> DataFrame:
    """doc_id, page_idx, text with the suppressed lines gone; pages without lines stay, as empty."""
    kept = classified.where("kept").groupBy("doc_id", "page_idx").agg(X.joined(F.col("line_idx"), F.col("line")).alias("__text"))
    return pages.select("doc_id", "page_idx").join(kept, ["doc_id", "page_idx"], "left").select("doc_id", "page_idx", F.coalesce("__text", F.lit("")).alias("text"))


def suppressor_stats(pages: DataFrame, classified: DataFrame, cfg: SuppressorConfig = SuppressorConfig()) -> DataFrame:
    """doc_id, removed_header, removed_footer, suppressor_overrun, removed_lines_sample (first dropped lines, in order)."""
    first = Window.partitionBy("doc_id").orderBy("page_idx", "line_idx")
    sample = (
        classified.where("drop")
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") <= cfg.sample)
        .groupBy("doc_id")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("__rank", X.trim(F.col("line")).alias("line")))), lambda x: x["line"]).alias("removed_lines_sample"))
    )
    counts = classified.groupBy("doc_id").agg(
        F.count_if(F.col("class") == "header").alias("removed_header"),
        F.count_if(F.col("class").isin("footer", "number")).alias("removed_footer"),
        F.count_if(F.col("drop") & (F.col("drop_rank") > cfg.most_per_page)).alias("suppressor_overrun"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return (
        pages.select("doc_id").distinct().join(counts, "doc_id", "left").join(sample, "doc_id", "left")
        .select("doc_id", zero("removed_header"), zero("removed_footer"), zero("suppressor_overrun"), F.coalesce("removed_lines_sample", F.array().cast("array<string>")).alias("removed_lines_sample"))
    )
