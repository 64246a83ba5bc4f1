"""Pages to documents, with recognised text in place of bad pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as X


def apply_overrides(pages: DataFrame, overrides: DataFrame) -> DataFrame:
    """Pages with the text of ``overrides`` (doc_id, page_idx, seq, text); the last of several wins, others' pages are ignored."""
    last = overrides.groupBy("doc_id", "page_idx").agg(F.max_by(F.struct("text"), "seq").alias("__new"))
    rows = pages.select("doc_id", "page_idx", "text").join(last, ["doc_id", "page_idx"], "left")
    return rows.select("doc_id", "page_idx", F.when(F.col("__new").isNotNull(), F.col("__new.text")).otherwise(F.col("text")).alias("text"))


def merge_pages(pages: DataFrame, *more: Column) -> DataFrame:
    """doc_id, text, and ``more`` aggregates: the pages in order, joined by a line feed; a null page is empty."""
    return pages.groupBy("doc_id").agg(X.joined(F.col("page_idx"), F.coalesce("text", F.lit(""))).alias("text"), *more)
