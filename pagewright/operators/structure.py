"""Legal headings as Markdown, and counts of what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import patterns as P


#: What may start a heading; a quick test before the patterns themselves.
HEADING_START = r"^\s*[MBPIVX]"


def kind_of(line: Column) -> Column:
    """menimbang, mengingat, bab, pasal, penjelasan, subheading or text."""
    return (
        F.when(~P.matches(line, HEADING_START), "text")
        .when(P.matches(line, P.PREAMBLE), F.lower(F.regexp_extract(line, P.java(P.PREAMBLE), 1)))
        .when(P.matches(line, P.CHAPTER), "bab")
        .when(P.matches(line, P.ARTICLE), "pasal")
        .when(P.matches(line, P.ELUCIDATION), "penjelasan")
        .when(P.matches(line, P.ROMAN_TITLE), "subheading")
        .otherwise("text")
    )


def markdown_of(line: Column, kind: Column) -> Column:
    group = lambda body, k: F.regexp_extract(line, P.java(body), k)
    return (
        F.when(kind == "text", line)
        .when(kind.isin("menimbang", "mengingat"), F.concat(F.lit("## "), group(P.PREAMBLE, 1)))
        .when(kind == "bab", F.concat(F.lit("## BAB "), group(P.CHAPTER, 1), group(P.CHAPTER, 2)))
        .when(kind == "pasal", F.concat(F.lit("## Pasal "), group(P.ARTICLE, 1)))
        .when(kind == "penjelasan", F.lit("## PENJELASAN"))
        .otherwise(F.concat(F.lit("### "), group(P.ROMAN_TITLE, 1), F.lit(". "), group(P.ROMAN_TITLE, 2)))
    )


def promote_headings(lines: DataFrame) -> DataFrame:
    """Lines with their kind, and Markdown in place of headings."""
    rows = lines.withColumn("kind", kind_of(F.col("line")))
    return rows.withColumn("line", markdown_of(F.col("line"), F.col("kind")))


def structure_counts(documents: DataFrame, promoted: DataFrame) -> DataFrame:
    """doc_id, bab, pasal, menimbang, mengingat, penjelasan."""
    k = F.col("kind")
    found = promoted.groupBy("doc_id").agg(
        F.count_if(k == "bab").alias("bab"), F.count_if(k == "pasal").alias("pasal"), *[F.bool_or(k == x).alias(x) for x in ("menimbang", "mengingat", "penjelasan")]
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return documents.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", zero("bab"), zero("pasal"), *[F.coalesce(x, F.lit(False)).alias(x) for x in ("menimbang", "mengingat", "penjelasan")]
    )


def markdown_counts(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """doc_id, bab, pasal: headings counted in Markdown lines."""
    found = lines.groupBy("doc_id").agg(F.count_if(P.matches(F.col("line"), P.MD_CHAPTER)).alias("bab"), F.count_if(P.matches(F.col("line"), P.MD_ARTICLE)).alias("pasal"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return documents.select("doc_id").join(found, "doc_id", "left").select("doc_id", zero("bab"), zero("pasal"))


def strict_violations(counts: DataFrame, law_mode: str) -> DataFrame:
    """Counts with violates: in the modes that demand structure, no chapter or no article."""
    demands = law_mode in ("pp", "permen")
    return counts.withColumn("violates", F.lit(demands) & ((F.col("bab") == 0) | (F.col("pasal") == 0)))
