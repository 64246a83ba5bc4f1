"""Comparison with ground truth, repeatability, and the acceptance report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOAL = 0.98


def parse_ground_truth(lines: DataFrame, column: str = "value") -> DataFrame:
    """doc_id, bab, pasal from lines like ``name: { bab: 1, pasal: 2 }``; comments and other lines go, missing numbers are 0."""
    line = F.col(column)
    number = lambda name: F.coalesce(F.expr(f"try_cast(regexp_extract({column}, '{name}:\\\\s*([0-9]+)', 1) AS BIGINT)"), F.lit(0).cast("bigint")).alias(name)
    rows = lines.where(~line.startswith("#") & (line != ""))
    return rows.select(F.regexp_extract(line, r"^\s*([^: ]+):", 1).alias("doc_id"), number("bab"), number("pasal")).where("doc_id <> ''")


def ground_truth_lines(counts: DataFrame) -> DataFrame:
    """doc_id, value: counts in the form that :func:`parse_ground_truth` reads."""
    return counts.select("doc_id", F.concat("doc_id", F.lit(": { bab: "), F.col("bab").cast("string"), F.lit(", pasal: "), F.col("pasal").cast("string"), F.lit(" }")).alias("value"))


def accuracy(found: Column, expected: Column) -> Column:
    """1 less the relative error; with nothing expected, 1 if nothing was found, else 0."""
    return F.when(expected == 0, F.when(found == 0, 1.0).otherwise(0.0)).otherwise(1.0 - F.abs(found - expected) / expected)


def compare_with_truth(counts: DataFrame, truth: DataFrame) -> DataFrame:
    """For documents in both: found and expected numbers, whether they are equal, and the accuracy of articles with its goal."""
    rows = counts.select("doc_id", "bab", "pasal").join(truth.select("doc_id", F.col("bab").alias("want_bab"), F.col("pasal").alias("want_pasal")), "doc_id")
    same = (F.col("bab") == F.col("want_bab")) & (F.col("pasal") == F.col("want_pasal"))
    right = accuracy(F.col("pasal"), F.col("want_pasal"))
    return rows.select("doc_id", "bab", "pasal", "want_bab", "want_pasal", same.alias("exact"), right.alias("accuracy"), (right >= GOAL).alias("reaches_goal"), F.when(same, "PASS").otherwise("FAIL").alias("status"))


def not_compared(counts: DataFrame, truth: DataFrame) -> DataFrame:
    """Documents of the ground truth that have no output."""
    return truth.join(counts, "doc_id", "left_anti").select("doc_id")


def overall(report: DataFrame) -> DataFrame:
    """One row: documents, failures, status (PASS if none fails)."""
    failed = F.count_if(F.col("status") == "FAIL")
    return report.agg(F.count("*").alias("documents"), failed.alias("failures"), F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"))


def repeatability(first: DataFrame, second: DataFrame, column: str = "meta_fingerprint") -> DataFrame:
    """doc_id, equal: whether two runs agree on ``column``; a document of one run alone differs."""
    a, b = first.select("doc_id", F.col(column).alias("__a"), F.lit(True).alias("__ina")), second.select("doc_id", F.col(column).alias("__b"), F.lit(True).alias("__inb"))
    return a.join(b, "doc_id", "full_outer").select("doc_id", (F.coalesce("__ina", F.lit(False)) & F.coalesce("__inb", F.lit(False)) & F.col("__a").eqNullSafe(F.col("__b"))).alias("equal"))


def acceptance(meta: DataFrame) -> DataFrame:
    """The report's row for each document: sizes, metrics, reasons for failure and status."""
    suspects, ran = F.size("suspect_pages"), F.size("ocr.ocr_run_pages")
    share = F.col("metrics.coverage_pages")
    reasons = F.concat_ws(",", F.when((suspects > 0) & (ran == 0), "OCRNoRunPages"), F.when((suspects > 0) & (share != 1.0), "CoveragePagesLow"))
    return meta.select(
        "doc_id", F.col("page_count").alias("pages"), suspects.alias("suspect"), ran.alias("ocr_run"), share.alias("coverage_pages"),
        F.col("p95_latency_ms_per_page").alias("p95_ms_per_page"), F.col("metrics.leak_rate").alias("leak"), F.col("metrics.split_violations").alias("split"),
        F.col("meta_fingerprint").alias("meta_fp"), F.lit("NA").alias("cache_hit_txt"), F.lit("NA").alias("cache_hit_img"), reasons.alias("reasons"),
        F.when(reasons == "", "PASS").otherwise("FAIL").alias("status"),
    )
