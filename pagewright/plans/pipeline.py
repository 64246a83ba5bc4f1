"""Pages to structured documents, as one plan.

Pages shuffle once, by document. Lines are rows for the suppressor alone, whose windows and aggregations
keep that partitioning; what follows works inside a document's row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import patterns as P
from pagewright.functions import text as X
from pagewright.operators import cleanup, quality, structure, suppress
from pagewright.operators.merge import apply_overrides, merge_pages
from pagewright.operators.ocr import decision
from pagewright.schema import PipelineConfig, SuppressorConfig
from pagewright.sources.emit import fingerprint


class StructureNotFound(Exception):
    pass


def _suppressed(pages: DataFrame, cfg: SuppressorConfig, rules: P.RuleSet) -> DataFrame:
    """doc_id, text (merged, after suppression) with the suppressor's counters and sample."""
    rows = suppress.classified_lines(pages, cfg, rules, keep_empty=True)
    dropped = F.col("drop")
    by_page = rows.groupBy("doc_id", "page_idx").agg(
        X.joined(F.col("line_idx"), F.when(F.col("kept"), F.col("line"))).alias("text"),
        F.count_if(F.col("class") == "header").alias("h"),
        F.count_if(F.col("class").isin("footer", "number")).alias("f"),
        F.count_if(dropped & (F.col("drop_rank") > cfg.most_per_page)).alias("o"),
        F.array_sort(F.collect_list(F.when(dropped & (F.col("drop_rank") <= cfg.sample), F.struct("line_idx", X.trim(F.col("line")).alias("line"))))).alias("s"),
    )
    by_order = F.array_sort(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("page_idx", "s"))))
    sample = F.flatten(F.transform(by_order, lambda p: F.transform(p["s"], lambda x: x["line"])))
    return by_page.groupBy("doc_id").agg(
        F.count("page_idx").cast("int").alias("page_count"),
        X.joined(F.col("page_idx"), F.col("text")).alias("text"),
        F.sum("h").alias("suppressed_header"), F.sum("f").alias("suppressed_footer"), F.sum("o").alias("suppressor_overrun"),
        F.slice(sample, 1, cfg.sample).alias("removed_lines_sample"),
    )


LEAK_START = r"^\s*[TtLlHh\x{2012}\x{2013}\x{2014}\x{2212}\-]"


def _leaks(lines):
    """The number of gazette headers and numbered footers in an array of lines."""
    leak = lambda x: P.matches(x, LEAK_START) & (P.matches(x, P.GAZETTE, True) | P.matches(x, P.DASHED_NUMBER) | P.matches(x, P.PAGE_WORD, True))
    return F.size(F.filter(lines, leak)).cast("bigint")


NO_SUPPRESSION = ("suppressed_header", "suppressed_footer", "suppressor_overrun")


def _merged(pages: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """doc_id, page_count, text, with the suppressor's counters and sample; zeros and an empty sample without one."""
    if cfg.suppressor is not None:
        return _suppressed(pages, cfg.suppressor, cfg.rules)
    rows = merge_pages(pages, F.count("page_idx").cast("int").alias("page_count"))
    nothing = {c: F.lit(0).cast("bigint") for c in NO_SUPPRESSION}
    return rows.withColumns({**nothing, "removed_lines_sample": F.array().cast("array<string>")})


def _with_markdown(rows: DataFrame) -> DataFrame:
    """``rows`` (with lines) plus md_lines, markdown, and the numbers and flags of its headings."""

    def classified(line):
        return F.struct(line.alias("line"), structure.kind_of(line).alias("kind"))

    def number_of(kind: str):
        return F.size(F.filter("lines", lambda x: x["kind"] == kind)).cast("bigint")

    rows = rows.withColumn("lines", F.transform("lines", classified))
    rows = rows.withColumn("md_lines", F.transform("lines", lambda x: structure.markdown_of(x["line"], x["kind"])))
    counts = {kind: number_of(kind) for kind in ("bab", "pasal")}
    flags = {kind: number_of(kind) > 0 for kind in ("menimbang", "mengingat", "penjelasan")}
    return rows.withColumns({"markdown": F.array_join("md_lines", "\n"), **counts, **flags})


def _lone_mark(line):
    return P.matches(line, P.LONE_LETTER) | P.matches(line, P.ANY_LONE_NUMBER)


def structured(pages: DataFrame, cfg: PipelineConfig = PipelineConfig(), overrides: DataFrame | None = None) -> DataFrame:
    """One row per document: pages, raw text, Markdown, headings found, counters and metrics.

    A row of ``pages`` without page_idx stands for a document without pages, whose text and counts are empty.
    """
    if overrides is not None:
        pages = apply_overrides(pages, overrides)
    text = F.col("text")
    rows = _merged(pages, cfg).withColumns({"raw_text": text, "raw_leaks": _leaks(X.lines(text)), "raw_chars": X.visible_length(text)})
    rows = _with_markdown(cleanup.clean_whole(rows, cfg.rules))
    # The Markdown's own lines: without an empty last one.
    md_lines = F.col("md_lines")
    own = F.when(F.try_element_at(md_lines, F.lit(-1)) == "", F.slice(md_lines, F.lit(1), F.size(md_lines) - 1)).otherwise(md_lines)
    rows = rows.withColumns({"md_leaks": _leaks(own), "lone_marks": F.size(F.filter(own, _lone_mark)), "md_chars": X.visible_length(F.col("markdown"))})
    leaks = F.col("raw_leaks") + F.col("md_leaks")
    return rows.select(
        "doc_id", "page_count", "raw_text", "markdown", "bab", "pasal", "menimbang", "mengingat", "penjelasan", "hyphens_fixed",
        (F.col("suppressed_header") + F.col("removed_header")).alias("removed_header"),
        (F.col("suppressed_footer") + F.col("removed_footer")).alias("removed_footer"),
        "suppressor_overrun", "removed_lines_sample",
        F.when(F.col("raw_chars") > 0, F.least(F.lit(1.0), F.col("md_chars") / F.col("raw_chars"))).otherwise(0.0).alias("character_coverage"),
        F.when(leaks > 0, F.col("md_leaks") / leaks).otherwise(0.0).alias("leak_rate"),
        (F.regexp_count("markdown", F.lit(P.java(P.SPLIT_PAREN))) + F.col("lone_marks")).cast("bigint").alias("split_violations"),
    )


def document_meta(
    pages: DataFrame, cfg: PipelineConfig = PipelineConfig(), timings: DataFrame | None = None, overrides: DataFrame | None = None, ocr_enabled: bool = False, docs: DataFrame | None = None
) -> DataFrame:
    """The metadata of each document (see ``schema.DOCUMENT_META``) with its fingerprint.

    ``timings`` has doc_id, started_ms, finished_ms; without it both are 0. ``overrides`` are recognised
    pages, which count as run. ``docs`` is what :func:`structured` gave for the same arguments, if that is at hand.
    """
    docs = (structured(pages, cfg, overrides) if docs is None else docs).drop("page_count", "raw_text", "markdown")
    summary = quality.suspect_summary(pages, cfg.min_chars, cfg.sample_suspects, overrides)
    zero = F.lit(0).cast("bigint")
    if timings is None:
        rows = docs.join(summary, "doc_id").withColumns({"started_ms": zero, "finished_ms": zero})
    else:
        rows = docs.join(summary, "doc_id").join(timings, "doc_id", "left").withColumns({c: F.coalesce(c, zero) for c in ("started_ms", "finished_ms")})
    asked = decision(F.lit(ocr_enabled), F.lit(cfg.ocr.requested).cast("boolean"), F.size("suspect_pages"))
    rows = rows.withColumn("__ms", F.when(F.col("page_count") > 0, F.expr("greatest(finished_ms - started_ms, 0L) div page_count")).otherwise(zero))
    ocr = {
        "dpi": F.lit(cfg.ocr.dpi), "enabled": F.lit(ocr_enabled), "lang": F.lit(cfg.ocr.lang), "ocr_run_pages": F.col("ocr_run_pages"), "oem": F.lit(cfg.ocr.oem),
        "psm": F.lit(cfg.ocr.psm), "ran": asked["ran"], "skipped_reason": asked["skipped_reason"],
    }
    meta = rows.select(
        "doc_id", F.lit("poppler").alias("engine"),
        F.struct("bab", "mengingat", "menimbang", "pasal", "penjelasan").alias("found"),
        F.struct("character_coverage", "coverage_pages", "leak_rate", "split_violations").alias("metrics"),
        F.struct(*[v.alias(n) for n, v in ocr.items()]).alias("ocr"),
        F.col("__ms").alias("p95_latency_ms_per_page"), "page_count",
        F.struct("hyphens_fixed", "removed_footer", "removed_header", "removed_lines_sample", "suppressor_overrun").alias("stats"),
        "suspect_pages", F.array_repeat("__ms", F.col("page_count")).alias("timing_ms_per_page"),
        F.struct("finished_ms", "started_ms").alias("timestamps"),
    )
    return fingerprint(meta)


class Pipeline:
    """A run over pages whose steps can be looked at by name."""

    def __init__(self, pages: DataFrame, cfg: PipelineConfig = PipelineConfig(), overrides: DataFrame | None = None) -> None:
        self.cfg, self.pages = cfg, pages
        self.after_ocr = pages if overrides is None else apply_overrides(pages, overrides)
        self.result = structured(pages, cfg, overrides)

    def stage(self, name: str) -> DataFrame:
        """extracted, merged, suppressed, candidates, cleaned or markdown."""
        if name == "extracted":
            return self.pages
        if name == "merged":
            return merge_pages(self.after_ocr)
        if name in ("suppressed", "candidates") and self.cfg.suppressor:
            if name == "candidates":
                return suppress.candidates(self.after_ocr, self.cfg.suppressor, self.cfg.rules)
            return suppress.suppressed_pages(self.after_ocr, suppress.classified_lines(self.after_ocr, self.cfg.suppressor, self.cfg.rules))
        if name == "cleaned":
            raw = self.result.select("doc_id", F.col("raw_text").alias("text"))
            return cleanup.to_documents(raw, cleanup.cleanup_lines(raw, self.cfg.rules)[0])
        if name == "markdown":
            return self.result.select("doc_id", F.col("markdown").alias("text"))
        raise KeyError(name)

    def check_structure(self) -> None:
        """In strict mode, raises if a document of a mode that demands structure has no chapter or no article."""
        if self.cfg.strict and not structure.strict_violations(self.result, self.cfg.law_mode).where("violates").isEmpty():
            raise StructureNotFound(self.cfg.law_mode)
