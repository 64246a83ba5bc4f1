"""The command line: files of a job to Markdown and metadata.

    python -m pagewright.cli job.yaml [--strict] [--law-mode MODE] [--with-ocr[=on|off]] [--ocr-lang LANG] ...

A file that cannot be read is reported and skipped; the others are written, and the exit code tells.
"""

from __future__ import annotations

import json
import os
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators import ocr, quality, suppress
from pagewright.operators.merge import apply_overrides, merge_pages
from pagewright.plans.pipeline import document_meta, structured
from pagewright.operators.structure import strict_violations
from pagewright.sources import config, documents, emit
from pagewright.sources.shared import materialize


#: Failed files that are logged one by one; all are in a table beside the output.
LOGGED_FAILURES = 1000


#: Steps that not every document has, and their folders below the artifacts.
OPTIONAL_STEPS = {"ocr_summary": ("ocr",)}


def log(tool: str, **details) -> None:
    print(json.dumps({"tool": tool, **details}), file=sys.stderr)


def split_glob(pattern: str) -> tuple[str, str]:
    """(folder before the first wildcard, pattern of the file name)."""
    folder, name = os.path.split(pattern)
    return re.split(r"[*?\[{]", folder, maxsplit=1)[0] or ".", name or "*.pdf"


def write_steps(folder: str, per_doc_dir: bool, steps: DataFrame) -> None:
    """Text files of intermediate results below each document's artifacts folder."""
    names = [c for c in steps.columns if c != "doc_id"]

    def run(rows) -> None:
        for r in rows:
            own = os.path.join(folder, r.doc_id, "artifacts") if per_doc_dir else os.path.join(folder, "artifacts", r.doc_id)
            os.makedirs(own, exist_ok=True)
            for n in names:
                if n in OPTIONAL_STEPS and r[n] is None:
                    continue
                path = os.path.join(own, *OPTIONAL_STEPS.get(n, ()), f"{n}.txt")
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "w", encoding="utf-8", newline="") as f:
                    f.write(r[n] or "")

    steps.foreachPartition(run)


def run_job(spark: SparkSession, job: config.Job, flags: config.Flags, extractor=documents.poppler, recogniser=ocr.tesseract, renderer=ocr.render, ocr_tools=("pdftoppm", "tesseract"), which=None) -> int:
    """Structure the job's files and write them; the exit code."""
    import shutil

    cfg, which = flags.config, which or shutil.which
    sample = os.environ.get("CI_SAMPLE_SUSPECTS", "")
    sample = int(sample) if sample.isdigit() and int(sample) else None
    root, pattern = split_glob(job.input_glob)
    try:
        files = documents.enumerate_files(spark, root, pattern)
    except Exception as e:
        if not isinstance(e, documents.NoFilesFound) and "PATH_NOT_FOUND" not in str(e):
            raise
        log("enumerate_pdfs", error="NoFilesFound", guidance=documents.GUIDANCE.format(path=job.input_glob))
        return config.EXIT_CODES["no_files"]
    extracted = materialize(spark, documents.extract_pages(files, extractor), "pages")
    pages = documents.good_pages(extracted)
    errors = extracted.where("error is not null").select("doc_id", "error")
    failed, table = errors.count(), f"{job.output_dir.rstrip('/')}-failures"
    for r in errors.orderBy("doc_id").limit(LOGGED_FAILURES).collect():
        log("poppler_extract", doc_id=r.doc_id, error=r.error)
    try:
        errors.write.mode("overwrite").parquet(table)
    except Exception:  # what is written was read before, so only the folder can be at fault
        log("emit_files", error="WriteFailed")
        return config.EXIT_CODES["write"]
    log("poppler_extract", failed=failed, table=table)

    enabled = all(which(t) for t in ocr_tools)
    summary = quality.suspect_summary(pages, cfg.min_chars, sample)
    overrides = seen = None
    if enabled and cfg.ocr.requested is not False:
        suspects = summary.select("doc_id", F.explode("suspect_pages").alias("page_idx"))
        seen = materialize(spark, ocr.recognise_pages(suspects, files, cfg.ocr, recogniser, renderer, ocr_tools), "recognised")
        overrides = seen.where("text is not null").select("doc_id", "page_idx", F.lit(0).alias("seq"), "text")
        tried, good, skipped = seen.agg(F.count("*"), F.count("text"), F.count_if("skipped")).first()
        log("ocr_tesseract", attempted=tried, success=good, failed=tried - good, skipped=skipped)
    if sample:
        cfg = config.PipelineConfig(**{**vars(cfg), "sample_suspects": sample})
    docs = materialize(spark, structured(pages, cfg, overrides), "structured")
    if cfg.strict and not strict_violations(docs, cfg.law_mode).where("violates").isEmpty():
        log("promote_legal_headings", error="StructureNotFound")
        return config.EXIT_CODES["structure"]
    meta = document_meta(pages, cfg, documents.timings(extracted), overrides, enabled, docs)
    out = emit.meta_json(meta).join(docs.select("doc_id", "markdown"), "doc_id")
    try:
        emit.export_files(out, job.output_dir, flags.per_doc_dir)
        if flags.artifacts or flags.dump_steps:
            step = lambda df, name: merge_pages(df).withColumnRenamed("text", name)
            merged = apply_overrides(pages, overrides) if overrides is not None else pages
            steps = step(pages, "step1_extract").join(step(merged, "step2_merge"), "doc_id")
            steps = steps.join(docs.select("doc_id", F.col("raw_text").alias("suppressed"), F.col("markdown").alias("step3_md")), "doc_id")
            if cfg.suppressor:
                repeated = suppress.candidates(merged, cfg.suppressor, cfg.rules).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("norm")), "\n").alias("suppressor_preview"))
                steps = steps.join(repeated, "doc_id", "left")
            if seen is not None:
                steps = steps.join(ocr.summary(seen), "doc_id", "left")
            write_steps(job.output_dir, flags.per_doc_dir, steps)
    except Exception as e:
        if "WriteFailed" not in str(e):
            raise
        log("emit_files", error="WriteFailed")
        return config.EXIT_CODES["write"]
    return config.EXIT_CODES["extraction"] if failed else 0


def main(args: list[str]) -> int:
    path = next((a for a in args[:1] if not a.startswith("--")), "./prd.yaml")
    try:
        job = config.load_job(path)
    except config.ConfigError as e:
        log("validate_prd", error=e.kind, message=str(e))
        return config.EXIT_CODES["config"]
    ok, missing = config.check_tools()
    log("check_deps", ok=ok, missing=missing)
    if not ok:
        print(config.install_hint(missing), file=sys.stderr)
        return config.EXIT_CODES["dependencies"]
    spark = SparkSession.builder.appName("pagewright").getOrCreate()
    return run_job(spark, job, config.parse_flags(args))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
