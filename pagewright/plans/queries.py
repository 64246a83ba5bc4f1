"""The query catalogue: each entry takes (spark, sf_dir) and runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators import cleanup, merge, ocr, quality, report, slugs, structure, suppress
from pagewright.plans.corpus import legal_from, legal_pages, pages_of, single_page_documents, truth_of
from pagewright.plans.pipeline import document_meta, structured
from pagewright.schema import OcrConfig, PipelineConfig, SuppressorConfig
from pagewright.sources.documents import enumerate_files, extract_pages, split_form_feeds
from pagewright.sources.emit import file_name, meta_json, read_meta, write_files, write_table
from pagewright.sources.shared import materialize, new_path
from pagewright.streaming.documents import documents_of_batch, merged_batches, read_pages

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}


def query(f: Query) -> Query:
    CATALOGUE[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _suppressed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = legal_pages(spark, sf_dir)
    return merge.merge_pages(suppress.suppressed_pages(pages, suppress.classified_lines(pages)))


def _text_lines(documents: DataFrame) -> DataFrame:
    return cleanup.furniture(cleanup.numbered_lines(cleanup.dehyphenate(documents))).where(F.col("class") == "text").drop("class")


def _soft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanup.join_soft_wraps(_text_lines(_suppressed_documents(spark, sf_dir)))


def _promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.promote_headings(cleanup.reread(cleanup.normalise_lists(cleanup.merge_stray_marks(_soft(spark, sf_dir)))))


def _raw_and_markdown(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Merged text without the suppressor, and its Markdown."""
    raw = merge.merge_pages(legal_pages(spark, sf_dir))
    return raw, cleanup.to_documents(raw, structure.promote_headings(cleanup.reread(cleanup.cleanup_lines(raw)[0])))


def _report(pages: DataFrame) -> DataFrame:
    return structured(pages).select(
        "doc_id", "page_count", "bab", "pasal", "menimbang", "mengingat", "penjelasan", "hyphens_fixed", "removed_header", "removed_footer", "suppressor_overrun", "character_coverage", "leak_rate", "split_violations"
    )


@query
def document_report(spark, sf_dir):
    return _report(legal_pages(spark, sf_dir))


@query
def single_page_report(spark, sf_dir):
    return _report(single_page_documents(spark, sf_dir))


@query
def page_lines(spark, sf_dir):
    return suppress.page_lines(legal_pages(spark, sf_dir))


@query
def document_lines(spark, sf_dir):
    return X.explode_lines(read(spark, sf_dir, "documents"), "text", ["doc_id"])


@query
def suspect_pages(spark, sf_dir):
    return quality.suspect_pages(pages_of(spark, sf_dir))


@query
def suspect_summary(spark, sf_dir):
    return quality.suspect_summary(pages_of(spark, sf_dir)).drop("ocr_run_pages")


@query
def suspect_sample(spark, sf_dir):
    return quality.suspect_summary(pages_of(spark, sf_dir), sample=1).select("doc_id", "suspect_pages", "coverage_pages")


@query
def merge_overrides(spark, sf_dir):
    pages = pages_of(spark, sf_dir)
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("int").alias("page_idx"), F.concat(F.lit("OCR "), "text").alias("text"))
    overrides = quality.suspect_pages(pages).select("doc_id", "page_idx").join(items, "page_idx").withColumn("seq", F.lit(0))
    return merge.merge_pages(merge.apply_overrides(pages, overrides))


@query
def formfeed_pages(spark, sf_dir):
    pages = pages_of(spark, sf_dir).withColumn("text", F.when(F.col("page_idx") % 3 == 1, " ").otherwise(F.col("text")))
    joined = pages.groupBy("doc_id").agg(F.concat(X.joined(F.col("page_idx"), F.col("text"), "\f"), F.lit("\f \f")).alias("text"))
    return split_form_feeds(joined)


@query
def repeated_line_freq(spark, sf_dir):
    return suppress.line_frequencies(legal_pages(spark, sf_dir))


@query
def document_line_freq(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return suppress.line_frequencies(docs.select("doc_id", F.lit(0).alias("page_idx"), "text"))


@query
def repeated_line_candidates(spark, sf_dir):
    return suppress.candidates(legal_pages(spark, sf_dir))


@query
def candidate_lists(spark, sf_dir):
    return suppress.candidates(legal_pages(spark, sf_dir)).groupBy("doc_id").agg(F.array_sort(F.collect_set("norm")).alias("candidates"))


@query
def line_classes(spark, sf_dir):
    return suppress.classified_lines(legal_pages(spark, sf_dir))


@query
def suppressed_pages(spark, sf_dir):
    pages = legal_pages(spark, sf_dir)
    return suppress.suppressed_pages(pages, suppress.classified_lines(pages))


@query
def suppressor_stats(spark, sf_dir):
    pages = legal_pages(spark, sf_dir)
    return suppress.suppressor_stats(pages, suppress.classified_lines(pages))


@query
def keep_lines_rescue(spark, sf_dir):
    pages, cfg = legal_pages(spark, sf_dir), SuppressorConfig(keep_lines="^- [0-9]|^kaki")
    rows = suppress.classified_lines(pages, cfg)
    return suppress.suppressed_pages(pages, rows).join(suppress.suppressor_stats(pages, rows, cfg).drop("removed_lines_sample"), "doc_id")


@query
def dehyphenate(spark, sf_dir):
    return cleanup.dehyphenate(_suppressed_documents(spark, sf_dir))


@query
def header_footer_drop(spark, sf_dir):
    raw = cleanup.dehyphenate(merge.merge_pages(legal_pages(spark, sf_dir)))
    return cleanup.furniture_counts(raw, cleanup.furniture(cleanup.numbered_lines(raw)))


@query
def soft_wrap(spark, sf_dir):
    return _soft(spark, sf_dir)


@query
def orphan_merge(spark, sf_dir):
    return cleanup.merge_stray_marks(_soft(spark, sf_dir))


@query
def list_normalise(spark, sf_dir):
    return cleanup.normalise_lists(cleanup.merge_stray_marks(_soft(spark, sf_dir)))


@query
def cleanup_full(spark, sf_dir):
    documents = _suppressed_documents(spark, sf_dir)
    lines, stats = cleanup.cleanup_lines(documents)
    return cleanup.to_documents(documents, lines, "cleaned").join(stats, "doc_id")


@query
def heading_promote(spark, sf_dir):
    return _promoted(spark, sf_dir)


@query
def structure_counts(spark, sf_dir):
    return structure.structure_counts(pages_of(spark, sf_dir).select("doc_id").distinct(), _promoted(spark, sf_dir))


@query
def markdown_counts(spark, sf_dir):
    return structure.markdown_counts(pages_of(spark, sf_dir).select("doc_id").distinct(), _promoted(spark, sf_dir))


@query
def coverage(spark, sf_dir):
    return quality.coverage(*_raw_and_markdown(spark, sf_dir))


@query
def leak_rate(spark, sf_dir):
    return quality.leak_rate(*_raw_and_markdown(spark, sf_dir))


@query
def split_violations(spark, sf_dir):
    return quality.split_violations(_raw_and_markdown(spark, sf_dir)[1])


@query
def latency(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("user_id", F.floor("value").alias("ms"))
    return quality.latency(events, "user_id")


@query
def url_slugs(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return slugs.with_unique_slugs(pages, slugs.base_name(F.col("path")), ["page_id"]).select("page_id", "slug", "doc_id")


@query
def source_slugs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat_ws(" ", "source", F.concat("lang", F.lit(".PDF"))).alias("name"))
    return slugs.with_unique_slugs(docs, F.col("name"), ["id"]).select(F.col("id").alias("doc_id"), "slug", F.col("doc_id").alias("unique_slug"))


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the derived corpus and of the conversations themselves, some pages of which are suspect, with times from their sizes."""
    plain = pages_of(spark, sf_dir).withColumn("doc_id", F.concat(F.lit("raw-"), "doc_id"))
    pages = legal_pages(spark, sf_dir).unionByName(plain)
    times = pages.groupBy("doc_id").agg(F.lit(1000).cast("bigint").alias("started_ms"), (F.sum(F.length("text")) + 1000).alias("finished_ms"))
    return document_meta(pages, PipelineConfig(), times)


@query
def fingerprint(spark, sf_dir):
    return _metadata(spark, sf_dir).select("doc_id", "meta_fingerprint")


@query
def markdown_digest(spark, sf_dir):
    return structured(legal_pages(spark, sf_dir)).select("doc_id", F.sha2("markdown", 256).alias("markdown_sha256"))


@query
def ground_truth_report(spark, sf_dir):
    return report.compare_with_truth(structure_counts(spark, sf_dir), truth_of(spark, sf_dir))


@query
def ground_truth_overall(spark, sf_dir):
    return report.overall(ground_truth_report(spark, sf_dir))


@query
def ground_truth_skipped(spark, sf_dir):
    truth = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_id")).distinct()
    return report.not_compared(pages_of(spark, sf_dir).select("doc_id").distinct(), truth)


@query
def idempotency(spark, sf_dir):
    """Two runs over pages dealt in two ways, written as tables and compared by Markdown, metadata and fingerprint; with the digest of the first."""
    pages, runs = legal_pages(spark, sf_dir), []
    for dealt in (pages, pages.repartition(7, "page_idx")):
        # Written once a run: metadata and Markdown would each structure the pages anew.
        docs = materialize(spark, structured(dealt).drop("raw_text"), "structured")
        out = meta_json(document_meta(dealt, docs=docs)).join(docs.select("doc_id", "markdown"), "doc_id")
        path = new_path(spark, "run")
        write_table(out, path)
        runs.append(spark.read.parquet(path).select("doc_id", F.sha2(F.concat_ws("\n", "markdown", "meta_json"), 256).alias("digest"), F.sha2("markdown", 256).alias("markdown_sha256")))
    return runs[0].select("doc_id", "markdown_sha256").join(report.repeatability(*runs, "digest"), "doc_id", "full_outer")


@query
def strict_check(spark, sf_dir):
    return structure.strict_violations(structure_counts(spark, sf_dir).select("doc_id", "bab", "pasal"), "pp")


@query
def ocr_decision(spark, sf_dir):
    rows = quality.suspect_summary(pages_of(spark, sf_dir)).select("doc_id", F.size("suspect_pages").alias("suspects"))
    rows = rows.withColumn("enabled", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn("forced", F.explode(F.array(F.lit(None).cast("boolean"), F.lit(True), F.lit(False))))
    return rows.select("doc_id", "enabled", "forced", "suspects", *[c.alias(n) for n, c in ocr.decision(F.col("enabled"), F.col("forced"), F.col("suspects")).items()])


@query
def ground_truth_parse(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    pasal = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit(", pasal: "), F.col("doc_id").cast("string")))
    lines = docs.select(F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(": { bab: "), F.col("n_chars").cast("string"), pasal, F.lit(" }")).alias("value"))
    return report.parse_ground_truth(lines.unionByName(spark.sql("SELECT * FROM VALUES ('# comment'), ('') AS t(value)")))


@query
def ground_truth_lines(spark, sf_dir):
    """Ground truth frozen from the Markdown of a run."""
    return report.ground_truth_lines(markdown_counts(spark, sf_dir))


@query
def acceptance_report(spark, sf_dir):
    """Metrics of the derived corpus with the page sizes of the conversations, so that some pages are suspect."""
    meta = document_meta(legal_pages(spark, sf_dir))
    sizes = quality.suspect_summary(pages_of(spark, sf_dir))
    joined = meta.drop("suspect_pages").join(sizes.select("doc_id", "suspect_pages", F.col("coverage_pages").alias("__share")), "doc_id")
    joined = joined.withColumn("metrics", F.col("metrics").withField("coverage_pages", F.col("__share"))).drop("__share")
    return report.acceptance(joined).drop("meta_fp")


@query
def document_metadata(spark, sf_dir):
    """Metadata as canonical JSON."""
    return meta_json(_metadata(spark, sf_dir))


@query
def meta_read(spark, sf_dir):
    """Metadata written as JSON files, read back, and flattened."""
    meta, path = _metadata(spark, sf_dir), new_path(spark, "meta")
    meta_json(meta).select("meta_json").write.text(path)
    read = read_meta(spark.read.text(path), meta.schema.simpleString())
    nested = [(c, f.name) for c in ("found", "metrics", "ocr", "stats", "timestamps") for f in read.schema[c].dataType]
    return read.select(
        "doc_id", "engine", "meta_fingerprint", "p95_latency_ms_per_page", "page_count", "suspect_pages", "timing_ms_per_page", *(F.col(f"{c}.{x}").alias(f"{c}_{x}") for c, x in nested)
    )


@query
def extracted_files(spark, sf_dir):
    """Conversations as files cut by form feeds, every ninth of them blank: written, enumerated, named, decoded and cut into pages again."""
    pages = pages_of(spark, sf_dir)
    joined = pages.groupBy("doc_id").agg(X.joined(F.col("page_idx"), F.col("text"), "\f").alias("text"))
    blank = F.col("doc_id").cast("long") % 9 == 0
    path = new_path(spark, "files")
    named = joined.select(F.concat(F.lit("File No. "), "doc_id").alias("name"), F.when(blank, " \f").otherwise(F.col("text")).alias("text"))
    write_files(named, path)
    files = enumerate_files(spark, path, "*.txt")
    # In some stores part files have names of their own; the name that was written stands for the file's.
    files = files.select(slugs.slugify(file_name(F.col("path"))).alias("doc_id"), "content")

    def cut(content: bytes) -> list[str]:
        parts = content.decode("utf-8", "replace").removesuffix("\x00").split("\f")
        while parts and not parts[-1].strip():
            parts.pop()
        return parts

    return extract_pages(files, cut).select("doc_id", "page_idx", "text", "error")


@query
def recognised_pages(spark, sf_dir):
    """Suspect pages through the retry ladder with a recogniser that fails by page number, and what becomes of them."""
    pages = pages_of(spark, sf_dir)
    files = pages.select("doc_id").distinct().withColumn("content", F.col("doc_id").cast("binary"))

    def render_page(content: bytes, page_idx: int, dpi: int, folder: str) -> str:
        if page_idx % 5 == 4:
            raise RuntimeError("image_missing")
        return f"{content.decode()}/{page_idx}"

    def recognise(image: str, lang: str, psm: int, oem: int) -> str:
        page_idx = int(image.split("/")[1])
        if page_idx % 5 == 3:
            raise RuntimeError("tesseract_exit_1")
        return " " if page_idx % 5 == 2 or (page_idx % 5 == 1 and psm != 6) else f"{image} {lang} {psm}"

    asked = quality.suspect_pages(pages, 200).select("doc_id", "page_idx")
    return ocr.recognise_pages(asked, files, OcrConfig(lang="ind"), recognise, render_page, tools=())


@query
def stream_structure_counts(spark, sf_dir):
    """Structure counts of a file stream of conversations, all that is there in one batch."""
    folder = new_path(spark, "stream")
    path = f"{sf_dir}/conversations.parque[t]"  # a pattern may match one file as well as a folder
    source = read_pages(spark, path, read(spark, sf_dir, "conversations").schema)

    def plan(batch: DataFrame) -> DataFrame:
        counts = structured(legal_from(batch), PipelineConfig())
        return counts.select("doc_id", "bab", "pasal", "menimbang", "mengingat", "penjelasan")

    documents_of_batch(source, plan, f"{folder}/out", f"{folder}/checkpoint", 3600)
    return merged_batches(spark, f"{folder}/out")
