"""Recognition of suspect pages by an exchangeable recogniser, and the decision to run it."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.schema import OcrConfig

RESULT = "doc_id string, page_idx int, text string, error string, skipped boolean"
FALLBACK_LANG, FALLBACK_PSM = "ind+eng", 6
TIMEOUT_S = 45
#: Suspect pages of a file that one row carries; a file of many is dealt to several tasks.
PAGES_A_ROW = 32

#: (image path, language, page segmentation mode, engine mode) to text; raises RuntimeError with a reason.
Recogniser = Callable[[str, str, int, int], str]


def decision(enabled: Column, forced: Column, suspects: Column) -> dict[str, Column]:
    """requested, ran and skipped_reason, from tools present, the flag (null: automatic) and the number of suspects."""
    some = suspects > 0
    requested = F.coalesce(forced, some)
    reason = F.when(~some, F.lit(None)).when(~enabled, "tesseract_missing").when(forced.eqNullSafe(F.lit(False)), "disabled_by_flag")
    return {"requested": requested, "ran": enabled & requested & some, "skipped_reason": reason.cast("string")}


def with_retries(recognise: Recogniser, image: str, cfg: OcrConfig) -> tuple[str | None, str | None]:
    """(text, None) of the first attempt with text, or (None, reasons): as asked, then with the fallback language, then with the fallback mode."""
    fallback = cfg.lang if "+" in cfg.lang else FALLBACK_LANG
    reasons = []
    for lang, psm in ((cfg.lang, cfg.psm), (fallback, cfg.psm), (fallback, FALLBACK_PSM)):
        try:
            text = recognise(image, lang, psm, cfg.oem)
        except RuntimeError as e:
            reasons.append(str(e))
            continue
        if text.strip():
            return text, None
        reasons.append("empty_text")
    return None, ";".join(reasons)


def tesseract(image: str, lang: str, psm: int, oem: int) -> str:
    try:
        done = subprocess.run(["tesseract", image, "stdout", "-l", lang, "--psm", str(psm), "--oem", str(oem)], capture_output=True, timeout=TIMEOUT_S)
    except (OSError, subprocess.TimeoutExpired) as e:
        raise RuntimeError(f"tesseract_spawn_error: {e}") from e
    if done.returncode:
        raise RuntimeError(f"tesseract_exit_{done.returncode}")
    return done.stdout.decode("utf-8", "replace")


def render(content: bytes, page_idx: int, dpi: int, folder: str) -> str:
    """The page as an image file; raises RuntimeError with a reason."""
    source, prefix = os.path.join(folder, "in.pdf"), os.path.join(folder, f"p{page_idx + 1}")
    with open(source, "wb") as f:
        f.write(content)
    try:
        done = subprocess.run(["pdftoppm", "-r", str(dpi), "-f", str(page_idx + 1), "-l", str(page_idx + 1), "-png", "-singlefile", source, prefix], capture_output=True, timeout=TIMEOUT_S)
    except (OSError, subprocess.TimeoutExpired) as e:
        raise RuntimeError("pdftoppm_failed") from e
    if done.returncode:
        raise RuntimeError("pdftoppm_failed")
    if not os.path.exists(f"{prefix}.png"):
        raise RuntimeError("image_missing")
    if not os.path.getsize(f"{prefix}.png"):
        raise RuntimeError("image_zero_size")
    return f"{prefix}.png"


def recognise_pages(suspects: DataFrame, files: DataFrame, cfg: OcrConfig, recogniser: Recogniser = tesseract, renderer=render, tools: tuple[str, ...] = ("pdftoppm", "tesseract")) -> DataFrame:
    """doc_id, page_idx, text, error, skipped for each row of ``suspects``; ``files`` has doc_id and content.

    A page that fails has an error and no text; where a tool is missing, pages are skipped. No failure
    ends the job. A file is handed on once for up to ``PAGES_A_ROW`` of its suspect pages, not once for each.
    """
    in_order = F.row_number().over(Window.partitionBy("doc_id").orderBy("page_idx")) - 1
    asked = suspects.select("doc_id", "page_idx").withColumn("__part", F.floor(in_order / PAGES_A_ROW))
    asked = asked.groupBy("doc_id", "__part").agg(F.array_sort(F.collect_list("page_idx")).alias("page_idxs"))

    def recognised(content: bytes, page_idx: int) -> tuple[str | None, str | None]:
        with tempfile.TemporaryDirectory() as folder:
            try:
                return with_retries(recogniser, renderer(content, page_idx, cfg.dpi, folder), cfg)
            except RuntimeError as e:
                return None, str(e)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        missing = any(shutil.which(t) is None for t in tools)
        for pdf in batches:
            out = []
            for doc_id, page_idxs, content in zip(pdf.doc_id, pdf.page_idxs, pdf.content, strict=True):
                out += [(doc_id, int(i), *(recognised(content, int(i)) if not missing else (None, None)), missing) for i in page_idxs]
            yield pd.DataFrame(out, columns=["doc_id", "page_idx", "text", "error", "skipped"])

    return files.select("doc_id", "content").join(asked.hint("shuffle_hash"), "doc_id").select("doc_id", "page_idxs", "content").mapInPandas(run, RESULT)


def summary(seen: DataFrame) -> DataFrame:
    """doc_id, ocr_summary: how many pages were tried, with what success, and the errors, as text; from the rows of :func:`recognise_pages`."""
    failed = F.array_sort(F.collect_list(F.when(F.col("text").isNull(), F.struct("page_idx", F.coalesce("error", F.lit("")).alias("error")))))
    rows = seen.groupBy("doc_id").agg(F.count("*").alias("n"), failed.alias("failed"))
    n_failed, numbers = F.size("failed"), F.array_join(F.transform("failed", lambda x: x["page_idx"].cast("string")), ", ")
    errors = F.filter("failed", lambda x: x["error"] != "")
    said = F.array_join(F.transform(errors, lambda x: F.concat(F.lit("- page_index="), x["page_idx"].cast("string"), F.lit(" error="), x["error"])), "\n")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("attempted: "), F.col("n").cast("string")),
        F.concat(F.lit("success: "), (F.col("n") - n_failed).cast("string")),
        F.concat(F.lit("failed: "), n_failed.cast("string")),
        F.when(n_failed > 0, F.concat(F.lit("failed_indices: ["), numbers, F.lit("]"))),
        F.when(F.size(errors) > 0, F.concat(F.lit("errors:\n"), said)),
    )
    return rows.select("doc_id", F.concat(text, F.lit("\n")).alias("ocr_summary"))
