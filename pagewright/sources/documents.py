"""Files to pages: enumeration, text extraction, form feeds."""

from __future__ import annotations

import re
import shutil
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import text as X
from pagewright.operators.slugs import base_name, with_unique_slugs
from pagewright.sources.shared import BROADCAST_BYTES, materialize, partitions_for

EXTRACTED = "doc_id string, page_idx int, text string, error string, started_ms bigint, finished_ms bigint"

GUIDANCE = "{path} matches no PDF file. Put files below it, in a folder for each kind of law, and name them by number and year."


class NoFilesFound(Exception):
    pass


def enumerate_files(spark: SparkSession, path: str, pattern: str = "*.pdf", modified_after: str | None = None) -> DataFrame:
    """path, slug, doc_id, content of the files below ``path`` at any depth; an error if there are none.

    Slugs are numbered over the paths alone, which are written once; contents are read beside them, by path, and never
    pass a sort. They stay where they are while the paths can be broadcast, and cross the network once beyond that.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(path)
    # A scan opens a task for every few files, so paths are scanned once, and written by fewer tasks than that.
    paths = materialize(spark, files.select("path").repartition(partitions_for(files), "path"), "paths")
    named = materialize(spark, with_unique_slugs(paths, base_name(F.col("path")), ["path"]), "files")
    n, n_bytes = named.agg(F.count("*"), F.sum(2 * F.octet_length("path") + 64)).first()
    if not n:
        raise NoFilesFound(GUIDANCE.format(path=path))
    side = F.broadcast(named) if n_bytes <= BROADCAST_BYTES else named.hint("shuffle_hash")
    return files.select("path", "content").join(side, "path").select("path", "slug", "doc_id", "content")


def decode(content: Column) -> Column:
    """Bytes as text; what is not UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def split_form_feeds(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, page_idx, text: cut at form feeds; blank pages at the end go, inner ones stay."""
    parts = F.split(F.col(text), "\f", -1)
    last = F.array_max(F.transform(parts, lambda x, i: F.when(X.trim(x) != "", i)))
    pages = F.slice(parts, F.lit(1), F.coalesce(last, F.lit(-1)) + 1)
    return documents.select("doc_id", F.posexplode(pages).alias("page_idx", "text"))


class ExtractionError(Exception):
    pass


#: Bytes of a document to its pages; raises ExtractionError with a reason.
Extractor = Callable[[bytes], list[str]]


def poppler(content: bytes, layout: bool = True, nopgbrk: bool = True, timeout: int = 600) -> list[str]:
    """Pages by the poppler tools: one by one if their number is known, else in one pass cut at form feeds."""

    def run(*args: str) -> subprocess.CompletedProcess:
        try:
            return subprocess.run(args, capture_output=True, timeout=timeout)
        except (OSError, subprocess.TimeoutExpired) as e:
            raise ExtractionError(f"PopplerError: {e}") from e

    def checked(done: subprocess.CompletedProcess, what: str) -> str:
        if done.returncode:
            said = done.stderr.decode("utf-8", "replace").lower()
            raise ExtractionError("EncryptedPDF" if "encrypt" in said or "password" in said else f"PopplerError: {what}")
        return done.stdout.decode("utf-8", "replace")

    with tempfile.NamedTemporaryFile(suffix=".pdf") as file:
        file.write(content)
        file.flush()
        flags = ["-layout"] * layout
        n_pages = None
        if shutil.which("pdfinfo"):
            done = run("pdfinfo", file.name)
            said = done.stderr.decode("utf-8", "replace").lower()
            if done.returncode and ("encrypt" in said or "password" in said):
                raise ExtractionError("EncryptedPDF")
            if not done.returncode and (m := re.search(r"^Pages:\s*(\d+)\s*$", done.stdout.decode("utf-8", "replace"), re.M)):
                n_pages = int(m[1])
        if n_pages is not None:
            one = [*flags, *["-nopgbrk"] * nopgbrk, "-q"]
            return [checked(run("pdftotext", *one, "-f", str(i), "-l", str(i), file.name, "-"), f"pdftotext failed on page {i}") for i in range(1, n_pages + 1)]
        pages = checked(run("pdftotext", *flags, "-q", file.name, "-"), "pdftotext failed").split("\f")
        while pages and not pages[-1].strip():
            pages.pop()
        return pages


def extract_pages(files: DataFrame, extractor: Extractor = poppler) -> DataFrame:
    """doc_id, page_idx, text, error and times from files (doc_id, content).

    A file that fails is one row with an error and no page; one without pages is a row with neither.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        now = lambda: int(time.time() * 1000)
        for pdf in batches:
            out = []
            for doc_id, content in zip(pdf.doc_id, pdf.content, strict=True):
                start = now()
                try:
                    pages = extractor(content)
                    out += [(doc_id, i, t, None, start, now()) for i, t in enumerate(pages)] or [(doc_id, None, None, None, start, now())]
                except ExtractionError as e:
                    out.append((doc_id, None, None, str(e), start, now()))
            frame = pd.DataFrame(out, columns=["doc_id", "page_idx", "text", "error", "started_ms", "finished_ms"])
            frame["page_idx"] = frame["page_idx"].astype("Int32")
            yield frame

    return files.select("doc_id", "content").mapInPandas(run, EXTRACTED)


def good_pages(extracted: DataFrame) -> DataFrame:
    """The pages of files that were read; a file without pages keeps one row, without page_idx."""
    return extracted.where(F.col("error").isNull()).select("doc_id", "page_idx", "text")


def timings(extracted: DataFrame) -> DataFrame:
    """doc_id, started_ms, finished_ms of each document."""
    return extracted.groupBy("doc_id").agg(F.min("started_ms").alias("started_ms"), F.max("finished_ms").alias("finished_ms"))
