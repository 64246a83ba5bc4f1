"""Sinks: one table for all documents, and an export of two files each."""

from __future__ import annotations

import json
import os
import urllib.parse
import uuid
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.sources.shared import local_path

#: Folders that the files of a table are dealt to by their names; enough to be listed by several tasks.
FOLDERS = 256


def meta_json(meta: DataFrame) -> DataFrame:
    """doc_id and the metadata as JSON with sorted keys and nulls kept."""
    return meta.select("doc_id", F.to_json(F.struct(*sorted(meta.columns)), {"ignoreNullFields": "false"}).alias("meta_json"))


def fingerprint(meta: DataFrame) -> DataFrame:
    """``meta`` with meta_fingerprint: SHA-256 of its sorted JSON without timestamps."""
    own = [c for c in sorted(meta.columns) if c not in ("timestamps", "meta_fingerprint")]
    return meta.withColumn("meta_fingerprint", F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256))


def read_meta(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Metadata from JSON texts, one row each."""
    return lines.select(F.from_json(F.col(column), schema).alias("__meta")).select("__meta.*")


def write_table(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    documents.write.mode(mode).parquet(path)


class WriteFailed(Exception):
    pass


def write_pair(folder: str, doc_id: str, markdown: str, meta: str) -> tuple[str, str]:
    """Markdown and metadata files; each appears whole or not at all."""
    paths = []
    try:
        os.makedirs(folder, exist_ok=True)
        for suffix, text in ((".md", markdown), (".meta.json", json.dumps(json.loads(meta), indent=2, ensure_ascii=False))):
            path = os.path.join(folder, f"{doc_id}{suffix}")
            with open(f"{path}.tmp.{os.getpid()}", "w", encoding="utf-8", newline="") as f:
                f.write(text)
            paths.append(path)
        for path in paths:
            os.replace(f"{path}.tmp.{os.getpid()}", path)
    except OSError as e:
        raise WriteFailed(str(e)) from e
    return paths[0], paths[1]


def export_files(documents: DataFrame, folder: str, per_doc_dir: bool = True) -> None:
    """Files of each document (doc_id, markdown, meta_json) below a folder that all executors share."""

    def run(rows) -> None:
        for r in rows:
            write_pair(os.path.join(folder, r.doc_id) if per_doc_dir else folder, r.doc_id, r.markdown, r.meta_json)

    documents.select("doc_id", "markdown", "meta_json").foreachPartition(run)


def write_files(rows: DataFrame, folder: str, end: str = "\x00") -> None:
    """A file for each row (name, text) below a new ``folder`` that all executors share: the text, closed by ``end``.

    In a file system that is mounted, tasks write ``folder/number/name=NAME.txt`` (NAME in URL encoding) themselves:
    each file appears whole, under a path that hangs on its name alone, so an attempt that is repeated writes the same
    files. Nothing is left for the driver to move. In other stores Spark writes ``folder/name=NAME/part-*.txt``. Either
    way :func:`file_name` reads the name back; a null one is Spark's ``__HIVE_DEFAULT_PARTITION__``.
    """
    root = local_path(rows.sparkSession, folder)
    if root is None:
        rows.write.partitionBy("name").option("lineSep", end).text(folder)
        return
    last = end.encode()

    def run(part) -> None:
        made = set()
        for r in part:
            name = f"name={urllib.parse.quote(r.name, safe=' ')}.txt"
            into = os.path.join(root, str(zlib.crc32(name.encode()) % FOLDERS))
            if into not in made:
                os.makedirs(into, exist_ok=True)
                made.add(into)
            before = os.path.join(into, f".{uuid.uuid4().hex}.tmp")
            with open(before, "wb") as f:
                f.write(r.text)
                f.write(last)
            os.replace(before, os.path.join(into, name))

    name = F.coalesce("name", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("name")
    rows.select(name, F.coalesce("text", F.lit("")).cast("binary").alias("text")).foreachPartition(run)


def file_name(path: Column) -> Column:
    """The name of a row from the path of its file, as :func:`write_files` laid it."""
    name = F.regexp_extract(path, r"name=([^/]*?)(?:/part-[^/]*|\.txt)$", 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
