"""Documents from a stream of files: each micro-batch runs the batch plan.

Every operator works within a document, so no state crosses batches, provided that a document's pages
arrive in one batch. ``documents_of_batch`` relies on that; ``buffered`` does not: it keeps the pages of
unfinished documents in state until their number is reached, or until nothing came for a while.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUFFERED = "doc_id string, page_idx int, text string, complete boolean"


def documents_of_batch(source: DataFrame, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, timeout_s: int | None = None) -> None:
    """Run ``plan`` over what has arrived, batch by batch, and write each result as Parquet below ``out``.

    A batch that is run again replaces its own folder, so the output holds each batch once.
    """

    def each(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination():
        query.stop()
        raise TimeoutError(f"the stream took more than {timeout_s} s")


def read_pages(spark: SparkSession, path: str, schema: str | StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def buffered(pages: DataFrame, wait_s: int | None = 3600) -> DataFrame:
    """From a stream of doc_id, page_idx, n_pages, text: the pages of documents whose pages have all come, with complete.

    Repeated pages count once; the last text of a page wins, and the largest n_pages. A document of which nothing came
    for ``wait_s`` seconds is handed on as it is, with complete false, and its state goes; pages that come later start anew.
    While documents wait, Spark runs batches without data, so a stream that ends by itself (``availableNow``) would not: it
    takes None, and unfinished documents stay in its state for the next run.
    """

    def update(key: tuple, frames: Iterator, state) -> Iterator:
        import pandas as pd

        at, texts, total = state.get if state.exists else ([], [], 0)
        held = dict(zip(at, texts, strict=True))
        for frame in () if state.hasTimedOut else frames:  # a timeout comes with a frame of nulls
            total = max(total, int(frame.n_pages.max()))
            held.update(zip(frame.page_idx.astype(int), frame.text, strict=True))
        complete = len(held) >= total
        if complete or state.hasTimedOut:
            if state.exists:
                state.remove()
            ordered = sorted(held)
            yield pd.DataFrame({"doc_id": [key[0]] * len(ordered), "page_idx": ordered, "text": [held[i] for i in ordered], "complete": complete})
        else:
            state.update((list(held), list(held.values()), total))
            if wait_s is not None:
                state.setTimeoutDuration(wait_s * 1000)

    kind = "NoTimeout" if wait_s is None else "ProcessingTimeTimeout"
    return pages.groupBy("doc_id").applyInPandasWithState(update, BUFFERED, "at array<int>, text array<string>, n_pages int", "append", kind)


def merged_batches(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")


def with_document_sizes(pages: DataFrame) -> DataFrame:
    """Pages with n_pages, the number of pages of their document."""
    return pages.join(pages.groupBy("doc_id").agg(F.count("*").alias("n_pages")), "doc_id")
