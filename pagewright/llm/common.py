"""Helpers that the training-data operators share: tables, the shared folder, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.sources.shared import BROADCAST_BYTES, broadcast_if, materialize, shared_dir  # noqa: F401

#: Rows of an Arrow batch, unless the session asks for another number than Spark's own: texts are long.
BATCH_ROWS, SPARK_BATCH_ROWS = "2000", "10000"
#: Bytes of an Arrow batch, likewise; a little below a slice, so that most batches are one.
BATCH_BYTES, SPARK_BATCH_BYTES = "960k", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Give back what Arrow and the C library hold unused; workers idle between tasks, beside others at work."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_warm: dict = {}


def warm(kind: str, key, make):
    """What a worker keeps of one operator from task to task, made where it is not there.

    Workers outlive a stage, so another operator's is dropped first: a pipeline takes what its largest stage
    takes, not the sum of all.
    """
    if (kind, key) not in _warm:
        _warm.clear()
        release_memory()
        _warm[kind, key] = make()
    return _warm[kind, key]


def _tidy(run):
    def tidied(batches):
        import pyarrow as pa

        pa.set_memory_pool(pa.system_memory_pool())  # Arrow's own pools keep what they once had
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` in batches that suit texts; workers release memory behind each task."""
    conf = df.sparkSession.conf
    for name, own, of_spark in (("Records", BATCH_ROWS, SPARK_BATCH_ROWS), ("Bytes", BATCH_BYTES, SPARK_BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.max{name}PerBatch"
        if conf.get(key, of_spark) == of_spark:
            conf.set(key, own)
    return df.mapInArrow(_tidy(run), schema)


def local_table(spark: SparkSession, **columns) -> DataFrame:
    """Arrow arrays as a table. Spark makes tables of Python rows in workers of another kind, which stay beside the operators'."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table(columns))


def free_name(name: str, columns) -> str:
    """``name``, or what it takes behind it to differ from all ``columns`` (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col):
    """A-Z to a-z, and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batch, column: str, limit: int = 1 << 20):
    """Cut a record batch so that no slice holds more than ``limit`` bytes of a text column, but one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
