"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured size stays below this many bytes.
BROADCAST_BYTES = 8 << 20
#: Bytes of input that a partition should hold, where a plan says how many there are.
PARTITION_BYTES = 64 << 20

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where that is unset, a temporary folder serves a local master only; on a cluster the missing setting
    is an error.
    """
    global _local_dir
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="pagewright-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def new_path(spark: SparkSession, label: str) -> str:
    """A new folder below the application's own, which is deleted at the end of the program."""
    own = spark.sparkContext.applicationId
    if own not in _to_clean:
        _to_clean.add(own)
        atexit.register(_clean, spark)
    return f"{shared_dir(spark)}/{own}/{label}-{uuid.uuid4().hex}"


def _clean(spark: SparkSession) -> None:
    """At the end of the program: the application's folder, if the session still runs."""
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    except Exception:  # the session is gone; what is left belongs to whoever owns the folder
        pass


_to_clean: set[str] = set()


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files that any executor can read.

    The commit protocol keeps one attempt of each task, so values that depend on how rows were dealt
    (partition ids, positions) are fixed once written, whatever executors are lost later.
    """
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more, in whatever store it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it, if it lies in a file system that is mounted; None in other stores."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    scheme = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    return at.toUri().getPath() if scheme == "file" else None


def broadcast_if(df: DataFrame, n_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, to be broadcast if ``n_bytes``, which the caller measured, is within ``limit``, else sort-merged.

    The second hint keeps Spark from broadcasting on its own estimate, which ignores what explode adds.
    """
    return F.broadcast(df) if n_bytes <= limit else df.hint("merge")


def partitions_for(df: DataFrame, n_bytes: int = PARTITION_BYTES) -> int:
    """How many partitions ``df`` should be dealt to: as the session says, or more where the tables it reads are large.

    Tables of unknown size count as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < 1 << 60)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // n_bytes))
