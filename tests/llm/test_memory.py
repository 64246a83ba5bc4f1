"""What an executor holds beside its heap: Arrow batches, Python workers, and the processes that written files cost."""

import os
from glob import glob

from pyspark.sql import functions as F

from pagewright.llm import packing
from pagewright.llm.common import map_batches, shared_dir
from pagewright.llm.components import connected_components
from pagewright.llm.queries import tokenizer_path


def test_long_texts_come_in_small_batches(spark):
    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    texts = spark.range(0, 1000, 1, 2).select(F.expr("repeat('ab', 5000 + cast(id as int))").alias("text"))
    found = map_batches(texts, sizes, "n long, size long").collect()
    assert sum(r.n for r in found) == 1000
    assert max(r.size for r in found) <= 1 << 20
    one = map_batches(spark.range(1).select(F.expr("repeat('ab', 1500000)").alias("text")), sizes, "n long, size long").collect()
    assert [r.n for r in one] == [1] and one[0].size > 3_000_000


def test_packing_starts_no_workers_of_another_kind(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    pieces = packing.pack(spark, docs, tokenizer_path())
    assert "ExistingRDD" not in pieces._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in pieces.collect()) == list(range(40))


def test_rounds_of_few_links_write_few_files(spark):
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        links = spark.range(3000).where("id % 100 <> 99").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        roots = connected_components(spark, links, "few-files").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.root for r in roots} == {i: i - i % 100 for i in range(3000) if i % 100}
    tables = glob(f"{shared_dir(spark).removeprefix('file://')}/{spark.sparkContext.applicationId}/few-files-*")
    files = sorted(len(glob(os.path.join(t, "part-*"))) for t in tables)
    assert len(files) > 4 and files[-1] <= 64 and files[-2] <= 2 * spark.sparkContext.defaultParallelism
