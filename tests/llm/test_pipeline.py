import corpus_pipeline as pipeline
from test_native_ops import counts
from test_packing import check, whole_ids
from test_simhash import brute_components, brute_fp


def test_stages_on_a_small_corpus(spark, tmp_path):
    """Each stage's rows against brute force over all that its predecessor kept."""
    from pagewright.llm import decontam

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(None, "123 456", "en", "s", 7), (10**6, docs.first().text, "en", "s", 1), (10**6, docs.first().text, "en", "s", 1)], docs.schema)
    docs = docs.unionByName(extra)
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, sf)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == columns
            kept[name] = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    start = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").unionByName(extra).select("doc_id", "text").collect()]
    assert set(start) - set(kept["language_id"]) <= {(d, t) for d, t in start if not t or len(t.split()) < 3}
    good = [(d, t) for d, t in kept["language_id"] if not ((c := counts(t))[0] < 20 or 100 * c[4] > 30 * c[0])]
    assert sorted(kept["quality_rules"], key=str) == sorted(good, key=str)
    order = sorted(good, key=lambda x: (x[0] is None, x[0]))
    groups = brute_components([brute_fp(t) for _, t in order], 4)
    assert sorted(kept["near_dedup"]) == sorted(order[g] for g in set(groups))
    index = decontam.Index([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()], 0.6, 0.3)
    import pyarrow as pa

    clean = [x for x in kept["near_dedup"] if not decontam.Matcher(index).leaks(pa.array([x[1]]))]
    assert sorted(kept["decontamination"]) == sorted(clean)
    pieces = docs.collect()
    check(pieces, clean)
    assert sum(p.length for p in pieces) == sum(len(whole_ids(t)) for _, t in clean)


def test_names_that_operators_add_survive(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    from pyspark.sql import functions as F

    own = ("score", "lang_pred", "held_out", "kept", "n_words", "item_ids", "row", "rid", "fp", "component_id")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in own})
    for _, stage in pipeline.STAGES[:-1]:
        rows = stage(spark, docs, sf)
        assert rows.columns == docs.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows.collect() for c in own)


def test_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.collect() == []
