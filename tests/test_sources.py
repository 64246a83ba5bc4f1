import json
import os

import pytest
from pyspark.sql import functions as F

from pagewright.operators import ocr, report
from pagewright.operators.slugs import slugify, with_unique_slugs
from pagewright.plans.pipeline import document_meta, structured
from pagewright.plans.queries import CATALOGUE
from pagewright.schema import OcrConfig, PipelineConfig
from pagewright.sources import config, documents, emit
from pagewright.streaming import documents as streaming

JOB = {"id": "x", "datasources": [{"path": "./in/**/*.pdf"}, {"path": "other"}], "outputs": {"dir": "./out"}, "tools": [{"name": "check_deps"}, {"name": "enumerate_pdfs"}], "more": 1}


def tool(folder, name, body):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("#!/bin/sh\n" + body)
    os.chmod(path, 0o755)


def test_enumerate(spark, tmp_path):
    os.makedirs(tmp_path / "uu/deep")
    for name in ("uu/A-2020.pdf", "uu/deep/A-2020.pdf", "uu/skip.txt"):
        (tmp_path / name).write_bytes(b"%PDF-1.4")
    got = documents.enumerate_files(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r.path.split("/uu/")[1], r.slug, r.doc_id) for r in got] == [("A-2020.pdf", "a-2020", "a-2020"), ("deep/A-2020.pdf", "a-2020", "a-2020-1")]
    os.makedirs(tmp_path / "none")
    with pytest.raises(documents.NoFilesFound):
        documents.enumerate_files(spark, str(tmp_path / "none"))


def test_slugs(spark):
    names = [("PP No. 36/2021 – É",), ("",), ("--",), ("Ä b_C",)]
    assert [r[0] for r in spark.createDataFrame(names, "n string").select(slugify(F.col("n"))).collect()] == ["pp-no-36-2021", "doc", "doc", "b-c"]
    rows = [(1, "a"), (2, "a"), (3, "a-1"), (4, "b"), (5, "b"), (6, "a-1"), (7, "a-1-1")]
    got = {r.k: r.doc_id for r in with_unique_slugs(spark.createDataFrame(rows, "k int, n string"), F.col("n"), ["k"]).collect()}
    used, want = set(), {}
    for k, s in rows:
        n, new = 0, s
        while new in used:
            n, new = n + 1, f"{s}-{n + 1}"
        used.add(new)
        want[k] = new
    assert got == want


def test_clashing_slugs_equal_the_loop_without_a_cap(spark, monkeypatch):
    import random

    from pyspark.sql import DataFrame

    def loop(rows):
        used, last, want = set(), {}, {}
        for k, s in sorted(rows):
            n = last.get(s, 0)  # those below are in use
            while (new := f"{s}-{n}" if n else s) in used:
                n += 1
            used.add(new)
            last[s], want[k] = n, new
        return want

    rng = random.Random(7)
    names = ["a", "a", "a", "b", "b-01", "b-99999999999999999999", *(f"a-{i}" for i in (1, 1, 2, 3, 5, 8)), "a-1-1", "a-1-2", "a-1-1-1", "a-1-1-2", "a-2-1", "a-2-1-1", "b-1-1", "b-1", "1", "1-1"]
    tables = [[(k, f"g{g}x-{rng.choice(names)}") for k in rng.sample(range(10_000), rng.randint(2, 60))] for g in range(40)]
    rows = [(g * 10_000 + k, s) for g, table in enumerate(tables) for k, s in table]
    # One hot name with more rows than the driver once took, and a few numbered ones among them.
    hot = [(1_000_000 + 2 * i, "doc") for i in range(100_100)] + [(1_050_001, "doc-1"), (999_999, "doc-3"), (1_100_001, "doc-90000"), (1_190_001, "doc-90001"), (1_120_001, "doc-200000")]
    frame = spark.createDataFrame(rows + hot, "k int, n string").repartition(5)
    want = loop(rows + hot)
    for window_rows in (1_000_000, 1000):
        with monkeypatch.context() as m:
            m.setattr(DataFrame, "collect", lambda df: pytest.fail("rows are gathered"))
            unique = with_unique_slugs(frame, F.col("n"), ["k"], window_rows)
        got = {r.k: r.doc_id for r in unique.collect()}
        assert got == want and len(set(got.values())) == len(rows) + len(hot)



def test_form_feeds_and_bytes(spark):
    rows = spark.createDataFrame([("a", "x\f\fy\f \f"), ("b", " \f"), ("c", "z")], "doc_id string, text string")
    assert [tuple(r) for r in documents.split_form_feeds(rows).orderBy("doc_id", "page_idx").collect()] == [("a", 0, "x"), ("a", 1, ""), ("a", 2, "y"), ("c", 0, "z")]
    assert spark.createDataFrame([(b"a\xffb",)], "c binary").select(documents.decode(F.col("c"))).first()[0] == "a�b"


def test_poppler_with_fake_tools(tmp_path, monkeypatch):
    monkeypatch.setenv("PATH", f"{tmp_path}:/usr/bin:/bin")
    tool(tmp_path, "pdftotext", 'printf "one\\fTWO\\f\\f"')
    assert documents.poppler(b"x") == ["one", "TWO"]
    tool(tmp_path, "pdfinfo", 'echo "Title: t"; echo "Pages:  2"')
    tool(tmp_path, "pdftotext", 'while [ "$1" != -f ]; do shift; done; echo "page $2"')
    assert documents.poppler(b"x") == ["page 1\n", "page 2\n"]
    tool(tmp_path, "pdfinfo", 'echo "Incorrect password" >&2; exit 1')
    with pytest.raises(documents.ExtractionError, match="EncryptedPDF"):
        documents.poppler(b"x")


def test_extraction_keeps_going(spark):
    def extract(content):
        if content == b"bad":
            raise documents.ExtractionError("EncryptedPDF")
        return ["p", "q"]

    files = spark.createDataFrame([("a", b"ok"), ("b", b"bad")], "doc_id string, content binary")
    rows = documents.extract_pages(files, extract)
    assert {(r.doc_id, r.page_idx, r.text, r.error) for r in rows.collect()} == {("a", 0, "p", None), ("a", 1, "q", None), ("b", None, None, "EncryptedPDF")}
    assert documents.good_pages(rows).count() == 2


def test_a_file_without_pages_has_output(spark):
    files = spark.createDataFrame([("none", b""), ("blank", b" "), ("one", b"Pasal 1")], "doc_id string, content binary")
    rows = documents.extract_pages(files, lambda content: [content.decode()] if content else [])
    pages = documents.good_pages(rows)
    for cfg in (PipelineConfig(), PipelineConfig(suppressor=None)):
        meta = {r.doc_id: r for r in document_meta(pages, cfg, documents.timings(rows)).collect()}
        r = meta["none"]
        assert set(meta) == {"none", "blank", "one"} and (r.page_count, r.suspect_pages, r.timing_ms_per_page, r.p95_latency_ms_per_page) == (0, [], [], 0)
        assert tuple(r.metrics) == (0.0, 0.0, 0.0, 0) and tuple(r.found) == (0, False, False, 0, False) and r.stats.removed_lines_sample == []
        assert (meta["blank"].page_count, meta["blank"].suspect_pages) == (1, [0])
        assert {d.doc_id: d.markdown for d in structured(pages, cfg).collect()}["none"] == ""


def test_job(tmp_path):
    assert config.load_job(JOB).input_glob == "./in/**/*.pdf"
    path = tmp_path / "job.json"
    path.write_text(json.dumps(JOB))
    assert config.load_job(str(path)) == config.load_job(JOB)
    for kind, broken in (("invalid", JOB | {"id": " "}), ("invalid", JOB | {"tools": [{"name": "check_deps"}]}), ("invalid", JOB | {"outputs": {}}), ("invalid", JOB | {"datasources": [{"name": "n"}, {"path": "p"}]}), ("parse", {"id": None})):
        with pytest.raises(config.ConfigError) as e:
            config.load_job(broken)
        assert e.value.kind == kind
    with pytest.raises(config.ConfigError) as e:
        config.load_job(str(tmp_path / "none"))
    assert e.value.kind == "read"


def test_tools_and_flags():
    assert config.check_tools(lambda t: t) == (True, [])
    assert config.check_tools({"pdftotext": 1}.get) == (False, ["pdftoppm", "tesseract"])
    assert config.install_hint(["pdftoppm"]) == "" and "poppler-utils" in config.install_hint(["pdftotext"])
    f = config.parse_flags("--strict --with-ocr=off --law-mode PP --ocr-dpi 10 --artifacts=on --keep-lines ^x".split())
    assert (f.config.strict, f.config.ocr.requested, f.config.law_mode, f.config.ocr.dpi, f.artifacts, f.per_doc_dir, f.config.suppressor.keep_lines) == (True, False, "pp", 72, True, True, "^x")
    f = config.parse_flags("--with-ocr --ocr-lang --strict --keep-lines [".split())
    assert (f.config.ocr.requested, f.config.ocr.lang, f.config.suppressor.keep_lines) == (True, "ind+eng", None)


def test_recognition(spark):
    calls = []

    def shaky(image, lang, psm, oem):
        calls.append((lang, psm))
        if len(calls) < 3:
            raise RuntimeError("tesseract_exit_1")
        return "text"

    assert ocr.with_retries(shaky, "i", OcrConfig(lang="ind", psm=4)) == ("text", None)
    assert calls == [("ind", 4), ("ind+eng", 4), ("ind+eng", 6)]
    assert ocr.with_retries(lambda *a: " ", "i", OcrConfig()) == (None, "empty_text;empty_text;empty_text")

    def draw(content, page_idx, dpi, folder):
        if page_idx == 1:
            raise RuntimeError("image_missing")
        return "image"

    suspects = spark.createDataFrame([("a", 0), ("a", 1)], "doc_id string, page_idx int")
    files = spark.createDataFrame([("a", b"x")], "doc_id string, content binary")
    rows = ocr.recognise_pages(suspects, files, OcrConfig(), lambda *a: "seen", draw, tools=()).collect()
    assert {(r.page_idx, r.text, r.error, r.skipped) for r in rows} == {(0, "seen", None, False), (1, None, "image_missing", False)}
    done = ocr.recognise_pages(suspects, files, OcrConfig(), lambda *a: "seen", draw, tools=())
    assert ocr.summary(done).first().ocr_summary == "attempted: 2\nsuccess: 1\nfailed: 1\nfailed_indices: [1]\nerrors:\n- page_index=1 error=image_missing\n"
    many = spark.createDataFrame([("a", i) for i in range(100) if i != 1], "doc_id string, page_idx int")
    assert sorted(r.page_idx for r in ocr.recognise_pages(many, files, OcrConfig(), lambda *a: "seen", draw, tools=()).collect()) == [i for i in range(100) if i != 1]
    rows = ocr.recognise_pages(suspects, files, OcrConfig(), lambda *a: "seen", draw, tools=("no-such-tool",)).collect()
    assert {(r.text, r.skipped) for r in rows} == {(None, True)}


def test_meta_and_export(spark, tmp_path):
    pages = spark.createDataFrame([("a", 0, "BAB I\nPasal 1"), ("b", 0, "x")], "doc_id string, page_idx int, text string")
    meta = document_meta(pages, PipelineConfig())
    rows = {r.doc_id: json.loads(r.meta_json) for r in emit.meta_json(meta).collect()}
    assert list(rows["a"]) == sorted(rows["a"]) and rows["a"]["ocr"]["skipped_reason"] == "tesseract_missing" and rows["a"]["found"]["bab"] == 1
    stamped = document_meta(pages, timings=spark.createDataFrame([("a", 1000, 1250)], "doc_id string, started_ms long, finished_ms long")).where("doc_id = 'a'").first()
    assert stamped.p95_latency_ms_per_page == 250 and stamped.timing_ms_per_page == [250] and stamped.meta_fingerprint != rows["a"]["meta_fingerprint"]
    docs = emit.meta_json(meta).withColumn("markdown", F.lit("# x\n"))
    emit.export_files(docs, str(tmp_path))
    assert (tmp_path / "a/a.md").read_text() == "# x\n" and json.loads((tmp_path / "b/b.meta.json").read_text())["doc_id"] == "b"
    assert sorted(os.listdir(tmp_path / "a")) == ["a.md", "a.meta.json"]
    with pytest.raises(emit.WriteFailed):
        emit.write_pair(str(tmp_path / "a/a.md"), "x", "", "{}")
    accepted = {r.doc_id: (r.status, r.reasons) for r in report.acceptance(meta).collect()}
    assert accepted["a"] == ("FAIL", "OCRNoRunPages,CoveragePagesLow")


def test_ground_truth(spark):
    lines = spark.createDataFrame([(x,) for x in ("# c", "", "pp352021: { bab: 11, pasal: 15 }", "  k-1: { bab: 4 }", "no numbers")], "value string")
    assert [tuple(r) for r in report.parse_ground_truth(lines).collect()] == [("pp352021", 11, 15), ("k-1", 4, 0)]
    counts = spark.createDataFrame([("a", 1, 100), ("b", 1, 97), ("c", 0, 0)], "doc_id string, bab long, pasal long")
    truth = spark.createDataFrame([("a", 1, 100), ("b", 1, 100), ("z", 0, 0)], "doc_id string, bab long, pasal long")
    rows = {r.doc_id: (r.exact, r.reaches_goal) for r in report.compare_with_truth(counts, truth).collect()}
    assert rows == {"a": (True, True), "b": (False, False)}
    assert [r.doc_id for r in report.not_compared(counts, truth).collect()] == ["z"]
    runs = lambda d: spark.createDataFrame(list(d.items()), "doc_id string, meta_fingerprint string")
    assert {r.doc_id: r.equal for r in report.repeatability(runs({"a": "1", "b": "2", "c": "3"}), runs({"a": "1", "b": "x"})).collect()} == {"a": True, "b": False, "c": False}


def test_streams(spark, tmp_path):
    pages = spark.createDataFrame([("a", 0, 2, "p"), ("b", 0, 1, "q")], "doc_id string, page_idx int, n_pages int, text string")
    pages.coalesce(1).write.parquet(str(tmp_path / "in"))
    schema = pages.schema
    streaming.documents_of_batch(streaming.read_pages(spark, str(tmp_path / "in"), schema), lambda b: b.groupBy("doc_id").count(), str(tmp_path / "out"), str(tmp_path / "c1"), 100)
    assert {tuple(r) for r in streaming.merged_batches(spark, str(tmp_path / "out")).collect()} == {("a", 1), ("b", 1)}
    spark.createDataFrame([("a", 1, 2, "r")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    whole = streaming.buffered(streaming.read_pages(spark, str(tmp_path / "in"), schema, files_per_trigger=1), None)
    q = whole.writeStream.format("memory").queryName("whole_documents").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    assert q.awaitTermination(100)
    assert {tuple(r) for r in spark.sql("SELECT * FROM whole_documents").collect()} == {("a", 0, "p", True), ("a", 1, "r", True), ("b", 0, "q", True)}


def test_a_document_that_stays_incomplete_is_handed_on(spark, tmp_path):
    import time

    pages = spark.createDataFrame([("a", 0, 2, "p"), ("b", 0, 1, "q")], "doc_id string, page_idx int, n_pages int, text string")
    pages.coalesce(1).write.parquet(str(tmp_path / "in"))
    found = streaming.buffered(streaming.read_pages(spark, str(tmp_path / "in"), pages.schema), wait_s=1)
    q = found.writeStream.format("memory").queryName("late_documents").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        until = time.time() + 60
        while time.time() < until and spark.sql("SELECT * FROM late_documents").count() < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    assert {tuple(r) for r in spark.sql("SELECT * FROM late_documents").collect()} == {("a", 0, "p", False), ("b", 0, "q", True)}


def test_files_of_a_table_lie_in_few_folders_and_keep_names_and_bytes(spark, tmp_path):
    # With a folder for each file, driver and scheduler worked for each document: 300,000 files took over 20 minutes.
    rows = {f"File No. {i}": f"text {i}\f" for i in range(600)} | {"a/b": "x\x00", "._c": "", "d +%41=é": "\n", "e.txt": "ü"}
    df = spark.createDataFrame(list(rows.items()), "name string, text string").repartition(5)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./here", f"file://{tmp_path}")
    for folder in (f"{tmp_path}/mounted", "viewfs://store/here/other"):
        emit.write_files(df, folder)
        files = documents.enumerate_files(spark, folder, "*.txt")
        got = [(r.name, r.content.decode()) for r in files.select(emit.file_name(F.col("path")).alias("name"), "content").collect()]
        assert sorted(got) == sorted((k, f"{v}\x00") for k, v in rows.items())
    folders = [d for d, _, names in os.walk(tmp_path / "mounted") if names]
    assert 1 < len(folders) <= emit.FOLDERS and not [n for d in folders for n in os.listdir(d) if not n.endswith(".txt")]


def test_extracted_files_at_more_documents_than_folders(spark, tmp_path, monkeypatch):
    rows = [(i, t, "user", " " if i == 5 else f"page {i} {t}") for i in range(300) for t in range(2)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    wanted = {(f"file-no-{i}", None, None) for i in range(300) if i % 9 == 0 or i == 5} | {(f"file-no-{i}", t, x) for i, t, _, x in rows if i % 9 and i != 5}
    monkeypatch.setattr("pagewright.plans.queries.new_path", lambda spark, label: f"{tmp_path}/{label}")
    got = CATALOGUE["extracted_files"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.page_idx, r.text) for r in got} == wanted and len(got) == len(wanted) and not any(r.error for r in got)
    folders = {os.path.dirname(p) for p in map(str, (tmp_path / "files").rglob("*.txt"))}
    assert len(folders) <= emit.FOLDERS


def test_idempotency_structures_the_pages_of_a_run_once(spark, tmp_path, monkeypatch):
    rows = [(i, t, "user", f"page {i} of ti-\ntle\nBAB I\n- {t} -") for i in range(20) for t in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    plans = []

    def write(df, path, mode="overwrite"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        emit.write_table(df, path, mode)

    monkeypatch.setattr("pagewright.plans.queries.write_table", write)
    got = CATALOGUE["idempotency"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {str(i) for i in range(20)} and len(got) == 20 and all(r.equal for r in got)
    # What is written joins finished documents; before, its plan made lines of the pages twice.
    assert len(plans) == 2 and not any("posexplode" in p or "Window" in p for p in plans)
