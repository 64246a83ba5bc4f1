import json
import os

from pagewright import cli
from pagewright.sources import config, documents

JOB = {"id": "x", "outputs": {"dir": ""}, "tools": [{"name": "check_deps"}, {"name": "enumerate_pdfs"}]}


def job(tmp_path, **more):
    return config.load_job(JOB | {"datasources": [{"path": f"{tmp_path}/in/**/*.pdf"}], "outputs": {"dir": str(tmp_path / "out")}} | more)


def extractor():
    """A function of its own, which workers get by value."""

    def extract(content):
        if content == b"locked":
            raise documents.ExtractionError("EncryptedPDF")
        return content.decode().split("\f")

    return extract


def test_job_end_to_end(spark, tmp_path):
    os.makedirs(tmp_path / "in/uu")
    (tmp_path / "in/uu/A 1.pdf").write_bytes(b"BAB I\nPasal 1\nIsi pasal yang cukup panjang supaya halaman ini tidak dicurigai sama sekali ya.\f-")
    (tmp_path / "in/b.pdf").write_bytes(b"locked")
    flags = config.parse_flags(["--artifacts=on", "--law-mode", "pp", "--with-ocr=on"])
    code = cli.run_job(spark, job(tmp_path), flags, extractor(), lambda *a: "Pasal 2", lambda *a: "image", ocr_tools=())
    assert code == config.EXIT_CODES["extraction"]
    assert os.listdir(tmp_path / "out") == ["a-1"]
    meta = json.loads((tmp_path / "out/a-1/a-1.meta.json").read_text())
    assert meta["suspect_pages"] == meta["ocr"]["ocr_run_pages"] == [1] and meta["ocr"]["ran"] and meta["page_count"] == 2
    assert meta["found"]["pasal"] == 2 and meta["metrics"]["coverage_pages"] == 1.0
    assert (tmp_path / "out/a-1/a-1.md").read_text() == (tmp_path / "out/a-1/artifacts/step3_md.txt").read_text()
    assert (tmp_path / "out/a-1/artifacts/step1_extract.txt").read_text().endswith("\n-")
    assert (tmp_path / "out/a-1/artifacts/ocr/ocr_summary.txt").read_text() == "attempted: 1\nsuccess: 1\nfailed: 0\n"
    assert (tmp_path / "out/a-1/artifacts/suppressor_preview.txt").exists()


def test_every_failure_leaves_a_trace(spark, tmp_path, monkeypatch, capfd):
    os.makedirs(tmp_path / "in")
    for n in range(5):
        (tmp_path / f"in/f{n}.pdf").write_bytes(b"locked")
    (tmp_path / "in/good.pdf").write_bytes(b"Pasal 1\nIsi pasal.")
    monkeypatch.setattr(cli, "LOGGED_FAILURES", 2, raising=False)
    assert cli.run_job(spark, job(tmp_path), config.parse_flags([]), extractor(), ocr_tools=("none",)) == config.EXIT_CODES["extraction"]
    said = [json.loads(x) for x in capfd.readouterr().err.splitlines() if x.startswith("{")]
    assert [x["failed"] for x in said if "failed" in x] == [5] and sum(x.get("error") == "EncryptedPDF" for x in said) == 2
    rows = spark.read.parquet(str(tmp_path / "out-failures")).collect()
    assert sorted((r.doc_id, r.error) for r in rows) == [(f"f{n}", "EncryptedPDF") for n in range(5)]


def test_codes(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    assert cli.run_job(spark, job(tmp_path), config.parse_flags([]), extractor(), ocr_tools=("none",)) == config.EXIT_CODES["no_files"]
    (tmp_path / "in/c.pdf").write_bytes(b"tanpa struktur")
    strict = config.parse_flags(["--strict", "--law-mode", "pp"])
    assert cli.run_job(spark, job(tmp_path), strict, extractor(), ocr_tools=("none",)) == config.EXIT_CODES["structure"]
    (tmp_path / "out").write_text("a file in the way")
    assert cli.run_job(spark, job(tmp_path), config.parse_flags([]), extractor(), ocr_tools=("none",)) == config.EXIT_CODES["write"]
    assert cli.main([str(tmp_path / "no.yaml")]) == config.EXIT_CODES["config"]


def test_globs():
    assert cli.split_glob("./input/**/*.pdf") == ("./input/", "*.pdf")
    assert cli.split_glob("/a/b.pdf") == ("/a", "b.pdf")
