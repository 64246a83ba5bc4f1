import random

import pytest
from model import cleanup, metrics, promote, suppress

from pagewright.operators import cleanup as C
from pagewright.operators import merge, quality, structure
from pagewright.operators import suppress as S
from pagewright.plans.pipeline import Pipeline, StructureNotFound, structured
from pagewright.schema import PipelineConfig, SuppressorConfig

PAGES = "doc_id string, page_idx int, text string"
DOCS = "doc_id string, text string"

# Golden cases: name, input, cleaned text.
CLEANED = {
    "join": ("PRESIDEN REPUBLIK INDONESIA\nAlinea berakhir\npada baris\n- 2 -\nBerikutnya.", "Alinea berakhir pada baris Berikutnya."),
    "lists": ("Huruf:\na. satu\nb.\ndua\n(1)\n(2)\nisi.\n12\n1234\n3. tiga", "Huruf:\n- (a )satu b.\ndua (1)\n(2) isi.\n1234 3. tiga"),
    "blank": ("para satu\n\npara dua.\n\npara tiga", "para satu \npara dua.\n\npara tiga"),
    "marks": ("a.\n1.\nx.", "- (a )1.\nx."),
    "mark before blank": ("1.\n\nx", "1.\n\nx"),
    "hyphens": ("pera-\nturan a-\nb-\nc", "peraturan ab-\nc"),
}
PROMOTED = {
    "indented": ("    Pasal 1\nIsi ayat.", "    Pasal 1 Isi ayat.", 0, 0),
    "heading behind text": ("akhir kata\nPasal 2\nIsi.", "akhir kata Pasal 2\nIsi.", 0, 0),
    "roman title": ("BAB I KETENTUAN UMUM\nPasal 1\nI. UMUM\na. Hal\n1. Angka", "## BAB I KETENTUAN UMUM\n## Pasal 1\n### I. UMUM a. Hal 1. Angka", 1, 1),
    "two letters": ("BAB II\nPasal 3\nIsi.", "## BAB II Pasal 3\nIsi.", 1, 0),
    "one letter": ("BAB I\nPasal 3\nIsi.", "## BAB I\n## Pasal 3\nIsi.", 1, 1),
    "preamble": ("Menimbang :\na. bahwa x;\nMengingat : Pasal 5", "## Menimbang\n- (a )bahwa x;\nMengingat : Pasal 5", 0, 0),
}


def test_cleanup_golden(spark):
    docs = spark.createDataFrame([(k, v[0]) for k, v in CLEANED.items()], DOCS)
    lines, stats = C.cleanup_lines(docs)
    assert {r.doc_id: r.text for r in C.to_documents(docs, lines).collect()} == {k: v[1] for k, v in CLEANED.items()}
    counts = {r.doc_id: (r.removed_header, r.removed_footer, r.hyphens_fixed) for r in stats.collect()}
    assert counts["join"] == (1, 1, 0) and counts["lists"] == (0, 1, 0) and counts["hyphens"] == (0, 0, 2)


def test_promotion_golden(spark):
    docs = spark.createDataFrame([(k, v[0]) for k, v in PROMOTED.items()], DOCS)
    promoted = structure.promote_headings(C.reread(C.cleanup_lines(docs)[0]))
    assert {r.doc_id: r.text for r in C.to_documents(docs, promoted).collect()} == {k: v[1] for k, v in PROMOTED.items()}
    assert {r.doc_id: (r.bab, r.pasal) for r in structure.structure_counts(docs, promoted).collect()} == {k: v[2:] for k, v in PROMOTED.items()}


def test_all_headings(spark):
    docs = spark.createDataFrame([("x", "BAB I KETENTUAN UMUM\nPasal 1\nMenimbang:\nMengingat:\nPENJELASAN\nI. UMUM")], DOCS)
    rows = structure.promote_headings(C.numbered_lines(docs))
    assert [r.line for r in rows.orderBy("line_no").collect()] == ["## BAB I KETENTUAN UMUM", "## Pasal 1", "## Menimbang", "## Mengingat", "## PENJELASAN", "### I. UMUM"]
    assert structure.structure_counts(docs, rows).first()[1:] == (1, 1, True, True, True)


def frame(spark, docs):
    return spark.createDataFrame([(d, i, t) for d, pages in docs.items() for i, t in enumerate(pages)], PAGES)


def test_suppressor_golden(spark):
    docs = {
        "repeats": ["JUDUL X\nisi satu.\nkaki 9", "JUDUL X\nisi dua.\nkaki 9", "JUDUL X\nisi tiga.\nlain"],
        "one page": ["hanya satu halaman\ntengah.\nakhir baris"],
        "headings": ["BAB II\nx.", "BAB II\ny.", "BAB I\nz."],
        "overrun": ["\n".join(f"- {i} -" for i in range(1, 8)) + "\nisi.", "x."],
    }
    pages = frame(spark, docs)
    rows = S.classified_lines(pages)
    out = {}
    for r in S.suppressed_pages(pages, rows).orderBy("doc_id", "page_idx").collect():
        out.setdefault(r.doc_id, []).append(r.text)
    assert out["repeats"] == ["isi satu.", "isi dua.", "isi tiga.\nlain"] and out["one page"] == ["tengah."]
    assert out["headings"] == ["x.", "y.", "BAB I\nz."] and out["overrun"][0] == "- 6 -\n- 7 -\nisi."
    stats = {r.doc_id: r for r in S.suppressor_stats(pages, rows).collect()}
    assert stats["repeats"].removed_lines_sample == ["JUDUL X", "kaki 9", "JUDUL X", "kaki 9", "JUDUL X"]
    assert (stats["overrun"].removed_footer, stats["overrun"].suppressor_overrun) == (7, 2)
    rescued = frame(spark, {"k": ["- 1 -\nisi", "- 2 -\nisi"]})
    rows = S.classified_lines(rescued, SuppressorConfig(keep_lines="^- 2"))
    assert [r.text for r in S.suppressed_pages(rescued, rows).orderBy("page_idx").collect()] == ["", "- 2 -"]
    assert S.suppressor_stats(rescued, rows).first().removed_footer == 2


def test_metrics_golden(spark):
    text = "LEMBARAN NEGARA REPUBLIK INDONESIA X\n- 1 -\nisi"
    raw, md = spark.createDataFrame([("same", text), ("empty", "")], DOCS), spark.createDataFrame([("same", text), ("empty", "x")], DOCS)
    got = {r.doc_id: (r.character_coverage, r.leak_rate) for r in quality.metrics(raw, md).collect()}
    assert got == {"same": (1.0, 0.5), "empty": (0.0, 0.0)}


def test_full_golden(spark):
    text = "PRESIDEN REPUBLIK INDONESIA\nBAB I KETENTUAN UMUM\nPasal 1\nHuruf a. contoh\n- 1 -"
    for cfg, share in ((PipelineConfig(), 1.0), (PipelineConfig(suppressor=None), 0.625)):
        r = structured(frame(spark, {"g": [text]}), cfg).first()
        assert r.markdown == "## BAB I KETENTUAN UMUM\n## Pasal 1\nHuruf a. contoh"
        assert (r.removed_header, r.removed_footer, r.character_coverage) == (1, 1, share)


def test_suspects_and_merge(spark):
    pages = frame(spark, {"d": ["\n\n   \n", "abc def", "x" * 100], "m": ["page1", "page2", "page3"]})
    assert [r.page_idx for r in quality.suspect_pages(pages).where("doc_id = 'd'").orderBy("page_idx").collect()] == [0, 1]
    overrides = spark.createDataFrame([("m", 1, 0, "old"), ("m", 1, 1, "OCR_PAGE2"), ("m", 9, 0, "nowhere")], "doc_id string, page_idx int, seq int, text string")
    assert {r.doc_id: r.text for r in merge.merge_pages(merge.apply_overrides(pages, overrides)).collect()}["m"] == "page1\nOCR_PAGE2\npage3"


LINES = [
    "PRESIDEN REPUBLIK INDONESIA", "KEMENTERIAN KETENAGAKERJAAN RI", "Tambahan Lembaran Negara Republik Indonesia 5", "BAB I", "BAB IV UMUM", "Pasal 7", "  Pasal 8", "Menimbang:", "Mengingat :", "PENJELASAN", "I. UMUM",
    "- 1 -", "– 22 —", "Hal. 3", "halaman 4", "12", "1234", "a. huruf satu.", "b.", "(3)", "2.", "x. ", "", " ", "kata akhir", "potong-", "an lanjut", "isi; ", "nilai:", "kaki tetap", "é ", "tab\t", "( ", "4) x", "cr\r", "\r", "a b c",
]


def random_docs(seed, n):
    rng = random.Random(seed)
    return {f"d{k}": ["\n".join(rng.choice(LINES) for _ in range(rng.randint(0, 14))) + rng.choice(("", "\n")) for _ in range(rng.randint(1, 5))] for k in range(n)}


@pytest.mark.parametrize("seed", [1, 2])
def test_plans_equal_sequential_model(spark, seed):
    docs = random_docs(seed, 250)
    got = {r.doc_id: r for r in structured(frame(spark, docs)).collect()}
    assert set(got) == set(docs)
    for d, pages in docs.items():
        s = suppress(pages)
        raw = "\n".join(s.pages)
        text, header, footer, fixed = cleanup(raw)
        md, found = promote(text)
        r = got[d]
        assert (r.raw_text, r.markdown) == (raw, md), d
        assert (r.removed_header, r.removed_footer, r.hyphens_fixed, r.suppressor_overrun, r.removed_lines_sample) == (s.header + header, s.footer + footer, fixed, s.overrun, s.sample), d
        assert {k: r[k] for k in found} == found
        assert (r.character_coverage, r.leak_rate, r.split_violations) == pytest.approx(metrics(raw, md)), d


def test_partition_count_changes_nothing(spark):
    docs = frame(spark, random_docs(3, 60))
    rows = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, structured(docs.repartition(int(n))).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows[0] == rows[1]


def test_stages_and_strict_mode(spark):
    pages = frame(spark, {"a": ["BAB I\nPasal 1\nIsi."], "b": ["tanpa struktur."]})
    p = Pipeline(pages, PipelineConfig(strict=True, law_mode="pp"))
    with pytest.raises(StructureNotFound):
        p.check_structure()
    Pipeline(pages.where("doc_id = 'a'"), PipelineConfig(strict=True, law_mode="pp")).check_structure()
    Pipeline(pages, PipelineConfig(strict=True)).check_structure()
    assert {r.doc_id: r.text for r in p.stage("markdown").collect()}["a"] == "## BAB I\n## Pasal 1"
    for name in ("extracted", "merged", "suppressed", "candidates", "cleaned"):
        p.stage(name).collect()


def test_empty_table(spark):
    assert structured(spark.createDataFrame([], PAGES)).collect() == []
