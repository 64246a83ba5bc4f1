import zlib

from pagewright.llm import lang_id
from pagewright.llm.queries import op5_lang_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op5_lang_id(spark, sf).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.97


def test_vectors_equal_slow_bundles():
    import numpy as np

    p = lang_id.Profiler(256)
    texts = ["Ab, ba!", "", "x", "日本 語x", "a" * 50, "12 ?"]
    got, some = p.vectors(texts)
    for t, v, s in zip(texts, got, some):
        padded = "".join(c if c.isalpha() else " " for c in t.lower())
        total = np.zeros(256)
        for w in padded.split():
            w = f" {w} "
            for i in range(len(w) - 2):
                a, b, c = (p.vector(0 if x == " " else ord(x)).astype(int) for x in w[i : i + 3])
                total += np.roll(a, 2) * np.roll(b, 1) * c
        assert s == bool(padded.strip())
        assert np.allclose(v, total / max(np.linalg.norm(total), 1e-9), atol=1e-5)


def test_many_letters_take_the_sorted_way(monkeypatch):
    import numpy as np

    texts = ["abc def", "ghij", "kl"]
    want = lang_id.Profiler(64).vectors(texts)[0]
    monkeypatch.setattr(lang_id, "TABLE_LETTERS", 2)
    assert np.allclose(lang_id.Profiler(64).vectors(texts)[0], want)


def test_nulls_and_nothing_learned(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, None, "en", "x"), (2, "123 ?!", None, "x"), (None, "hello there", "en", "x"), (4, "x" * 200_000, "en", None)]
    docs = spark.createDataFrame(rows, schema)
    none = lang_id.identify(docs, *lang_id.fit_prototypes(docs.where("lang is null"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    some = {r.doc_id: r.lang_pred for r in lang_id.identify(docs, *lang_id.fit_prototypes(docs)).collect()}
    assert some == {1: "und", 2: "und", None: "en", 4: "en"}
    empty = spark.createDataFrame([], schema)
    assert lang_id.identify(empty, *lang_id.fit_prototypes(empty)).collect() == []


def test_few_trigrams_at_a_time_change_nothing(monkeypatch):
    import numpy as np

    texts = ["the quick brown fox", "", "jumps over the lazy dog " * 50, "été à l'île"]
    want, some = lang_id.Profiler(128).vectors(texts)
    monkeypatch.setattr(lang_id, "GRAMS", 7)
    got, also = lang_id.Profiler(128).vectors(texts)
    assert (got == want).all() and (some == also).all()


def test_a_long_text_of_many_letters_stays_small():
    """1 MB of text of 5,000 different letters, measured in a process of its own."""
    import subprocess
    import sys

    code = """
import random, resource
from pagewright.llm import lang_id
rng = random.Random(1)
text = "".join(rng.choice("  ") if rng.random() < 0.1 else chr(0x4E00 + rng.randrange(5000)) for _ in range(350_000))
assert len(text.encode()) > 900_000
p = lang_id.Profiler()
p.vectors(["warm"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
p.vectors([text])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 200


def slow_prediction(docs, train, dimensions):
    """Prototypes and predictions by plain sums over every trigram of every text, one document at a time."""
    import numpy as np

    draw = lang_id.Profiler(dimensions)

    def profile(text):
        total = np.zeros(dimensions)
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            points = [0, *map(ord, word), 0]
            for a, b, c in zip(points, points[1:], points[2:], strict=False):
                total += np.roll(draw.vector(a).astype(int), 2) * np.roll(draw.vector(b).astype(int), 1) * draw.vector(c)
        return total / np.linalg.norm(total) if total.any() else None

    sums = {}
    for _, text, lang in train:
        if lang is not None and (v := profile(text)) is not None:
            sums[lang] = sums.get(lang, 0) + v
    out = []
    for doc_id, text, _ in docs:
        v = profile(text)
        near = {} if v is None else {k: float(v @ (x / np.linalg.norm(x))) for k, x in sums.items()}
        best = min(near, key=lambda k: (-round(near[k], 6), k)) if near else "und"
        out.append((doc_id, best, max(0.0, near.get(best, 0.0))))
    return out


def test_prototypes_and_prediction_equal_brute_force(spark):
    import random

    import numpy as np

    rng, words = random.Random(3), {"x": "alma bela cora dona".split(), "y": "stuk brot grun tisch".split(), "z": "日本 言語 文字".split()}
    docs = [(i, " ".join(rng.choices(words[k], k=rng.randint(1, 9))), k if i % 5 else None) for i, k in ((i, rng.choice("xyz")) for i in range(120))]
    # Repeated rows, a tie of two languages that learned the same text, a text without letters, a null.
    docs += [docs[1], docs[1], (500, "qqqq", "q2"), (501, "qqqq", "q1"), (502, "qqqq", None), (503, "12 ?", "x"), (504, None, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in lang_id.identify(frame, *lang_id.fit_prototypes(frame, dimensions=256)).collect())
    want = sorted(slow_prediction(docs, docs, 256))
    assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want], atol=1e-5)
    assert dict(x[:2] for x in got)[502] == "q1"


def test_many_languages(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(lang_id, "HELD", 2)
    monkeypatch.setattr(lang_id, "PROTOTYPES", 3)
    texts, langs = [f"{c}{c}{c} {c}a" for c in "bcdefghij"], [f"l{i}" for i in range(9)]
    parts = list(lang_id._bundle(64)([pa.RecordBatch.from_pydict({"text": texts, "lang": langs})]))
    assert [p.num_rows for p in parts] == [2, 2, 2, 2, 1]
    sums = {}
    for p in parts:
        for lang, v in zip(p.column("lang").to_pylist(), p.column("bundle").to_pylist(), strict=True):
            sums[lang] = sums.get(lang, 0) + np.array(v)
    prototypes = np.array([sums[x] / np.linalg.norm(sums[x]) for x in langs], dtype=np.float32)
    assert lang_id.nearest(lang_id.Profiler(64).vectors(texts)[0], prototypes)[0].tolist() == list(range(9))
