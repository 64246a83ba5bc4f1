import zlib

import numpy as np
import pytest

from pagewright.llm import packing
from pagewright.llm.queries import op10_packing, tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", "   ", "Hello, WORLD's 12 \x0b\x0c\x1c\x1d\x85 x y", "a<|endoftext|>b <|startoftext|> <| endoftext |>", "é ́a\tcafé\n\n", "ﬁ ΟΔΟΣ ΣΑΣ. İx", "BİTTİ. İ.", "J̌. T̈, W̊! é. \u0958. \ufb1d; K. Å!", "ſ. ŉ, ǰ? ẞ!",
    "x" * 5000, "word " * 3000, "日本語 テスト 123'll we've", "\x00 nul\x00l", "word " * 3000,
]


def whole_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, docs):
    """Pieces hold each document's ids once, in order, and fill windows without gaps."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids, at = whole_ids(text), 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            part = np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes()
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or s == len(by_sequence) - 1


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(op10_packing(spark, SF).collect(), docs)


def test_odd_texts_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = list(enumerate(ODD))
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"ids": F.lit("x"), "n": F.lit(1), "part": F.lit(0)}).repartition(3)
    check(packing.pack(spark, frame, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")).collect(), docs)


def test_empty_and_null_id(spark):
    assert packing.pack(spark, spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).collect() == []
    rows = packing.pack(spark, spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string"), tokenizer_path()).collect()
    assert [r.doc_id for r in rows] == [None, None]


@pytest.mark.parametrize("limit", [3, 10_000])
def test_cache_may_start_afresh(limit, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "CACHE_WORDS", limit)
    coder = packing.WordTokenizer(tokenizer_path())
    for texts in (["one two", "three four five six"], ["", "seven one"], ["two two"]):
        ids, counts = coder.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in whole_ids(t)[:-1]] and counts.tolist() == [len(whole_ids(t)) - 1 for t in texts]


def test_random_texts_have_the_tokenizer_s_ids():
    """Letters whose lower case or composed form is longer, combining marks, marks, blanks and control strings in any order."""
    import random
    import unicodedata

    import pyarrow as pa
    from tokenizers import Tokenizer

    letters = [chr(c) for c in range(0x80, 0x30000) if unicodedata.category(chr(c))[0] == "L" and (len(chr(c).lower()) > 1 or unicodedata.normalize("NFC", chr(c)) != chr(c))]
    pools = [list("abcdefhijstwyABHIJKTWY"), letters, list("\u0300\u0301\u0304\u0307\u0308\u030a\u030c\u0327\u0331\u0345\u05b4\u093c"), list(".,%*#&$|!?;:'<>-\"()"), list("  \n\t\x0b\x0c\r\x1c\x85\u00a0\u2028"), list("0123é日ßΣςİıÅ"), ["<|", "<|endoftext|>", "'s", "'LL"]]
    weights = [30, 6, 4, 14, 12, 5, 0.3]
    rng = random.Random(9)
    texts = ["".join(rng.choice(p) for p in rng.choices(pools, weights, k=rng.randint(0, 25))) for _ in range(30_000)]
    texts += [f"a{x}.{y}" for x in letters for y in ("", "b")]
    exact = Tokenizer.from_file(tokenizer_path())
    want = [e.ids for e in exact.encode_batch_fast(texts, add_special_tokens=False)]
    coder = packing.WordTokenizer(tokenizer_path())
    for k in range(0, len(texts), 1000):
        ids, counts = coder.encode(pa.array(texts[k : k + 1000]))
        assert counts.tolist() == [len(x) for x in want[k : k + 1000]]
        assert ids.tolist() == [i for x in want[k : k + 1000] for i in x]
